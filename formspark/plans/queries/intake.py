"""Listings, units, manifest and sinks over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from formspark import functions as fx
from formspark.operators import manifest as man
from formspark.plans.registry import query
from formspark.session import scratch_dir
from formspark.sources import layouts, readers, writers

BUCKET, PREFIX, PAGES, ROOT = "bucket", "split/", 2, "gs://bucket/raw/"
_NATURAL_SQL = """list_transform(regexp_extract_all(lower(source_gcs_uri), '[^0-9]*[0-9]+|[^0-9]+'),
  lambda c: {'t': regexp_extract(c, '^([^0-9]*)', 1), 'n': TRY_CAST(regexp_extract(c, '([0-9]+)$', 1) AS BIGINT)})"""
UNITS_SQL = """
  SELECT s.source_gcs_uri, s.page_count, CAST(i AS INT) AS unit_index, CAST(2 * i - 1 AS INT) AS page_start, CAST(2 * i AS INT) AS page_end,
         CAST(2 * i - 1 AS VARCHAR) || '-' || CAST(2 * i AS VARCHAR) AS source_page_range,
         'Batch ' || CAST(s.doc_id AS VARCHAR) AS destination_folder,
         'Batch ' || CAST(s.doc_id AS VARCHAR) || '_p' || CAST(i AS VARCHAR) || '.pdf' AS output_name
  FROM fx_source s, LATERAL (SELECT unnest(range(1, s.page_count // 2 + 1)) AS i) u WHERE s.page_count % 2 = 0"""
ISSUE_SQL = """CASE WHEN upper(trim(content_verdict)) LIKE 'BLANK%' THEN 'The PDF is empty - there''s no data to process'
  WHEN upper(trim(content_verdict)) LIKE 'UNREADABLE%' THEN 'Gemini could not read the page content' END"""
MARK_SQL = """CASE WHEN regexp_matches(upper(content_verdict), '\\sDECLINED_WORD$') THEN 'WORD'
  WHEN regexp_matches(upper(content_verdict), '\\sDECLINED_SCRIBBLE$') THEN 'SCRIBBLE' END"""
NOTE_SQL = """CASE WHEN coalesce(language_verdict, '') <> 'ENGLISH' THEN 'The survey appears to be written in a language other than English' END"""
_WORD = man.WORD_REASON.replace("'", "''")
_SCRIBBLE = man.SCRIBBLE_REASON.replace("'", "''")
CATEGORISED_SQL = f"""
  SELECT u.*, CASE WHEN mark IS NOT NULL THEN 'declined' WHEN issue IS NOT NULL THEN 'rejected' ELSE 'normal' END AS output_category,
         CASE WHEN mark IS NULL THEN issue END AS rejected_reason,
         CASE WHEN mark = 'WORD' THEN '{_WORD}' || coalesce(' Also, ' || note || '.', '')
              WHEN mark = 'SCRIBBLE' THEN '{_SCRIBBLE}' || coalesce(' Also, ' || note || '.', '')
              WHEN issue IS NULL THEN note END AS needs_review_reason
  FROM ({UNITS_SQL}) u LEFT JOIN (SELECT source_gcs_uri, unit_index, {ISSUE_SQL} AS issue, {MARK_SQL} AS mark, {NOTE_SQL} AS note FROM fx_unit_verdict) v
    ON v.source_gcs_uri = u.source_gcs_uri AND v.unit_index = u.unit_index"""
# A unit without a verdict has a null note in the join above but is not accepted.
CATEGORISED_SQL = CATEGORISED_SQL.replace(
    "FROM (", "FROM (SELECT * FROM (", 1
).replace(") u LEFT JOIN", ")) u LEFT JOIN", 1).replace(
    "note FROM fx_unit_verdict)", "note FROM fx_unit_verdict UNION ALL SELECT w.source_gcs_uri, w.unit_index, NULL, NULL, "
    "'The survey appears to be written in a language other than English' FROM (" + UNITS_SQL + ") w "
    "WHERE NOT EXISTS (SELECT 1 FROM fx_unit_verdict x WHERE x.source_gcs_uri = w.source_gcs_uri AND x.unit_index = w.unit_index))", 1
)


def run_at():
    """Pinned clock of every run, so that results do not depend on when they are made."""
    return F.lit("2025-12-01 09:30:00").cast("timestamp")


def units_of(v):
    return man.expand_units(v["fx_source"].select("source_gcs_uri", "page_count"), PAGES)


def categorised(v):
    return man.categorise_units(units_of(v), v["fx_unit_verdict"])


@query("SRC-01", """
SELECT source_gcs_uri AS uri FROM fx_source WHERE starts_with(source_gcs_uri, 'gs://bucket/raw/') AND lower(source_gcs_uri) LIKE '%.pdf'""")
def source_inventory(v):
    names = v["fx_source"].select(F.col("source_gcs_uri").alias("uri")).unionByName(
        v["fx_listing"].filter(F.contains("uri", F.lit("/split/"))))
    return readers.documents_in(names, "gs://bucket/raw")


@query("SRC-02", f"""
SELECT source_gcs_uri FROM fx_source WHERE NOT contains(substr(source_gcs_uri, 17), '/')
ORDER BY {_NATURAL_SQL}, source_gcs_uri LIMIT 40""")
def source_first_loose(v):
    return readers.select_sources(
        v["fx_source"], "gs://bucket/raw", uri="source_gcs_uri", loose_only=True, limit=40
    ).select("source_gcs_uri")


@query("SRC-03", """
SELECT max(object_name) AS object_name FROM fx_exports
WHERE regexp_full_match(regexp_replace(object_name, '^.*/', ''), 'review_\\d{8}_\\d{6}\\.csv')""")
def source_latest_export(v):
    return readers.latest_export(v["fx_exports"], "review_", ".csv")


@query("SRC-04", "SELECT folder_name, file_name, question_number, trim(correct_answer) AS correct_answer FROM fx_feedback")
def source_feedback_sheet(v):
    return readers.feedback_rows(v["fx_feedback"])


@query("SRC-05", """
SELECT folder_name, file_name, question_number, survey_answer FROM fx_responses
WHERE folder_name IN (SELECT folder_name FROM fx_feedback WHERE correct_answer = 'N/A')""")
def source_responses_in_folders(v):
    wanted = v["fx_feedback"].filter("correct_answer = 'N/A'").select("folder_name")
    return readers.in_folders(v["fx_responses"], wanted).select(
        "folder_name", "file_name", "question_number", "survey_answer")


@query("SRC-06", """
SELECT source_file, source_gcs_uri, destination_folder, destination_gcs_uri, source_page_range, output_category,
       rejected, rejected_reason, needs_review, needs_review_reason, CAST(moved_at AS DATE) AS moved_at FROM fx_audited""", dates="moved_at")
def source_manifest_columns(v):
    return readers.manifest_projection(v["fx_audited"]).withColumn("moved_at", F.to_date("moved_at"))


@query("SRC-09", """
SELECT form_id, number, question_text, choices, question_text IS NOT NULL AS has_text, choices IS NOT NULL AS has_choices
FROM fx_overrides""")
def source_override_json(v):
    files = v["fx_overrides"].groupBy("form_id").agg(F.to_json(F.map_from_entries(F.collect_list(
        F.struct("number", F.struct("question_text", "choices"))))).alias("value"))
    return readers.overrides_from_text(files, keys=("form_id",)).drop("question_type")


@query("SRC-10 SRC-11", """
SELECT d.source_gcs_uri, count(r.source_page_range) AS flagged FROM (SELECT DISTINCT source_gcs_uri FROM fx_source WHERE lang <> 'es') d
LEFT JOIN (SELECT source_gcs_uri, source_page_range FROM fx_audited WHERE needs_review AND source_gcs_uri <> '') r USING (source_gcs_uri)
GROUP BY d.source_gcs_uri""")
def source_done_and_reprocess(v):
    lines = v["fx_source"].select(F.when(F.col("lang") == "es", F.lit("  ")).otherwise(
        F.concat(F.col("source_gcs_uri"), F.lit(" "))).alias("value"))
    flags = readers.reprocess_rows(v["fx_audited"].select(
        F.when(F.col("needs_review"), F.col("source_gcs_uri")).otherwise("").alias("source_gcs_uri"),
        "source_page_range"))
    return readers.done_log_rows(lines).join(flags, "source_gcs_uri", "left").groupBy("source_gcs_uri").agg(
        F.count("source_page_range").alias("flagged"))


@query("SRC-12 SNK-09", """
SELECT file_name, question_key, question, CAST(page_idx AS INT) AS page_idx, CAST(candidate AS INT) AS candidate,
       boxes_confirmed, boxes_total, '10,40,' || CAST(question AS VARCHAR) AS first_rect FROM fx_questions_seen""")
def geometry_json_round_trip(v):
    rects = F.create_map(F.lit("Yes"), F.array(F.lit(10), F.lit(40), F.col("question").cast("int")))
    seen = v["fx_questions_seen"].withColumn("rects", rects).withColumn(
        "baseline_correction", F.array(F.lit(0.0), F.lit(16.0)))
    unpacked = readers.unpack_question_rects(writers.pack_question_rects(seen))
    return unpacked.select(
        "file_name", "question_key", "question", "page_idx", "candidate", "boxes_confirmed", "boxes_total",
        F.array_join(F.element_at("rects", "Yes").cast("array<string>"), ",").alias("first_rect"))


@query("MAN-01", f"SELECT * FROM ({UNITS_SQL}) u")
def manifest_units(v):
    return units_of(v)


@query("MAN-01", f"SELECT source_gcs_uri, output_name, source_page_range FROM ({UNITS_SQL}) u WHERE unit_index <= 2")
def manifest_first_units(v):
    units = man.expand_units(v["fx_source"], PAGES, max_units=2)
    return units.select("source_gcs_uri", "output_name", "source_page_range")


@query("MAN-02", f"""
SELECT s.source_gcs_uri, '1-' || CAST(page_count AS VARCHAR) AS source_page_range,
  'Batch ' || CAST(s.doc_id AS VARCHAR) || CASE WHEN s.doc_id % 5 = 0 THEN '.PDF' ELSE '.pdf' END || ' has ' || CAST(page_count AS VARCHAR) || ' page(s), which is not a multiple of 2 pages per survey'
   || CASE WHEN coalesce(language_verdict, '') <> 'ENGLISH' THEN '; Also: the PDF is in a language other than English' ELSE '' END
   || coalesce('; Also: ' || {ISSUE_SQL}, '') AS rejected_reason
FROM fx_source s LEFT JOIN fx_unit_verdict v ON v.source_gcs_uri = s.source_gcs_uri AND v.unit_index = 1 WHERE page_count % 2 = 1""")
def manifest_malformed(v):
    return man.malformed_sources(v["fx_source"], v["fx_unit_verdict"], PAGES).select(
        "source_gcs_uri", "source_page_range", "rejected_reason")


@query("MAN-03", f"""
SELECT source_gcs_uri, unit_index, output_category, rejected_reason, needs_review_reason FROM ({CATEGORISED_SQL}) c""")
def manifest_categories(v):
    return categorised(v).select(
        "source_gcs_uri", "unit_index", "output_category", "rejected_reason", "needs_review_reason")


@query("MAN-04 FN-10", f"""
SELECT source_gcs_uri, source_page_range, substr(source_gcs_uri, 6) AS source_file, '12/01' AS parsed_month_day, DATE '2025-12-01' AS moved_date,
  'gs://bucket/split/' || CASE output_category WHEN 'declined' THEN 'Declined/' WHEN 'rejected' THEN 'Rejected/' ELSE '' END || destination_folder || '/' || output_name AS destination_gcs_uri,
  rejected_reason IS NOT NULL AS rejected, needs_review_reason IS NOT NULL AS needs_review
FROM ({CATEGORISED_SQL}) c""", dates="moved_date")
def manifest_row_build(v):
    rows, _both = man.manifest_rows(categorised(v), BUCKET, PREFIX, run_at())
    return rows.select("source_gcs_uri", "source_page_range", "source_file", "parsed_month_day", "moved_date",
                       "destination_gcs_uri", "rejected", "needs_review")


_CLASH = "CASE WHEN unit_index % 3 = 0 THEN destination_folder || '_p2.pdf' ELSE output_name END"


@query("MAN-05", f"""
WITH c AS (SELECT *, {_CLASH} AS name FROM ({CATEGORISED_SQL}) x),
n AS (SELECT *, row_number() OVER (PARTITION BY source_gcs_uri, name ORDER BY page_start) AS rn FROM c)
SELECT source_gcs_uri, page_start, rn = 1 AS has_destination, CASE WHEN rn = 1 THEN output_category ELSE 'rejected' END AS output_category,
  CASE WHEN rn = 1 THEN rejected_reason ELSE 'duplicate output name ''' || name || ''' within this source PDF' END AS rejected_reason
FROM n""")
def manifest_duplicate_names(v):
    units = categorised(v).withColumn("output_name", F.when(
        F.col("unit_index") % 3 == 0, F.concat("destination_folder", F.lit("_p2.pdf"))).otherwise(F.col("output_name")))
    return man.flag_duplicate_names(units).select(
        "source_gcs_uri", "page_start", "has_destination", "output_category", "rejected_reason")


_PLACED_SQL = f"""
  SELECT u.source_gcs_uri, u.page_count, u.unit_index, u.source_page_range, min(r.o) AS o FROM ({UNITS_SQL}) u,
    (VALUES (0, ''), (1, 'Declined/'), (2, 'Rejected/')) AS r(o, d)
  WHERE 'gs://bucket/split/' || r.d || u.destination_folder || '/' || u.output_name IN (SELECT uri FROM fx_split_listing)
  GROUP BY ALL"""


@query("MAN-06", f"""
SELECT source_gcs_uri FROM ({_PLACED_SQL}) p GROUP BY source_gcs_uri, page_count HAVING count(*) * 2 = page_count""")
def manifest_complete_sources(v):
    return man.complete_sources(v["fx_source"], v["fx_split_listing"], PAGES, BUCKET, PREFIX)


@query("MAN-07", f"""
SELECT p.source_gcs_uri, p.source_page_range, ['normal','declined','rejected'][o + 1] AS output_category,
  CASE WHEN o = 2 THEN coalesce(issue, '{man.NO_CURRENT_REASON.replace("'", "''")}') END AS rejected_reason,
  CASE WHEN o = 1 THEN CASE WHEN mark = 'SCRIBBLE' THEN '{_SCRIBBLE}' ELSE '{_WORD}' END || CASE WHEN ok THEN '' ELSE ' Also, The survey appears to be written in a language other than English.' END
       WHEN o = 0 AND NOT ok THEN 'The survey appears to be written in a language other than English' END AS needs_review_reason
FROM (SELECT p.*, {ISSUE_SQL} AS issue, {MARK_SQL} AS mark, coalesce(language_verdict = 'ENGLISH', FALSE) AS ok
      FROM ({_PLACED_SQL}) p LEFT JOIN fx_unit_verdict v ON v.source_gcs_uri = p.source_gcs_uri AND v.unit_index = p.unit_index) p""")
def manifest_reconcile(v):
    return man.reconcile_manifest(
        v["fx_source"], v["fx_split_listing"], v["fx_unit_verdict"], PAGES, BUCKET, PREFIX
    ).select("source_gcs_uri", "source_page_range", "output_category", "rejected_reason", "needs_review_reason")


@query("MAN-08", """
WITH l AS (SELECT uri FROM fx_listing UNION SELECT destination_gcs_uri FROM fx_new_rows WHERE destination_folder NOT LIKE '%3')
SELECT DISTINCT o.source_gcs_uri, o.source_page_range, o.destination_gcs_uri AS old_uri, n.destination_gcs_uri AS new_uri
FROM fx_manifest o JOIN fx_new_rows n ON n.source_gcs_uri IS NOT DISTINCT FROM o.source_gcs_uri AND n.source_page_range IS NOT DISTINCT FROM o.source_page_range
WHERE o.destination_gcs_uri <> n.destination_gcs_uri AND n.destination_gcs_uri IN (SELECT uri FROM l) AND o.destination_gcs_uri IN (SELECT uri FROM l)""")
def manifest_superseded(v):
    new = v["fx_new_rows"]
    uploaded = new.filter(~F.col("destination_folder").endswith("3")).select(F.col("destination_gcs_uri").alias("uri"))
    return man.superseded(v["fx_manifest"], new, v["fx_listing"].unionByName(uploaded), BUCKET)


@query("MAN-09", """
WITH f AS (SELECT DISTINCT split_part(source_gcs_uri, '/', 5) AS folder FROM fx_source WHERE starts_with(split_part(source_gcs_uri, '/', 5), 'Nov '))
SELECT folder, CAST('2025-11-' || split_part(folder, ' ', 2) AS DATE) AS folder_date FROM f""", dates="folder_date")
def manifest_date_folders(v):
    return man.date_folders(v["fx_source"], ROOT, "source_gcs_uri")


@query("MAN-10", """
WITH y AS (SELECT year(o_orderdate) AS y, count(DISTINCT CAST(o_orderdate AS DATE)) AS n FROM orders GROUP BY 1)
SELECT CAST(max_by(y, n * 10000 + y) AS INT) AS year, CAST(sum(n) AS BIGINT) AS folders FROM y""")
def manifest_infer_year(v):
    folders = v["orders"].select(F.to_date("o_orderdate").alias("folder_date")).distinct()
    return man.infer_year(folders, 2024)


@query("MAN-11", f"""
WITH c AS (SELECT source_gcs_uri FROM ({_PLACED_SQL}) p GROUP BY source_gcs_uri, page_count HAVING count(*) * 2 = page_count)
SELECT source_gcs_uri, CASE WHEN source_gcs_uri IN (SELECT source_gcs_uri FROM c) THEN 'reconcile' ELSE 'expand' END AS plan FROM fx_source""")
def manifest_source_plan(v):
    done = man.complete_sources(v["fx_source"], v["fx_split_listing"], PAGES, BUCKET, PREFIX)
    ready, rest = man.plan_sources(v["fx_source"].select("source_gcs_uri"), done)
    return ready.withColumn("plan", F.lit("reconcile")).unionByName(rest.withColumn("plan", F.lit("expand")))


@query("MAN-12", """
SELECT count(*) AS outputs, CAST(count_if(output_category = 'normal') AS BIGINT) AS normal, CAST(count_if(output_category = 'declined') AS BIGINT) AS declined,
  CAST(count_if(output_category = 'rejected') AS BIGINT) AS rejected, CAST(count_if(rejected) AS BIGINT) AS rejected_flag, CAST(count_if(needs_review) AS BIGINT) AS needs_review,
  (SELECT count(*) FROM fx_open_errors) AS failed_sources FROM fx_audited""")
def manifest_run_totals(v):
    return man.run_totals(v["fx_audited"], v["fx_open_errors"])


@query("MAN-13", """
SELECT coalesce(model, '(all)') AS model, CAST(count_if(prompt_tokens IS NOT NULL OR output_tokens IS NOT NULL) AS BIGINT) AS requests,
  CAST(coalesce(sum(prompt_tokens), 0) AS BIGINT) AS prompt_tokens, CAST(coalesce(sum(output_tokens), 0) AS BIGINT) AS output_tokens,
  CAST(sum(coalesce(prompt_tokens, 0) + coalesce(output_tokens, 0)) AS BIGINT) AS total_tokens
FROM fx_call_log GROUP BY ROLLUP (model)""")
def manifest_usage_totals(v):
    return man.usage_totals(v["fx_call_log"], ("model",), rollup=True).withColumn(
        "model", F.coalesce("model", F.lit("(all)")))


@query("SNK-01", "SELECT count(*) AS rows, count(DISTINCT CAST(ts AS DATE)) AS partitions FROM events")
def sink_append_by_date(v):
    log = v["fx_profile_log"].withColumn("partition_date", F.to_date("profiled_at"))
    return writers.append_partitioned(log, scratch_dir(v.spark, "profiles"), "partition_date", "load1")


@query("SNK-02", """
SELECT source_gcs_uri, source_page_range, output_category, destination_gcs_uri FROM fx_manifest m
WHERE NOT EXISTS (SELECT 1 FROM fx_new_rows n WHERE n.source_gcs_uri IS NOT DISTINCT FROM m.source_gcs_uri AND n.source_page_range IS NOT DISTINCT FROM m.source_page_range)
UNION ALL SELECT source_gcs_uri, source_page_range, output_category, destination_gcs_uri FROM fx_new_rows""")
def sink_replace_by_key(v):
    columns = ["source_gcs_uri", "source_page_range", "output_category", "destination_gcs_uri"]
    return writers.replace_by_key(v["fx_manifest"].select(*columns), v["fx_new_rows"].select(*columns), man.KEY)


@query("SNK-02", """
SELECT source_gcs_uri, source_page_range, output_category FROM fx_manifest m
WHERE NOT EXISTS (SELECT 1 FROM fx_new_rows n WHERE n.source_gcs_uri = m.source_gcs_uri AND n.source_page_range = m.source_page_range)
UNION ALL SELECT source_gcs_uri, source_page_range, output_category FROM fx_new_rows""")
def sink_bucketed_replace(v):
    columns = ["source_gcs_uri", "source_page_range", "output_category"]
    rows = v["fx_manifest"].select(*columns)
    table = writers.KeyedTable(v.spark, scratch_dir(v.spark, "manifest"), man.KEY, rows.schema, buckets=16)
    table.append(rows)
    table.replace(v["fx_new_rows"].select(*columns))
    return table.read().select(*columns)


@query("SNK-03", """
WITH new AS (SELECT folder_name, file_name, 'fresh' AS state FROM fx_responses WHERE review_note IS NULL)
SELECT folder_name, file_name, 'old' AS state FROM fx_responses
WHERE folder_name IS NULL OR folder_name NOT IN (SELECT folder_name FROM new WHERE folder_name IS NOT NULL)
UNION ALL SELECT * FROM new""")
def sink_replace_folder(v):
    old = v["fx_responses"].select("folder_name", "file_name", F.lit("old").alias("state"))
    new = v["fx_responses"].filter("review_note IS NULL").select("folder_name", "file_name", F.lit("fresh").alias("state"))
    return writers.replace_by_folder(old, new)


@query("SNK-04 SNK-06", """
SELECT folder_name, file_name, CAST(report_date AS DATE) AS report_date, NULL AS survey_answer, TRY_CAST(review_note AS BOOLEAN) AS needs_review,
       model_confidence, NULL AS ingested_from, CAST(NULL AS BOOLEAN) AS updated_with_feedback FROM fx_responses""", dates="report_date")
def sink_conform(v):
    raw = v["fx_responses"].select(
        "folder_name", "file_name", F.col("report_date").cast("string").alias("report_date"),
        F.col("review_note").alias("needs_review"), F.col("model_confidence").cast("string").alias("model_confidence"),
        F.lit(1).alias("not_declared"))
    shaped = layouts.evolve(layouts.conform(raw, layouts.RESPONSES), layouts.FEEDBACK)
    return shaped.select("folder_name", "file_name", "report_date", "survey_answer", "needs_review",
                         "model_confidence", "ingested_from", "updated_with_feedback")


@query("SNK-07", """
SELECT source_gcs_uri AS source_uri, CASE WHEN source_page_range <> '' THEN source_gcs_uri || ' (pages ' || source_page_range || ')' ELSE source_gcs_uri END AS bad_pdf,
       coalesce(rejected_reason, needs_review_reason) AS error FROM fx_audited WHERE rejected OR needs_review
UNION ALL SELECT source_gcs_uri, source_gcs_uri, error FROM fx_open_errors""")
def sink_failure_log(v):
    return writers.failure_rows(v["fx_audited"], v["fx_open_errors"], run_at()).drop("failed_at_utc")
