"""Answer reconciliation and incremental intake over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from formspark import functions as fx
from formspark.operators import manifest as man
from formspark.operators import reconcile as rcn
from formspark.plans import jobs
from formspark.plans.queries.intake import BUCKET, CATEGORISED_SQL, PAGES, PREFIX, run_at
from formspark.plans.registry import query
from formspark.session import scratch_dir
from formspark.sources import layouts, writers
from formspark.streaming import intake as stream


def _cells(v):
    control = F.when(F.col("question") % 3 == 0, "grid").when(F.col("question") % 3 == 1, "box").otherwise("circle")
    return v["fx_box_ink"].select("file_name", "question", F.col("choice").cast("string").alias("choice"),
                                  F.col("ratio").alias("density"), control.alias("control"))


@query("RCN-01", """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY file_name, question ORDER BY ratio DESC, CAST(choice AS VARCHAR)) AS rn FROM fx_box_ink),
p AS (SELECT file_name, question, max(CASE WHEN rn = 1 THEN CAST(choice AS VARCHAR) END) AS c, max(CASE WHEN rn = 1 THEN ratio END) AS best, max(CASE WHEN rn = 2 THEN ratio END) AS second FROM r GROUP BY ALL)
SELECT file_name, question, best, second, best - second AS margin, best < 0.02 AND best - second < 0.02 AS blank,
  CASE WHEN NOT (best < 0.02 AND best - second < 0.02) AND best - second >= CASE question % 3 WHEN 0 THEN 0.05 WHEN 1 THEN 0.15 ELSE 0.8 END THEN c END AS pixel_choice FROM p""")
def reading_pixel_single(v):
    return rcn.pixel_single(_cells(v))


_MARKED = """SELECT file_name, question, coalesce(list(CAST(choice AS VARCHAR) ORDER BY choice) FILTER (ratio >= 0.1), []) AS pixel,
  coalesce(list(CAST(choice AS VARCHAR) ORDER BY choice) FILTER (choice <> question % 4), []) AS model FROM fx_box_ink GROUP BY file_name, question"""


@query("RCN-02 RCN-03", f"""
SELECT file_name, question, array_to_string(pixel, '|') AS pixel_choices, array_to_string(list_filter(model, lambda x: NOT list_contains(pixel, x)), '|') AS veto,
  array_to_string(list_filter(pixel, lambda x: NOT list_contains(model, x)), '|') AS fill FROM ({_MARKED}) m""")
def reading_multi_select(v):
    claimed = F.filter(F.array(*[F.lit(str(i)) for i in range(4)]), lambda c: c != (F.col("question") % 4).cast("string"))
    delta = rcn.multi_delta(claimed, F.col("pixel_choices"))
    return rcn.pixel_multi(_cells(v)).select(
        "file_name", "question", F.array_join("pixel_choices", "|").alias("pixel_choices"),
        F.array_join(delta["veto"], "|").alias("veto"), F.array_join(delta["fill"], "|").alias("fill"))


_M = "coalesce(model_answer, '')"
_SHOW = "CASE WHEN trim(coalesce({c}, '')) = '' THEN '(blank)' ELSE '''' || trim({c}) || '''' END"
_CONSISTENT = f"""CASE WHEN {_M} = '' AND coalesce(mark_position, '') = '' THEN NULL WHEN coalesce(mark_position, '') = '' THEN 'no mark_position' WHEN {_M} = '' THEN 'no answer text'
  WHEN TRY_CAST(mark_position AS INT) IS NULL THEN 'mark_position ' || mark_position || ' is not a number' WHEN CAST(mark_position AS INT) NOT BETWEEN 1 AND 3 THEN 'mark_position ' || mark_position || ' is out of range'
  WHEN ['Agree','Neutral','Disagree'][TRY_CAST(mark_position AS INT)] <> {_M} THEN 'answer does not match choice at ' || mark_position END"""


@query("RCN-04", f"SELECT file_name, question_number, {_CONSISTENT} AS note FROM fx_readings")
def reading_self_consistency(v):
    return v["fx_readings"].select("file_name", "question_number", rcn.self_consistency_note(
        F.col("model_answer"), F.col("mark_position"), F.col("choices")).alias("note"))


_RES = "(pixel_ran AND coalesce(pixel_answer <> '' AND pixel_margin >= CASE control WHEN 'grid' THEN 0.05 WHEN 'circle' THEN 0.8 ELSE 0.15 END, FALSE))"
_EMP = f"(pixel_ran AND coalesce(pixel_answer = '', FALSE) AND {_M} <> '')"
_DIF = f"({_RES} AND pixel_answer <> {_M})"
_PIXEL = f"""
  SELECT *, CASE WHEN {_RES} AND NOT model_overrules THEN pixel_answer WHEN {_EMP} AND NOT model_overrules THEN '' ELSE {_M} END AS answer0,
    CASE WHEN {_RES} AND NOT model_overrules THEN 'pixel' WHEN {_EMP} AND NOT model_overrules THEN 'pixel_blank' ELSE 'model' END AS method0,
    CASE WHEN ({_DIF} OR {_EMP}) AND model_overrules THEN 'pixel read ' || {_SHOW.format(c='pixel_answer')} || ', kept the model''s ' || {_SHOW.format(c='model_answer')}
      WHEN {_EMP} THEN 'no box confidently marked, but the model read ' || {_SHOW.format(c='model_answer')} WHEN {_DIF} THEN 'auto-corrected to the pixel reading from ' || {_SHOW.format(c='model_answer')} END AS pixel_note,
    (({_DIF} OR {_EMP}) AND (model_overrules OR NOT calibration_validated)) OR {_EMP} AS pixel_flag FROM fx_readings"""


@query("RCN-05", f"SELECT file_name, question_number, answer0 AS answer, method0 AS detection_method, pixel_note, pixel_flag FROM ({_PIXEL}) p")
def reading_pixel_against_model(v):
    return rcn.pixel_vs_model(v["fx_readings"]).select(
        "file_name", "question_number", "answer", "detection_method", "pixel_note", "pixel_flag")


_STRIP = "regexp_replace(lower(trim(coalesce({c}, ''))), '[^\\p{{L}}\\p{{N}}]', '', 'g')"
_A, _B = _STRIP.format(c="model_answer"), _STRIP.format(c="ocr_text")
_TOKEN = f"""({_A} = {_B} OR ({_A} <> '' AND {_B} <> '' AND len(list_intersect(list_distinct(string_split({_A}, '')), list_distinct(string_split({_B}, '')))) / len(list_distinct(string_split({_A}, ''))) >= 0.7))"""


@query("RCN-06", f"SELECT file_name, question_number, {_TOKEN} AS agrees FROM fx_readings")
def reading_ocr_token(v):
    return v["fx_readings"].select("file_name", "question_number", rcn.ocr_token_ok(
        F.col("model_answer"), F.col("ocr_text")).alias("agrees"))


_WORDS = "list_filter(list_distinct(string_split(lower(trim(regexp_replace(coalesce({c}, ''), '[\\s\\x{{00a0}}\\x0b\\x1c-\\x1f]+', ' ', 'g'))), ' ')), lambda w: w <> '')"
_L, _R = _WORDS.format(c="model_text"), _WORDS.format(c="ocr_text")


@query("RCN-07", f"""
SELECT conv_id, turn, CASE WHEN len({_L}) = 0 THEN len({_R}) = 0 ELSE len(list_intersect({_L}, {_R})) / len({_L}) >= 0.7 END AS agrees FROM fx_ocr""")
def reading_ocr_freeform(v):
    return v["fx_ocr"].select("conv_id", "turn", rcn.ocr_freeform_ok(F.col("model_text"), F.col("ocr_text")).alias("agrees"))


_AGAINST = f"(ocr_ran AND NOT {_TOKEN})"
_TAKES = f"({_AGAINST} AND ocr_authoritative AND trim(coalesce(ocr_text, '')) <> '')"
_BOTH = f"({_M} = '' AND (coalesce(pixel_ran AND coalesce(pixel_answer, '') = '', FALSE) OR coalesce(ocr_ran AND trim(coalesce(ocr_text, '')) = '', FALSE)))"
_OCR = f"""
  SELECT *, CASE WHEN {_TAKES} THEN trim(ocr_text) ELSE answer0 END AS answer, CASE WHEN {_TAKES} THEN 'ocr' ELSE method0 END AS method,
    CASE WHEN {_AGAINST} THEN 'Cloud Vision read ' || {_SHOW.format(c='ocr_text')} || ', the model read ' || {_SHOW.format(c='model_answer')} END AS ocr_note FROM ({_PIXEL}) p"""


@query("RCN-08", f"SELECT file_name, question_number, answer, method AS detection_method, ocr_note FROM ({_OCR}) o")
def reading_ocr_authority(v):
    return rcn.apply_ocr_authority(rcn.pixel_vs_model(v["fx_readings"])).select(
        "file_name", "question_number", "answer", "detection_method", "ocr_note")


_LOW = f"CASE WHEN NOT pixel_ran AND NOT ocr_ran AND NOT {_BOTH} AND model_confidence < 0.7 THEN 'self-reported confidence ' || printf('%.2f', model_confidence) || ' below 0.7' END"
_BLANK = f"""CASE WHEN answer = '' AND NOT (blank_exempt OR {_BOTH}) THEN 'confirm this is a genuine skip (' || concat_ws(', ', 'model said ' || {_SHOW.format(c='model_answer')},
  CASE WHEN pixel_ran THEN 'pixel said ' || {_SHOW.format(c='pixel_answer')} END, CASE WHEN ocr_ran THEN 'vision said ' || {_SHOW.format(c='ocr_text')} END) || ')' END"""
_SECOND = f"CASE WHEN second_mark AND NOT (coalesce(pixel_answer, '') = {_M} OR (NOT grid_question AND {_M} <> '')) THEN 'ambiguous second mark' END"


@query("RCN-09 RCN-10 RCN-11", f"SELECT file_name, question_number, {_LOW} AS low, {_BLANK} AS blank, {_SECOND} AS second FROM ({_OCR}) o")
def reading_doubts(v):
    rows = rcn.apply_ocr_authority(rcn.pixel_vs_model(v["fx_readings"]))
    return rows.select("file_name", "question_number", rcn.low_confidence_note().alias("low"),
                       rcn.blank_note().alias("blank"), rcn.second_mark_note().alias("second"))


_FAILED = "SELECT file_name FROM fx_readings WHERE grid_question GROUP BY file_name HAVING NOT bool_or(coalesce(grid_row_found, FALSE))"


@query("RCN-12", _FAILED)
def reading_grid_failures(v):
    return rcn.grid_failures(v["fx_readings"])


# The ticks of a multi-select question: what only one side has, and the note on it.
_CLAIMED, _INKED = ("list_filter(string_split(coalesce({c}, ''), ','), lambda m: m <> '')".format(c=c) for c in ("model_choices", "pixel_choices"))
_VETO, _FILL = f"list_filter({_CLAIMED}, lambda m: NOT list_contains({_INKED}, m))", f"list_filter({_INKED}, lambda m: NOT list_contains({_CLAIMED}, m))"
_MULTI_OFF = f"(model_choices IS NOT NULL AND pixel_ran AND (len({_VETO}) > 0 OR len({_FILL}) > 0))"
_INK_TEXT = f"array_to_string({_INKED}, ',')"
_WHY = f"""concat_ws(' and ', CASE WHEN len({_VETO}) > 0 THEN 'the model claimed ' || array_to_string({_VETO}, ',') END,
  CASE WHEN len({_FILL}) > 0 THEN 'the model missed ' || array_to_string({_FILL}, ',') END)"""
_MULTI = f"""
  SELECT * REPLACE (CASE WHEN {_MULTI_OFF} AND NOT model_overrules THEN {_INK_TEXT} ELSE answer0 END AS answer0, CASE WHEN {_MULTI_OFF} AND NOT model_overrules THEN 'pixel_multi' ELSE method0 END AS method0),
    CASE WHEN {_MULTI_OFF} AND NOT model_overrules THEN 'reconciled to ' || {_SHOW.format(c=_INK_TEXT)} || ': ' || {_WHY}
      WHEN {_MULTI_OFF} THEN 'pixel found ' || {_SHOW.format(c=_INK_TEXT)} || ', kept the model''s choices: ' || {_WHY} END AS n2 FROM ({_PIXEL}) p"""
_WHOLE = _OCR.replace(f"({_PIXEL}) p", f"({_MULTI}) p")
_FILLS = "(comment_question AND ocr_ran AND answer = '' AND trim(coalesce(ocr_text, '')) <> '')"
_FILLED = f"""
  SELECT * REPLACE (CASE WHEN {_FILLS} THEN trim(ocr_text) ELSE answer END AS answer, CASE WHEN {_FILLS} THEN 'ocr_fill' ELSE method END AS method),
    CASE WHEN {_FILLS} THEN 'blank comment filled from the text read on the page' END AS n3 FROM ({_WHOLE}) w"""
_NOTES = f"""
  SELECT *, CASE WHEN cross_out AND pixel_ran THEN 'the pixel reader saw a correction or cross-out' END AS n8,
    CASE WHEN answer_format = 'digits' AND trim(answer) <> '' AND NOT regexp_full_match(trim(answer), '[0-9]{{6}}') THEN 'should be a 6-digit number' END AS n9, CASE WHEN NOT pixel_ran THEN {_CONSISTENT} END AS n1, {_LOW} AS n4, {_BLANK} AS n5, {_SECOND} AS n6,
    CASE WHEN grid_question AND file_name IN ({_FAILED}) THEN 'answer grid could not be located on this file' END AS n7 FROM ({_FILLED}) o"""


@query("RCN-13", f"""
SELECT file_name, question_number, answer AS survey_answer, method AS detection_method,
  pixel_flag OR n1 IS NOT NULL OR ocr_note IS NOT NULL OR n4 IS NOT NULL OR n5 IS NOT NULL OR n6 IS NOT NULL OR n7 IS NOT NULL OR n2 IS NOT NULL OR n3 IS NOT NULL OR n8 IS NOT NULL OR n9 IS NOT NULL AS needs_review,
  nullif(concat_ws('; ', n1, pixel_note, n2, ocr_note, n3, n4, n5, n6, n8, n9, n7), '') AS review_note FROM ({_NOTES}) n""")
def reading_reconciled_answers(v):
    return rcn.reconcile(v["fx_readings"]).select(
        "file_name", "question_number", "survey_answer", "detection_method", "needs_review", "review_note")


# Rules of five questions, one of them with two; and answers that keep and break each of them.
_RULES = ("('1','digits',6,NULL,NULL,NULL,NULL),('2','integer',NULL,NULL,NULL,0,40),('3','decimal',NULL,NULL,NULL,NULL,2.5),"
          "('4','date',NULL,'MM/DD/YYYY',2025,NULL,NULL),('5','date',NULL,'YYYY-MM-DD',NULL,NULL,NULL),"
          "('6','digits',2,NULL,NULL,NULL,NULL),('6','integer',NULL,NULL,NULL,NULL,50)")
_RULE_COLUMNS = "question_number, answer_format, format_digits, date_format, format_year, minimum, maximum"
_SAID = """CASE question_number WHEN '1' THEN CAST(CASE WHEN doc % 3 = 0 THEN doc % 1000 ELSE 100000 + doc % 900000 END AS {text})
  WHEN '2' THEN CASE WHEN doc % 7 = 0 THEN '3.5' ELSE CAST(doc % 60 - 10 AS {text}) END WHEN '3' THEN CASE doc % 4 WHEN 0 THEN 'two' WHEN 1 THEN '.5' WHEN 2 THEN '7.' ELSE '2.5' END
  WHEN '4' THEN CASE doc % 4 WHEN 0 THEN '11/30/2025' WHEN 1 THEN '11/30/2024' WHEN 2 THEN '2025-11-30' ELSE '02/30/2025' END
  WHEN '5' THEN CASE doc % 3 WHEN 0 THEN '2025-11-30' WHEN 1 THEN '11/30/2025' ELSE '' END WHEN '6' THEN CAST(doc % 120 AS {text}) ELSE 'anything' END"""
_WHOLE_NUMBER, _NUMBER = "'[+-]?[0-9]+'", r"'[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)'"


@query("RCN-13 FN-29", f"""
WITH a AS (SELECT file_name, question_number, {_SAID.format(text='VARCHAR')} AS said FROM fx_readings),
r AS (SELECT * FROM (VALUES {_RULES}) AS r({_RULE_COLUMNS})),
b AS (SELECT a.*, r.answer_format, CASE
  WHEN said = '' THEN NULL WHEN answer_format = 'digits' AND NOT (regexp_full_match(said, '[0-9]+') AND len(said) = format_digits) THEN 'should be a ' || CAST(format_digits AS VARCHAR) || '-digit number'
  WHEN answer_format = 'integer' AND NOT regexp_full_match(said, {_WHOLE_NUMBER}) THEN 'should be a whole number' WHEN answer_format = 'decimal' AND NOT regexp_full_match(said, {_NUMBER}) THEN 'should be a number'
  WHEN date_format = 'MM/DD/YYYY' AND try_strptime(said, '%m/%d/%Y') IS NULL THEN 'should be a date in MM/DD/YYYY format' WHEN date_format = 'YYYY-MM-DD' AND try_strptime(said, '%Y-%m-%d') IS NULL THEN 'should be a date in YYYY-MM-DD format'
  WHEN answer_format = 'date' AND year(try_strptime(said, '%m/%d/%Y')) <> format_year THEN 'year should be ' || CAST(format_year AS VARCHAR)
  WHEN answer_format <> 'date' AND TRY_CAST(said AS DOUBLE) < minimum THEN 'is below the minimum' WHEN answer_format <> 'date' AND TRY_CAST(said AS DOUBLE) > maximum THEN 'is above the maximum' END AS why
  FROM a LEFT JOIN r ON r.question_number = a.question_number)
SELECT file_name, question_number, said AS survey_answer, bool_or(why IS NOT NULL) AS needs_review, string_agg(why, '; ' ORDER BY answer_format) AS review_note FROM b GROUP BY ALL""")
def reading_constrained_answers(v):
    rules = v.spark.sql(f"SELECT * FROM VALUES {_RULES} AS r({_RULE_COLUMNS})")
    none = F.lit(None).cast("string")
    readings = v["fx_readings"].withColumns({
        "model_answer": F.expr(_SAID.format(text="STRING")), "pixel_answer": F.expr(_SAID.format(text="STRING")), "pixel_choices": none,
        "model_choices": none, "ocr_text": none, "pixel_ran": F.lit(True), "ocr_ran": F.lit(False), "cross_out": F.lit(False), "second_mark": F.lit(False),
        "grid_question": F.lit(False), "model_confidence": F.lit(1.0), "blank_exempt": F.lit(True)}).drop("answer_format", "format_digits")
    return rcn.reconcile(readings, rules).select("file_name", "question_number", "survey_answer", "needs_review", "review_note")


_LOG = "SELECT *, CASE WHEN ink_quality = 'tight' THEN NULL WHEN event_id % 2 = 0 THEN 'gs://b/' || file_name ELSE 'gs://old/' || file_name END AS gcs_uri FROM fx_profile_log"
_PICK = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY profiled_at DESC, event_id DESC) AS rn FROM ({log}) l WHERE {k} IS NOT NULL) q WHERE rn = 1"


@query("RCN-14", f"""
SELECT f.gcs_uri, coalesce(u.event_id, n.event_id) AS event_id, CASE WHEN u.event_id IS NOT NULL THEN 'gcs_uri' WHEN n.event_id IS NOT NULL THEN 'file_name' END AS tier
FROM (SELECT 'scan' || CAST(c_custkey AS VARCHAR) || '_p1.pdf' AS file_name, CASE WHEN c_acctbal > 4000 THEN 'gs://b/' ELSE 'gs://c/' END || 'scan' || CAST(c_custkey AS VARCHAR) || '_p1.pdf' AS gcs_uri FROM customer) f
LEFT JOIN ({_PICK.format(k='gcs_uri', log=_LOG)}) u ON u.gcs_uri = f.gcs_uri LEFT JOIN ({_PICK.format(k='file_name', log=_LOG)}) n ON n.file_name = f.file_name""")
def reading_tiered_lookup(v):
    name = F.concat(F.lit("scan"), F.col("c_custkey").cast("string"), F.lit("_p1.pdf"))
    root = F.when(F.col("c_acctbal") > 4000, "gs://b/").otherwise("gs://c/")
    files = v["customer"].select(name.alias("file_name"), F.concat(root, name).alias("gcs_uri"))
    uri = F.when(F.col("ink_quality") == "tight", None).when(
        F.col("event_id") % 2 == 0, F.concat(F.lit("gs://b/"), "file_name")).otherwise(F.concat(F.lit("gs://old/"), "file_name"))
    return rcn.tiered_lookup(files, v["fx_profile_log"].withColumn("gcs_uri", uri), tie="event_id").select(
        "gcs_uri", "event_id", "tier")


@query("RCN-15", "SELECT file_name, question_key, question FROM fx_questions_seen WHERE boxes_confirmed = boxes_total")
def reading_rect_hints(v):
    seen = v["fx_questions_seen"].withColumn("rects", F.create_map(F.lit("Yes"), F.array(F.lit(10), F.lit(40)))).withColumn(
        "baseline_correction", F.array(F.lit(0.0)))
    return rcn.rect_hints(writers.pack_question_rects(seen)).select("file_name", "question_key", "question")


@query("RCN-16", """
SELECT event_id, CASE WHEN ink_quality = 'tight' AND ink_mark_lo IS NOT NULL THEN least(0.4, ink_mark_lo - 0.0001) ELSE 0.4 END AS floor FROM fx_profile_log""")
def reading_ink_floor(v):
    return v["fx_profile_log"].select("event_id", rcn.ink_floor(F.col("ink_quality"), F.col("ink_mark_lo")).alias("floor"))


@query("RCN-17", """
SELECT source_gcs_uri, CASE WHEN starts_with(split_part(source_gcs_uri, '/', 5), 'Nov ') THEN CAST('2025-11-' || split_part(split_part(source_gcs_uri, '/', 5), ' ', 2) AS DATE) ELSE DATE '2025-12-01' END AS report_date FROM fx_source""", dates="report_date")
def reading_report_date(v):
    folder = fx.relative_folder(F.col("source_gcs_uri"), F.lit("gs://bucket/raw/"))
    return v["fx_source"].withColumn("folder", folder).select(
        "source_gcs_uri", rcn.report_date(F.col("folder"), F.to_date(run_at())).alias("report_date"))


@query("RCN-18", """
WITH new AS (SELECT folder_name, file_name, question_number, 'new' AS survey_answer FROM fx_responses WHERE review_note = 'other')
SELECT folder_name, file_name, question_number, survey_answer FROM fx_responses r WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.folder_name IS NOT DISTINCT FROM r.folder_name AND n.file_name = r.file_name)
UNION ALL SELECT * FROM new""")
def reading_load_one_file(v):
    columns = ["folder_name", "file_name", "question_number", "survey_answer"]
    new = v["fx_responses"].filter("review_note = 'other'").withColumn("survey_answer", F.lit("new"))
    return rcn.load_answers(v["fx_responses"].select(*columns), new.select(*columns), scope="file")


_RUN_SQL = f"""
  SELECT source_gcs_uri, source_page_range, output_category, rejected_reason IS NOT NULL AS rejected, needs_review_reason IS NOT NULL AS needs_review FROM ({CATEGORISED_SQL}) c
  UNION ALL SELECT source_gcs_uri, '1-' || CAST(page_count AS VARCHAR), 'rejected', TRUE, FALSE FROM fx_source WHERE page_count % 2 = 1"""


@query("INC-01 MAN-02 MAN-03 MAN-04 MAN-05 SNK-02", _RUN_SQL)
def intake_stream_once(v):
    """New inventory files taken by a stream and upserted; then the same sources come again in a new file.

    By then no unit has a verdict, so a source judged twice would show.
    """
    base = scratch_dir(v.spark, "intake")
    inventory = v["fx_source"].select("source_gcs_uri", "page_count")
    inventory.write.parquet(f"{base}/landing")
    table = writers.KeyedTable(v.spark, f"{base}/manifest", man.KEY, layouts.struct_of(layouts.MANIFEST), buckets=8)
    for verdicts in (v["fx_unit_verdict"], v["fx_unit_verdict"].limit(0)):
        files = stream.new_inventory(v.spark, f"{base}/landing", inventory.schema)
        stream.stream_intake(files, lambda known=verdicts: known, table, f"{base}/checkpoint", BUCKET, PREFIX, PAGES,
                             run_at()).awaitTermination()
        inventory.unionByName(inventory).write.mode("append").parquet(f"{base}/landing")
    return table.read().select("source_gcs_uri", "source_page_range", "output_category", "rejected", "needs_review")


_FULL_RUN = f"""
WITH placed AS (SELECT u.source_gcs_uri, u.page_count, u.source_page_range, u.unit_index, min(r.o) AS o FROM (SELECT s.source_gcs_uri, s.page_count, 'Batch ' || CAST(s.doc_id AS VARCHAR) AS destination_folder, 'Batch ' || CAST(s.doc_id AS VARCHAR) || '_p' || CAST(i AS VARCHAR) || '.pdf' AS output_name,
      i AS unit_index, CAST(2 * i - 1 AS VARCHAR) || '-' || CAST(2 * i AS VARCHAR) AS source_page_range FROM fx_source s, LATERAL (SELECT unnest(range(1, s.page_count // 2 + 1)) AS i) q WHERE s.page_count % 2 = 0) u,
    (VALUES (0, ''), (1, 'Declined/'), (2, 'Rejected/')) AS r(o, d) WHERE 'gs://bucket/split/' || r.d || u.destination_folder || '/' || u.output_name IN (SELECT uri FROM fx_split_listing) GROUP BY ALL),
done AS (SELECT source_gcs_uri FROM placed GROUP BY source_gcs_uri, page_count HAVING count(*) * 2 = page_count)
SELECT source_gcs_uri, source_page_range, output_category FROM ({_RUN_SQL}) f WHERE source_gcs_uri NOT IN (SELECT source_gcs_uri FROM done)
UNION ALL SELECT source_gcs_uri, source_page_range, ['normal','declined','rejected'][o + 1] FROM placed WHERE source_gcs_uri IN (SELECT source_gcs_uri FROM done)"""


@query("MAN-11 MAN-07 MAN-04", _FULL_RUN)
def intake_full_run(v):
    """Lazy frame of a whole run."""
    rows, broken = jobs.intake_rows(
        v["fx_source"].select("source_gcs_uri", "page_count"), v["fx_split_listing"], v["fx_unit_verdict"],
        BUCKET, PREFIX, PAGES, run_at())
    return man.settled(rows, broken, None).select("source_gcs_uri", "source_page_range", "output_category")


@query("MAN-11 MAN-07 MAN-04 SNK-02", _FULL_RUN)
def intake_full_run_written(v):
    """The same run put into the manifest table, twice: the second run replaces its own rows."""
    v.keep("fx_source", "fx_split_listing", "fx_unit_verdict")
    table = writers.KeyedTable(v.spark, scratch_dir(v.spark, "manifest"), man.KEY, layouts.struct_of(layouts.MANIFEST), buckets=16)
    for _run in range(2):
        jobs.run_intake(table, v["fx_source"].select("source_gcs_uri", "page_count"), v["fx_split_listing"], v["fx_unit_verdict"],
                        BUCKET, PREFIX, PAGES, run_at())
    return table.read().select("source_gcs_uri", "source_page_range", "output_category")
