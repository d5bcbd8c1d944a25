"""Calibration and scan quality over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from formspark import functions as fx
from formspark.operators import calibrate as cal
from formspark.operators import geometry as geo
from formspark.operators import quality as qc
from formspark.plans.queries.intake import run_at
from formspark.plans.registry import query

_INK_SQL = """
  WITH s AS (SELECT file_name, ratio, row_number() OVER w - 1 AS k, count(*) OVER (PARTITION BY file_name) AS n, lag(ratio) OVER w AS below FROM {table} WINDOW w AS (PARTITION BY file_name ORDER BY ratio)),
  b AS (SELECT *, ratio - below AS gap, greatest(1, n - {most}) AS lo, least(greatest(greatest(1, n - {most}) + 1, n - {least}), n - 1) AS hi FROM s WHERE n >= {samples} AND k > 0),
  c AS (SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY gap DESC, (k BETWEEN lo AND hi) DESC, k) AS rn FROM b WHERE gap >= 0.08 AND {use_clear}),
  t AS (SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY gap DESC, k) AS rn FROM b WHERE k BETWEEN lo AND hi),
  p AS (SELECT *, 'clear' AS quality FROM c WHERE rn = 1 UNION ALL SELECT *, CASE WHEN gap >= 0.08 AND n - k BETWEEN {least} AND {most} THEN 'clear' ELSE 'tight' END FROM t WHERE rn = 1 AND file_name NOT IN (SELECT file_name FROM c))
  SELECT f.file_name, f.n AS samples, round((below + ratio) / 2, 4) AS ink_threshold, round(below, 4) AS ink_blank_hi, round(ratio, 4) AS ink_mark_lo, round(gap, 4) AS ink_gap, quality AS ink_quality, p.n - k AS ink_n_marked
  FROM (SELECT file_name, count(*) AS n FROM {table} GROUP BY file_name) f LEFT JOIN p ON p.file_name = f.file_name"""
_CONFIRMED = "(SELECT * FROM fx_box_ink WHERE confirmed) q"


def _ink(table: str, use_clear: str = "TRUE", samples: int = 12, least: int = 8, most: int = 25) -> str:
    return _INK_SQL.format(table=table, use_clear=use_clear, samples=samples, least=least, most=most)


@query("CAL-01", _ink(_CONFIRMED))
def ink_split_clear_first(v):
    return cal.ink_split(v["fx_box_ink"].filter("confirmed"))


@query("CAL-02", _ink("fx_box_ink", "FALSE"))
def ink_split_windowed(v):
    return cal.ink_split(v["fx_box_ink"], mode="windowed")


@query("CAL-01", _ink("fx_box_ink", samples=2, least=1, most=5))
def ink_split_small_form(v):
    return cal.ink_split(v["fx_box_ink"], limits=(2, 1, 5))


@query("CAL-01", _ink("(SELECT CAST(l_suppkey AS VARCHAR) AS file_name, l_extendedprice / 100000 AS ratio FROM lineitem) q"))
def ink_split_large_files(v):
    return cal.ink_split(v["lineitem"].select(
        F.col("l_suppkey").cast("string").alias("file_name"), (F.col("l_extendedprice") / 100000).alias("ratio")))


# A form per label; each label's files have limits of their own.
_LABELLED = "(SELECT file_name, ratio FROM fx_box_ink JOIN embeddings ON file_name = 'scan' || CAST(vec_id AS VARCHAR) || '_p1.pdf' WHERE label = {k}) q"
_PER_FORM = " UNION ALL ".join(
    f"SELECT * FROM ({_ink(_LABELLED.format(k=k), samples=2 + k, least=1 + k % 3, most=3 + 2 * k)}) f{k}" for k in range(10))


@query("CAL-01 CAL-03", f"SELECT * FROM ({_PER_FORM}) forms")
def ink_split_several_forms(v):
    """Files of ten forms in one job, each with its form's limits."""
    label = F.col("label")
    limits = v["embeddings"].select(
        F.concat(F.lit("scan"), F.col("vec_id").cast("string"), F.lit("_p1.pdf")).alias("file_name"),
        (2 + label).alias("min_samples"), (1 + label % 3).alias("min_marked"), (3 + 2 * label).alias("max_marked"))
    return cal.ink_split(v["fx_box_ink"], per_file=limits)


@query("CAL-03", """
SELECT form_id, CAST(CASE WHEN c < 2 THEN 2 ELSE least(12, c) END AS INT) AS min_samples, 1 AS min_marked, CAST(CASE WHEN c < 2 THEN 1 ELSE c - 1 END AS INT) AS max_marked
FROM (SELECT form_id, count_if(lower(control_type) = 'checkbox') AS c FROM fx_controls WHERE upper(trim(approval)) = 'APPROVED' GROUP BY form_id) q""")
def ink_limits_per_form(v):
    approved = v["fx_controls"].filter(F.upper(F.trim("approval")) == "APPROVED").withColumn(
        "control_type", F.lower("control_type"))
    return cal.ink_limits(approved)


_ACTIVE = """SELECT *, row_number() OVER (PARTITION BY file_name, question ORDER BY boxes_confirmed DESC, boxes_confirmed / greatest(boxes_total, 1) DESC, candidate) = 1 AS active FROM fx_questions_seen"""
_SHOWN = "CASE WHEN rtrim(CAST(CAST({x} AS DECIMAL(24,4)) AS VARCHAR), '0') LIKE '%.' THEN rtrim(CAST(CAST({x} AS DECIMAL(24,4)) AS VARCHAR), '0') || '0' ELSE rtrim(CAST(CAST({x} AS DECIMAL(24,4)) AS VARCHAR), '0') END"


@query("CAL-04", f"""
WITH i AS ({_ink(_CONFIRMED)}),
a AS ({_ACTIVE}),
pg AS (SELECT file_name, count(*) AS page_count, string_agg(DISTINCT paper, '|' ORDER BY paper) AS paper_sizes, string_agg(CASE WHEN marks_found THEN 'yes' ELSE 'no' END, '|' ORDER BY page) AS marks_found_pages,
    max(CASE WHEN page = 1 THEN fit_residual END) AS fit_residual_p1, max(CASE WHEN page = 2 THEN rotation_deg END) AS rotation_deg_p2,
    string_agg(CASE WHEN NOT marks_found THEN 'p' || CAST(page AS VARCHAR) || ': {cal.NO_MARKS.replace("'", "''")}' WHEN fit_residual > 8 THEN 'p' || CAST(page AS VARCHAR) || ': registration fit residual ' || {_SHOWN.format(x='fit_residual')} || '{cal.HIGH_RESIDUAL}' END, ' | ' ORDER BY page) AS pw
  FROM fx_pages GROUP BY file_name),
lw AS (SELECT file_name, string_agg(w, ' | ' ORDER BY CAST(question AS INT)) AS lw FROM (
    SELECT x.file_name, x.question, 'q' || x.question || ': counted active layout ' || x.question_key || '; excluded alternative layout(s) ' || y.question_key AS w
    FROM a x JOIN a y ON y.file_name = x.file_name AND y.question = x.question AND x.active AND NOT y.active) q GROUP BY file_name),
ct AS (SELECT file_name, CAST(sum(boxes_confirmed) AS BIGINT) AS boxes_confirmed, CAST(sum(boxes_total) AS BIGINT) AS boxes_total FROM a WHERE active GROUP BY file_name)
SELECT pg.file_name, page_count, paper_sizes, marks_found_pages, fit_residual_p1, rotation_deg_p2, boxes_confirmed, boxes_total, round(boxes_confirmed / boxes_total, 4) AS confirm_rate, ink_quality,
  concat_ws(' | ', pw, lw, CASE WHEN boxes_confirmed > 0 AND ink_quality IS NULL THEN '{cal.NO_SPLIT}' WHEN ink_quality = 'tight' THEN 'blank and marked ink nearly touch (gap ' || {_SHOWN.format(x='ink_gap')} || ', ' || CAST(ink_n_marked AS VARCHAR) || ' boxes read as marked) - typical of a light-checkmark scan. Not safe to threshold on.' END) AS warnings
FROM pg LEFT JOIN ct ON ct.file_name = pg.file_name LEFT JOIN lw ON lw.file_name = pg.file_name LEFT JOIN i ON i.file_name = pg.file_name""")
def calibration_profile_rows(v):
    active = geo.active_layout(v["fx_questions_seen"])
    ink = cal.ink_split(v["fx_box_ink"].filter("confirmed"))
    return cal.profile_rollup(v["fx_pages"], active, ink).select(
        "file_name", "page_count", "paper_sizes", "marks_found_pages", "fit_residual_p1", "rotation_deg_p2",
        "boxes_confirmed", "boxes_total", "confirm_rate", "ink_quality", "warnings")


def _totals(v):
    return v["fx_box_ink"].groupBy("file_name").agg(
        F.count_if("confirmed").alias("boxes_confirmed"), F.count("*").alias("boxes_total"))


_VALID = """
  SELECT t.file_name, coalesce(ok, FALSE) AND boxes_confirmed / boxes_total >= 0.8 AS valid, coalesce(ok, FALSE) AS registration_ok, round(boxes_confirmed / boxes_total, 4) AS confirm_rate, worst AS fit_residual_max
  FROM (SELECT file_name, count_if(confirmed) AS boxes_confirmed, count(*) AS boxes_total FROM fx_box_ink GROUP BY file_name) t
  LEFT JOIN (SELECT file_name, bool_and(marks_found AND coalesce(fit_residual <= 8, TRUE)) AS ok, max(fit_residual) AS worst FROM fx_pages GROUP BY file_name) p ON p.file_name = t.file_name"""


@query("CAL-05", _VALID)
def calibration_validity(v):
    return cal.validate_geometry(v["fx_pages"], _totals(v)).drop("boxes_confirmed", "boxes_total")


def _unresolved(v):
    """Question 5 is planted never to confirm more than half of its boxes."""
    valid = cal.validate_geometry(v["fx_pages"], _totals(v))
    half = F.when(F.col("question") == "5", F.least("boxes_confirmed", F.lit(2))).otherwise(F.col("boxes_confirmed"))
    candidates = cal.geometry_candidates(v["fx_questions_seen"].withColumn("boxes_confirmed", half), valid)
    expected = v["fx_questions_seen"].select("question_key").distinct().unionByName(
        v["region"].select(F.concat(F.lit("9"), F.col("r_regionkey"), F.lit("#0")).alias("question_key")))
    return cal.unresolved_geometry(candidates, expected), candidates


_UNRESOLVED = f"""
  SELECT e.question_key, split_part(e.question_key, '#', 1) AS question, CASE WHEN c.n IS NULL THEN '{cal.NOT_SEEN}' ELSE '{cal.NOT_VALID}' END AS reason, coalesce(c.n, 0) AS observations
  FROM (SELECT DISTINCT question_key FROM fx_questions_seen UNION SELECT '9' || CAST(r_regionkey AS VARCHAR) || '#0' FROM region) e
  LEFT JOIN (SELECT question_key, count(*) AS n, bool_or(v.valid AND CASE WHEN question = '5' THEN least(boxes_confirmed, 2) ELSE boxes_confirmed END / boxes_total >= 0.8) AS good FROM fx_questions_seen s JOIN ({_VALID}) v ON v.file_name = s.file_name GROUP BY question_key) c ON c.question_key = e.question_key
  WHERE NOT coalesce(good, FALSE)"""


@query("CAL-06", _UNRESOLVED)
def calibration_unresolved(v):
    return _unresolved(v)[0]


@query("CAL-06", f"SELECT s.question_key, s.file_name FROM fx_questions_seen s JOIN ({_UNRESOLVED}) u ON u.question_key = s.question_key")
def calibration_observed_files(v):
    return cal.observed_files(*_unresolved(v))


@query("CAL-07", f"""
SELECT question_key, CASE WHEN n_name IS NULL THEN 'pending' ELSE 'reviewed' END AS status,
 CASE WHEN n_name IS NULL THEN 'Confirm question ' || question || ': identify the printed question text, page (1-based), answer type (single-choice, multi-select, or open text), choice labels in visual order, and the checkbox/circle locations.'
   ELSE 'Confirm question ' || question || ' geometry for ''' || n_name || ''': verify the page (1-based), the single-choice layouts, and checkbox locations.' END
   || CASE WHEN observations > 0 THEN ' Observed: ' || CAST(observations AS VARCHAR) || ' file(s).' ELSE '' END || ' Reason it needs review: ' || reason || '.' AS prompt
FROM ({_UNRESOLVED}) u LEFT JOIN (SELECT CAST(n_nationkey AS VARCHAR) AS q, n_name FROM nation WHERE n_regionkey < 3) n ON n.q = u.question""")
def calibration_review_queue(v):
    semantics = v["nation"].filter("n_regionkey < 3").select(
        F.col("n_nationkey").cast("string").alias("question"), F.col("n_name").alias("question_text"),
        F.lit("single-choice").alias("answer_type"), F.lit("reviewed").alias("status"))
    return cal.review_queue(_unresolved(v)[0], semantics).select("question_key", "status", "prompt")


_CHOICE = """list_filter(list_transform(CASE WHEN contains(choices, '|') THEN string_split(choices, '|') ELSE string_split(choices, ' / ') END, lambda x: trim(x)), lambda x: x <> '')"""


@query("CAL-08", f"""
WITH g AS (SELECT DISTINCT form_id, CASE WHEN approval = 'PENDING' THEN question || '0' ELSE question END AS question, label FROM fx_controls),
s AS (SELECT form_id, number AS question, unnest({_CHOICE}) AS label FROM fx_questions WHERE contains(choices, '|') OR contains(choices, ' / ')),
k AS (SELECT g.form_id, g.question, CASE WHEN l.question IS NULL THEN 'dead' ELSE 'extra' END AS kind, g.label FROM g LEFT JOIN (SELECT DISTINCT form_id, question FROM s) l ON l.form_id = g.form_id AND l.question = g.question
        WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.form_id = g.form_id AND s.question = g.question AND s.label = g.label)
      UNION ALL SELECT s.form_id, s.question, 'missing', s.label FROM s WHERE EXISTS (SELECT 1 FROM g WHERE g.form_id = s.form_id AND g.question = s.question)
        AND NOT EXISTS (SELECT 1 FROM g WHERE g.form_id = s.form_id AND g.question = s.question AND g.label = s.label))
SELECT form_id, question, kind, string_agg(DISTINCT label, '|' ORDER BY label) AS labels FROM k GROUP BY form_id, question, kind""")
def calibration_label_drift(v):
    geometry = v["fx_controls"].select("form_id", F.when(
        F.col("approval") == "PENDING", F.concat("question", F.lit("0"))).otherwise(F.col("question")).alias("question"), "label")
    return cal.label_drift(geometry, v["fx_questions"]).withColumn("labels", F.array_join("labels", "|"))


_BOX = "form_id, question, layout, label, x0"


@query("CAL-09", f"""
WITH c AS (SELECT *, lower(control_type) AS ct FROM fx_controls),
r AS (SELECT {_BOX}, 0 AS sr FROM c WHERE ct = 'checkbox' AND approval = 'PENDING' AND y0 > 1800 UNION ALL SELECT {_BOX}, 1 FROM c WHERE ct = 'checkbox' AND approval = 'APPROVED' AND y0 < 80
  UNION ALL SELECT {_BOX}, 2 FROM c WHERE form_id NOT IN (SELECT form_id FROM fx_form_setup) AND EXISTS (SELECT 1 FROM fx_questions q WHERE q.form_id = c.form_id AND q.number = c.question AND (contains(q.choices, '|') OR contains(q.choices, ' / ')))),
k AS (SELECT r.* FROM r JOIN (SELECT form_id, min(sr) AS sr FROM r GROUP BY form_id) f ON f.form_id = r.form_id AND f.sr = r.sr),
d AS (SELECT *, dense_rank() OVER (PARTITION BY form_id, question ORDER BY layout) - 1 AS candidate FROM k)
SELECT d.form_id, d.question, d.layout, d.label, d.x0, candidate, CASE WHEN m.n > 1 THEN d.question || '#' || CAST(candidate AS VARCHAR) ELSE d.question END AS question_key,
  CASE WHEN q.multi_select = 'Y' THEN 'multiselect' ELSE 'yesno_box' END AS kind
FROM d JOIN (SELECT form_id, question, count(DISTINCT layout) AS n FROM d GROUP BY ALL) m ON m.form_id = d.form_id AND m.question = d.question
LEFT JOIN fx_questions q ON q.form_id = d.form_id AND q.number = d.question""")
def calibration_expected_boxes(v):
    controls = v["fx_controls"].withColumn("control_type", F.lower("control_type"))
    schema = v["fx_questions"].withColumn("is_multi", fx.is_yes(F.col("multi_select")))
    return cal.expected_boxes(
        controls.filter("approval = 'PENDING' AND y0 > 1800"), controls.filter("approval = 'APPROVED' AND y0 < 80"),
        controls, schema, v["fx_form_setup"].select("form_id").distinct(),
    ).select("form_id", "question", "layout", "label", "x0", "candidate", "question_key", "kind")


@query("CAL-10", """
SELECT CASE WHEN starts_with(split_part(source_gcs_uri, '/', 5), 'Nov ') THEN split_part(source_gcs_uri, '/', 5) ELSE '(no folder)' END AS folder, count(*) AS documents,
  CASE WHEN starts_with(split_part(source_gcs_uri, '/', 5), 'Nov ') THEN CAST('2025-11-' || split_part(split_part(source_gcs_uri, '/', 5), ' ', 2) AS DATE) ELSE DATE '2025-12-01' END AS partition_date
FROM fx_source GROUP BY ALL""", dates="partition_date")
def calibration_folder_counts(v):
    return cal.folder_counts(v["fx_source"], "gs://bucket/raw/", F.to_date(run_at()), "source_gcs_uri")


@query("CAL-11", """
SELECT source_gcs_uri AS gcs_uri, CASE WHEN lang = 'en' THEN page_count ELSE 0 END AS boxes_total, CASE WHEN lang = 'en' THEN 'fine' ELSE 'could not be profiled: ' || coalesce('bad page in ' || nullif(lang, 'fr'), 'no result') END AS warnings FROM fx_source""")
def calibration_failure_stubs(v):
    source = v["fx_source"]
    profiles = source.filter("lang = 'en'").select(
        F.col("source_gcs_uri").alias("gcs_uri"), F.col("page_count").cast("bigint").alias("boxes_total"), F.lit("fine").alias("warnings"))
    errors = source.filter("lang <> 'fr'").select(
        F.col("source_gcs_uri").alias("gcs_uri"), F.concat(F.lit("bad page in "), F.col("lang")).alias("error"))
    listing = source.select(F.col("source_gcs_uri").alias("uri"))
    return cal.with_failure_stubs(listing, profiles, errors, F.to_date(run_at()), "gs://bucket/raw/").select(
        "gcs_uri", "boxes_total", "warnings")


@query("QC-01", """
SELECT file_name, event_id, ink_quality FROM (SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY profiled_at DESC, event_id DESC) AS rn FROM fx_profile_log) q WHERE rn = 1""")
def quality_latest_profile(v):
    return qc.latest_profile(v["fx_profile_log"], tie="event_id").select("file_name", "event_id", "ink_quality")


@query("QC-02", """
WITH l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY profiled_at DESC, event_id DESC) AS rn FROM fx_profile_log) q WHERE rn = 1)
SELECT f.file_name, CASE WHEN l.file_name IS NOT NULL THEN l.ink_quality ELSE 'tight' END AS ink_quality, CASE WHEN l.file_name IS NOT NULL THEN l.ink_mark_lo ELSE f.c_acctbal / 10000 END AS ink_mark_lo,
  CASE WHEN l.file_name IS NOT NULL THEN 'pdf_calibration_profile' ELSE 'self-measured' END AS calibration_source
FROM (SELECT 'scan' || CAST(c_custkey AS VARCHAR) || '_p1.pdf' AS file_name, c_acctbal FROM customer) f LEFT JOIN l ON l.file_name = f.file_name""")
def quality_profile_or_fallback(v):
    name = F.concat(F.lit("scan"), F.col("c_custkey").cast("string"), F.lit("_p1.pdf")).alias("file_name")
    own = v["customer"].select(name, F.lit("tight").alias("ink_quality"), (F.col("c_acctbal") / 10000).alias("ink_mark_lo"))
    return qc.profile_or_fallback(v["customer"].select(name), v["fx_profile_log"], own, tie="event_id")


def _file(page):
    return F.concat(F.lit("scan"), F.col(page).cast("string"), F.lit("_p1.pdf")).alias("file_name")


@query("QC-03 GEO-14 GEO-15", """
WITH c AS (SELECT 'scan' || CAST(page_id AS VARCHAR) || '_p1.pdf' AS file_name, min(c) AS m FROM (SELECT page_id, box, CASE WHEN bool_and(inside) THEN avg(coverage) ELSE 0 END AS c FROM fx_sides GROUP BY page_id, box) q WHERE box <> 3 GROUP BY page_id),
q AS (SELECT file_name, sum(boxes_confirmed) / sum(boxes_total) AS r FROM fx_questions_seen WHERE question_key <> '3#0' GROUP BY file_name)
SELECT p.file_name, round(max(abs(rotation_deg)), 3) AS tilt_deg, round(max(fit_residual), 2) AS fit_residual_max, bool_and(marks_found) AS marks_found_all_pages, string_agg(DISTINCT paper, '|' ORDER BY paper) AS paper_sizes, round(r, 4) AS border_rate, round(m, 3) AS border_cov_min
FROM fx_pages p LEFT JOIN c ON c.file_name = p.file_name LEFT JOIN q ON q.file_name = p.file_name GROUP BY p.file_name, r, m""")
def quality_measures(v):
    coverage = geo.border_coverage(v["fx_sides"]).select(
        _file("page_id"), F.concat(F.col("box").cast("string"), F.lit("#0")).alias("question_key"), "coverage")
    shadow = geo.margin_shadow(v["fx_strips"]).select(_file("page_id"), "shadow_coverage", "shadow_bands")
    return qc.qc_measure(v["fx_pages"], v["fx_questions_seen"], coverage, shadow, absent=("3#0",)).select(
        "file_name", "tilt_deg", "fit_residual_max", "marks_found_all_pages",
        F.array_join("paper_sizes", "|").alias("paper_sizes"), "border_rate", "border_cov_min")


def measured(v):
    rows = F.when(F.col("overflow_text") == "", F.array().cast("array<string>")).when(
        F.col("overflow_text").isNotNull(), F.split("overflow_text", ","))
    return v["fx_measured"].withColumn("overflow_rows", rows)


_REASONS = f"""list_filter([
  CASE WHEN calibration_source = 'self-measured' THEN 'no pdf_calibration_profile row found for this file - measured directly instead of using notebook 1''s calibration' END,
  CASE WHEN tilt_deg IS NULL THEN 'page tilt could not be measured (registration marks not found)' WHEN tilt_deg > 0.5 THEN 'page tilted ' || {_SHOWN.format(x='tilt_deg')} || ' deg' END,
  CASE WHEN ink_quality = 'tight' THEN 'marked and blank ink nearly touch (gap ' || {_SHOWN.format(x='ink_gap')} || ') - thresholding this scan is unreliable' WHEN ink_quality IS NULL THEN 'no separation between marked and blank ink could be measured' END,
  CASE WHEN ink_mark_lo < 0.3 THEN 'faintest mark reads ' || {_SHOWN.format(x='ink_mark_lo')} || ' - light checkmark-style marks' END,
  CASE WHEN overflow_text IS NULL THEN 'checkbox grid not locatable - could not check for marks overflowing their boxes' WHEN overflow_text <> '' THEN 'marks overflow their box on Q' || replace(overflow_text, ',', ', Q') END,
  CASE WHEN shadow_coverage >= 0.01 AND shadow_bands >= 6 THEN 'edge shadow band down the margin (coverage ' || {_SHOWN.format(x='shadow_coverage')} || ' across ' || CAST(shadow_bands AS VARCHAR) || '/20 bands)' END,
  CASE WHEN border_rate IS NULL THEN 'no checkbox borders could be located at all' WHEN border_rate < 0.95 THEN 'only ' || printf('%.0f', border_rate * 100) || '% of checkbox borders could be traced' END,
  CASE WHEN border_cov_min < 0.7 THEN 'faintest checkbox border is only ' || printf('%.0f', border_cov_min * 100) || '% covered' END,
  CASE WHEN NOT marks_found_all_pages THEN 'registration marks missing on at least one page' END,
  CASE WHEN fit_residual_max > 8 THEN 'registration marks do not form a rigid quad (residual ' || {_SHOWN.format(x='fit_residual_max')} || 'px)' END], lambda x: x IS NOT NULL)"""
_RATED = f"""SELECT *, CASE WHEN tilt_deg IS NULL THEN 'unknown' WHEN tilt_deg > 0.5 THEN 'yes' ELSE 'no' END AS tilted,
  CASE ink_quality WHEN 'clear' THEN 'clear' WHEN 'tight' THEN 'questionable' ELSE 'unreadable' END AS marks_readable, CASE WHEN ink_mark_lo < 0.3 THEN 'yes' ELSE 'no' END AS faint_marks,
  CASE WHEN ink_mark_lo IS NULL THEN 'unknown' WHEN ink_mark_lo < 0.3 THEN 'light_checkmark' ELSE 'bold_x' END AS ink_mark_style,
  CASE WHEN overflow_text IS NULL THEN 'unknown' WHEN overflow_text <> '' THEN 'yes' ELSE 'no' END AS marks_outside_box, CASE WHEN shadow_coverage >= 0.01 AND shadow_bands >= 6 THEN 'yes' ELSE 'no' END AS shadow_present,
  CASE WHEN border_rate >= 0.95 THEN 'yes' ELSE 'no' END AS box_borders_readable, CASE WHEN border_cov_min < 0.7 THEN 'yes' ELSE 'no' END AS faint_border, {_REASONS} AS reasons FROM fx_measured"""
_RATINGS = ["tilted", "marks_readable", "faint_marks", "ink_mark_style", "marks_outside_box", "shadow_present",
            "box_borders_readable", "faint_border"]


@query("QC-04", f"SELECT event_id, {', '.join(_RATINGS)}, array_to_string(reasons, ' | ') AS reasons FROM ({_RATED}) r")
def quality_ratings(v):
    return qc.classify_measured(measured(v)).select("event_id", *_RATINGS, F.array_join("reasons", " | ").alias("reasons"))


_JUDGED = f"""SELECT r.*, nullif(vision_error, '') AS err, CASE WHEN nullif(vision_error, '') IS NULL THEN coalesce(nullif(handwriting_readable, ''), 'unknown') ELSE 'unknown' END AS hw,
  CASE WHEN nullif(vision_error, '') IS NULL THEN coalesce(nullif(tears_or_damage, ''), 'unknown') ELSE 'unknown' END AS dmg, nullif(handwriting_notes, '') AS hn, nullif(damage_notes, '') AS dn
  FROM ({_RATED}) r LEFT JOIN {{judged}} j ON j.event_id = r.event_id"""
_ROUTED = """
  SELECT *, CASE WHEN pu THEN 'totally_unreadable' WHEN qf OR len(rs) > 0 THEN 'unclear' ELSE 'clear' END AS overall_quality, CASE WHEN pu THEN 'fallback' WHEN qf OR len(rs) >= 5 THEN 'vision' ELSE 'pixel' END AS recommended_route,
    array_to_string(CASE WHEN NOT pu AND NOT qf AND len(rs) >= 5 THEN list_append(rs, CAST(len(rs) AS VARCHAR) || ' quality issues flagged (>= 5) - routed to vision verification') ELSE rs END, ' | ') AS error_reasons
  FROM (SELECT *, marks_readable = 'unreadable' OR box_borders_readable = 'no' OR tilted IN ('yes', 'unknown') OR NOT marks_found_all_pages OR coalesce(fit_residual_max > 8, FALSE) AS pu,
      marks_readable = 'questionable' OR marks_outside_box IN ('yes', 'unknown') OR hw IN ('questionable', 'unreadable') OR dmg = 'yes' AS qf,
      list_concat(reasons, list_filter([CASE WHEN hw = 'questionable' THEN 'handwriting questionable: ' || hn WHEN hw = 'unreadable' THEN 'handwriting could not be read' || coalesce(': ' || hn, '') END,
        CASE WHEN dmg = 'yes' THEN 'physical damage on the page' || coalesce(': ' || dn, '') END, CASE WHEN err IS NOT NULL THEN 'vision pass failed: ' || err END], lambda x: x IS NOT NULL)) AS rs
    FROM ({judged}) j) q"""
_ROUTE_SQL = _ROUTED.format(judged=_JUDGED.format(judged="fx_judgements"))
_PLAIN_SQL = _ROUTED.format(judged=_JUDGED.format(judged="(SELECT * FROM fx_judgements WHERE event_id < 0)"))


def routed(v):
    return qc.derive_route(qc.classify_measured(measured(v)), v["fx_judgements"], key="event_id")


@query("QC-06", f"""
SELECT event_id, hw AS handwriting_readable, dmg AS tears_or_damage, pu AS pixel_unreadable, qf AS questionable_flag, len(rs) >= 5 AS trig_flag_count, overall_quality, recommended_route, recommended_route <> 'pixel' AS needs_review, error_reasons FROM ({_ROUTE_SQL}) q""")
def quality_routes(v):
    return routed(v).select(
        "event_id", "handwriting_readable", "tears_or_damage", "pixel_unreadable", "questionable_flag", "trig_flag_count",
        "overall_quality", "recommended_route", "needs_review", F.array_join("error_reasons", " | ").alias("error_reasons"))


@query("QC-05", f"SELECT event_id FROM ({_PLAIN_SQL}) q WHERE overall_quality <> 'clear'")
def quality_needs_judging(v):
    return qc.needs_judging(qc.classify_measured(measured(v)), key="event_id").select("event_id")


@query("QC-07", f"SELECT recommended_route, count(*) AS files FROM ({_ROUTE_SQL}) q GROUP BY recommended_route")
def quality_route_counts(v):
    return qc.route_counts(routed(v))


@query("QC-08", f"""
SELECT event_id, recommended_route, error_reasons FROM ({_ROUTE_SQL}) q WHERE calibration_source <> 'self-measured'
UNION ALL SELECT event_id, 'fallback', 'could not be assessed: ' || coalesce(CASE WHEN marks_found_all_pages THEN 'no memory' END, 'no result') FROM fx_measured WHERE calibration_source = 'self-measured'""")
def quality_failure_stubs(v):
    rows = v["fx_measured"]
    errors = rows.filter("marks_found_all_pages").select("event_id", F.lit("no memory").alias("error"))
    graded = routed(v).filter("calibration_source <> 'self-measured'")
    return qc.qc_failure_stubs(rows.select("event_id"), graded, errors, key="event_id").select(
        "event_id", "recommended_route", F.array_join("error_reasons", " | ").alias("error_reasons"))


@query("QC-09", """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN DATE '2025-11-03' ELSE DATE '2025-12-01' END AS partition_date, nullif(overflow_text, '') AS overflow_questions, 'v1' AS classifier_version FROM fx_measured""", dates="partition_date")
def quality_stored_rows(v):
    folder = F.when(F.col("event_id") % 3 == 0, F.lit("Nov 3 2025")).when(F.col("event_id") % 3 == 1, F.lit("misc"))
    return qc.quality_rows(routed(v).withColumn("survey_folder", folder), F.to_date(run_at()), "v1", run_at()).select(
        "event_id", "partition_date", "overflow_questions", "classifier_version")
