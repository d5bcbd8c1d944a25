"""Form catalogue checks over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from formspark.operators import catalog as cat
from formspark.plans.registry import query

PAGES = 2
_RULES = "('single choice (pick one)',FALSE,'none'),('multiple choice (pick several)',TRUE,'none'),('written answer - short code or number',FALSE,'token'),('written answer - longer text',FALSE,'freeform'),('written answer - not checked by cloud vision',FALSE,'none')"
_YES = "lower(trim(coalesce({c}, ''))) IN ('y', 'yes', 'true', '1')"
_INT = "CAST(trunc(TRY_CAST(trim({c}) AS DOUBLE)) AS INT)"
_TYPED = f"""
  SELECT q.form_id, number, nullif(trim(group_key), '') AS group_key, trim(question_text) AS question_text, trim(choices) AS choices,
    coalesce(r.multi, {_YES.format(c='multi_select')}) AS is_multi, coalesce(r.ocr, coalesce(nullif(lower(trim(ocr_check)), ''), 'none')) AS ocr_check,
    {_YES.format(c='model_overrules')} AS model_overrules, {_YES.format(c='blank_exempt')} AS blank_exempt, {_YES.format(c='ocr_authoritative')} AS ocr_authoritative,
    coalesce({_INT.format(c='page_1based')} - 1, {_INT.format(c='legacy_page')} - CASE WHEN b.one THEN 1 ELSE 0 END) AS page,
    nullif(lower(trim(expected_format)), '') AS expected_format, {_INT.format(c='expected_digits')} AS expected_digits,
    TRY_CAST(trim(minimum) AS DOUBLE) AS minimum, TRY_CAST(trim(maximum) AS DOUBLE) AS maximum, nullif(trim(anchor), '') AS anchor, CASE WHEN trim(anchor) <> '' THEN lower(trim(direction)) END AS direction
  FROM fx_questions q JOIN (SELECT form_id, bool_or(coalesce({_INT.format(c='legacy_page')} = 2, FALSE)) AND NOT bool_or(coalesce({_INT.format(c='legacy_page')} = 0, FALSE)) AS one FROM fx_questions GROUP BY form_id) b ON b.form_id = q.form_id
  LEFT JOIN (VALUES {_RULES}) AS r(label, multi, ocr) ON r.label = lower(trim(question_type))"""
_SCHEMA = f"SELECT * FROM ({_TYPED}) t WHERE coalesce(page BETWEEN 0 AND 1, TRUE)"


def schema_of(v):
    return cat.question_schema(v["fx_questions"], PAGES)[0]


@query("SRC-08", _SCHEMA)
def form_question_schema(v):
    return schema_of(v)


@query("SRC-08", f"SELECT form_id, number, 'page ' || CAST(page + 1 AS VARCHAR) || ' is outside the configured 2-page form' AS reason FROM ({_TYPED}) t WHERE NOT coalesce(page BETWEEN 0 AND 1, TRUE)")
def form_pages_outside(v):
    return cat.question_schema(v["fx_questions"], PAGES)[1]


@query("CFG-09", f"""
WITH s AS ({_SCHEMA})
SELECT form_id, number, 'unsupported expected format ' || expected_format AS reason FROM s WHERE expected_format NOT IN ('digits', 'integer', 'decimal', 'date')
UNION ALL SELECT form_id, number, 'expected digit count must be positive' FROM s WHERE expected_digits < 1
UNION ALL SELECT form_id, number, 'minimum exceeds maximum' FROM s WHERE minimum > maximum
UNION ALL SELECT form_id, number, 'anchor direction must be right or below' FROM s WHERE anchor IS NOT NULL AND direction NOT IN ('right', 'below')""")
def form_schema_violations(v):
    return cat.schema_violations(schema_of(v))


@query("CFG-01", """
SELECT q.form_id, q.number, coalesce(o.question_text, q.question_text) AS question_text, coalesce(o.choices, q.choices) AS choices
FROM fx_questions q LEFT JOIN fx_overrides o ON o.form_id = q.form_id AND o.number = q.number""")
def form_patched_questions(v):
    return cat.patch_questions(v["fx_questions"], v["fx_overrides"])[0].select("form_id", "number", "question_text", "choices")


@query("CFG-01", """
SELECT form_id, number FROM fx_overrides o WHERE NOT EXISTS (SELECT 1 FROM fx_questions q WHERE q.form_id = o.form_id AND q.number = o.number)""")
def form_unknown_overrides(v):
    return cat.patch_questions(v["fx_questions"], v["fx_overrides"])[1]


@query("CFG-02", """
SELECT o.form_id, o.number, q.group_key, coalesce(o.question_text, q.question_text, '') AS question_text, coalesce(o.choices, '') AS choices
FROM fx_overrides o LEFT JOIN fx_questions q ON q.form_id = o.form_id AND q.number = o.number""")
def form_replaced_questions(v):
    return cat.replace_questions(v["fx_questions"], v["fx_overrides"])[0]


@query("CFG-02", """
SELECT form_id, number FROM fx_questions q WHERE form_id IN (SELECT form_id FROM fx_overrides)
AND NOT EXISTS (SELECT 1 FROM fx_overrides o WHERE o.form_id = q.form_id AND o.number = q.number)""")
def form_dropped_questions(v):
    return cat.replace_questions(v["fx_questions"], v["fx_overrides"])[1]


_WIDE = """
  SELECT form_id, upper(max(CASE WHEN p = 'FORM_SETUP_STATUS' THEN v END)) AS status, max(CASE WHEN p = 'FORM_NAME' THEN v END) AS form_name,
    coalesce(CAST(TRY_CAST(max(CASE WHEN p = 'PAGES_PER_SURVEY' THEN v END) AS DOUBLE) AS INT), 2) AS pages_per_unit, lower(coalesce(nullif(max(CASE WHEN p = 'FORM_DETECTION_MODE' THEN v END), ''), 'hybrid')) AS detection_mode,
    CAST(TRY_CAST(max(CASE WHEN p = 'FORM_INK_THRESHOLD' THEN v END) AS DOUBLE) AS INT) AS ink_threshold,
    CAST(regexp_extract(max(CASE WHEN p = 'GRID_COLUMN_CENTERS_JSON' THEN v END), ', (\\d+)\\]', 1) AS DOUBLE) AS last_column
  FROM (SELECT form_id, trim(parameter) AS p, trim(value) AS v FROM fx_form_setup) c GROUP BY form_id"""


@query("CFG-03", f"""
SELECT *, CAST(2380 AS DOUBLE) AS corner_x FROM ({_WIDE}) w WHERE status = 'APPROVED' AND pages_per_unit >= 1 AND detection_mode IN ('hybrid', 'model_only')""")
def form_approved_profiles(v):
    forms, _broken = cat.approved_forms(v["fx_form_setup"])
    return forms.select(
        "form_id", "status", "form_name", "pages_per_unit", "detection_mode", "ink_threshold",
        F.element_at("grid_columns", -1).alias("last_column"),
        F.element_at(F.element_at("baseline_marks", "0"), 2)[0].alias("corner_x"))


@query("CFG-03", f"""
SELECT form_id, 'the form setup is still a draft' AS reason FROM ({_WIDE}) w WHERE status <> 'APPROVED'
UNION ALL SELECT form_id, 'pages per survey must be at least 1' FROM ({_WIDE}) w WHERE pages_per_unit < 1
UNION ALL SELECT form_id, 'detection mode must be hybrid or model_only' FROM ({_WIDE}) w WHERE detection_mode NOT IN ('hybrid', 'model_only')""")
def form_profile_violations(v):
    return cat.approved_forms(v["fx_form_setup"])[1]


# One profile per form of the questions: two pages, mode by its smallest group key.
_FORMS = "SELECT form_id, 2 AS pages_per_unit, CASE WHEN max(group_key) > 'Brand#4' THEN 'hybrid' ELSE 'model_only' END AS detection_mode FROM fx_questions GROUP BY form_id"


def _forms(v):
    v["fx_questions"].createOrReplaceTempView("fx_questions")
    return v.spark.sql(_FORMS)


_LIST = """list_filter(list_transform(CASE WHEN contains(q.choices, '|') THEN string_split(q.choices, '|') WHEN contains(q.choices, ' / ') THEN string_split(q.choices, ' / ') ELSE CAST([] AS VARCHAR[]) END, lambda x: trim(x)), lambda x: x <> '')"""
_CHECKED = f"""
  SELECT c.form_id, c.question, c.label, coalesce(nullif(trim(layout), ''), '1') AS layout, lower(trim(control_type)) AS control_type, {_INT.format(c='c.page')} - 1 AS page, x0, q.page AS known_page, approval,
    CASE WHEN c.question = '' OR c.label = '' OR lower(trim(control_type)) NOT IN ('checkbox', 'circle') THEN 'needs a question number, choice label and control type of checkbox or circle'
      WHEN NOT coalesce(list_contains({_LIST}, c.label), FALSE) THEN 'does not match a configured question and answer choice'
      WHEN NOT (x0 < x1 AND y0 < y1) THEN 'invalid rectangle' WHEN NOT coalesce({_INT.format(c='c.page')} - 1 BETWEEN 0 AND 1, FALSE) THEN 'page is outside the configured form' END AS reason
  FROM fx_controls c LEFT JOIN ({_SCHEMA}) q ON q.form_id = c.form_id AND q.number = c.question"""
_APPROVED = f"""SELECT *, min(page) OVER w <> max(page) OVER w OR coalesce(known_page <> min(page) OVER w, FALSE) AS spread FROM ({_CHECKED}) c
  WHERE upper(trim(approval)) = 'APPROVED' AND reason IS NULL WINDOW w AS (PARTITION BY form_id, question)"""


@query("CFG-04", f"SELECT form_id, question, label, layout, control_type, page, x0 FROM ({_APPROVED}) a WHERE NOT spread")
def form_approved_controls(v):
    good, _broken = cat.approved_controls(v["fx_controls"], schema_of(v), _forms(v))
    return good.select("form_id", "question", "label", "layout", "control_type", "page", "x0")


@query("CFG-04", f"""
SELECT form_id, question, label, layout, reason FROM ({_CHECKED}) c WHERE upper(trim(approval)) = 'APPROVED' AND reason IS NOT NULL
UNION ALL SELECT form_id, question, label, layout, 'controls of the question span multiple pages' FROM ({_APPROVED}) a WHERE spread""")
def form_control_violations(v):
    return cat.approved_controls(v["fx_controls"], schema_of(v), _forms(v))[1]


@query("CFG-05", f"SELECT form_id, question, label, layout, x0 FROM ({_CHECKED}) c WHERE reason IS NULL")
def form_reference_controls(v):
    good, _broken = cat.reference_controls(v["fx_controls"], schema_of(v), _forms(v))
    return good.select("form_id", "question", "label", "layout", "x0")


@query("CFG-06", f"""
WITH h AS (SELECT form_id FROM ({_FORMS}) f WHERE detection_mode = 'hybrid'), a AS (SELECT * FROM ({_APPROVED}) a WHERE NOT spread)
SELECT form_id, 'every populated control row must be approved' AS reason FROM h WHERE form_id IN (SELECT form_id FROM fx_controls WHERE upper(trim(approval)) <> 'APPROVED')
UNION ALL SELECT form_id, 'no approved control' FROM h WHERE form_id NOT IN (SELECT form_id FROM a)
UNION ALL SELECT form_id, 'circles are supported on one question only' FROM h WHERE form_id IN (SELECT form_id FROM a WHERE control_type = 'circle' AND question <> 'H3')""")
def form_hybrid_violations(v):
    forms = _forms(v)
    approved, _broken = cat.approved_controls(v["fx_controls"], schema_of(v), forms)
    return cat.hybrid_violations(v["fx_controls"], approved, forms)


_REVIEWED = "(SELECT DISTINCT form_id FROM fx_review UNION SELECT 'lonely' || CAST(r_regionkey AS VARCHAR) FROM region) f"


@query("CFG-07", f"""
SELECT f.form_id, 'no review item' AS reason FROM {_REVIEWED} WHERE f.form_id NOT IN (SELECT form_id FROM fx_review)
UNION ALL SELECT DISTINCT form_id, 'review items are not approved' FROM fx_review WHERE upper(trim(status)) NOT IN ('APPROVED', 'REFERENCE')""")
def form_review_violations(v):
    forms = v["fx_review"].select("form_id").distinct().unionByName(
        v["region"].select(F.concat(F.lit("lonely"), F.col("r_regionkey").cast("string")).alias("form_id")))
    return cat.review_violations(v["fx_review"], forms)


@query("CFG-08", f"SELECT form_id, number FROM ({_SCHEMA}) s WHERE page IS NULL AND form_id IN (SELECT form_id FROM ({_FORMS}) f WHERE detection_mode = 'hybrid')")
def form_missing_pages(v):
    return cat.missing_pages(schema_of(v), _forms(v).filter("detection_mode = 'hybrid'"))


@query("CFG-12", """
SELECT s.form_id, s.parameter, coalesce(TRY_CAST(o.value AS DOUBLE), s.value) AS value FROM (SELECT 'form' || CAST(s_suppkey AS VARCHAR) AS form_id, 'FORM_INK_THRESHOLD' AS parameter, s_acctbal AS value FROM supplier
  UNION ALL SELECT 'form' || CAST(s_suppkey AS VARCHAR), 'FORM_NAME', 1 FROM supplier) s
LEFT JOIN (SELECT form_id, trim(parameter) AS parameter, value FROM fx_form_setup) o ON o.form_id = s.form_id AND o.parameter = s.parameter""")
def form_runtime_overrides(v):
    form = F.concat(F.lit("form"), F.col("s_suppkey").cast("string")).alias("form_id")
    defaults = v["supplier"].select(form, F.lit("FORM_INK_THRESHOLD").alias("parameter"), F.col("s_acctbal").alias("value")).unionByName(
        v["supplier"].select(form, F.lit("FORM_NAME").alias("parameter"), F.lit(1.0).alias("value")))
    overrides = v["fx_form_setup"].withColumn("parameter", F.trim("parameter"))
    return cat.runtime_overrides(defaults, overrides)
