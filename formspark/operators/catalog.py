"""Form catalogue: question schemas, overrides, controls and their approval gates.

Everything is keyed by form, so many forms and revisions are checked in one job.
A rule that is broken becomes a row, not an exception.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formspark import functions as fx

# Question type labels (lower case) and their (multi-select, OCR check) rule.
TYPE_RULES = {
    "single choice (pick one)": (False, "none"),
    "multiple choice (pick several)": (True, "none"),
    "written answer - short code or number": (False, "token"),
    "written answer - longer text": (False, "freeform"),
    "written answer - not checked by cloud vision": (False, "none"),
}
FORMATS = ("digits", "integer", "decimal", "date")
DIRECTIONS = ("right", "below")
MODES = ("hybrid", "model_only")
CONTROL_TYPES = ("checkbox", "circle")
CIRCLE_QUESTION = "H3"


def _whole(cell: Column) -> Column:
    return fx.clean(cell).try_cast("double").cast("int")


def _violations(df: DataFrame, keys: list[str], reasons: list[Column]) -> DataFrame:
    listed = df.withColumn("reason", F.explode(F.array_compact(F.array(*reasons))))
    return listed.select(*keys, "reason")


def question_schema(rows: DataFrame, pages_per_unit: int) -> tuple[DataFrame, DataFrame]:
    """Sheet rows to typed questions, and the rows whose page is outside the form.

    The older page column counts from one on a form whose values hold the last
    page number and no zero.
    """
    old_page = _whole(F.col("legacy_page"))
    seen = rows.groupBy("form_id").agg(
        (F.bool_or(F.coalesce(old_page == pages_per_unit, F.lit(False)))
         & ~F.bool_or(F.coalesce(old_page == 0, F.lit(False)))).alias("from_one"))
    kind = F.lower(fx.clean(F.col("question_type")))
    plain_check = F.lower(fx.clean(F.col("ocr_check")))
    multi = fx.is_yes(F.col("multi_select"))
    check = F.when(plain_check == "", "none").otherwise(plain_check)
    for label, (is_multi, ocr) in TYPE_RULES.items():
        multi = F.when(kind == label, F.lit(is_multi)).otherwise(multi)
        check = F.when(kind == label, F.lit(ocr)).otherwise(check)
    base = F.when(F.col("from_one") & F.lit(pages_per_unit > 1), 1).otherwise(0)
    page = F.coalesce(_whole(F.col("page_1based")) - 1, old_page - base)
    direction = F.lower(F.coalesce(F.nullif(fx.clean(F.col("direction")), F.lit("")), F.lit("right")))
    text = {c: F.nullif(fx.clean(F.col(c)), F.lit("")) for c in ("group_key", "expected_format", "anchor")}
    typed = rows.filter(fx.clean(F.col("number")) != "").join(seen, "form_id").select(
        "form_id", fx.clean(F.col("number")).alias("number"), text["group_key"].alias("group_key"),
        fx.clean(F.col("question_text")).alias("question_text"), fx.clean(F.col("choices")).alias("choices"),
        multi.alias("is_multi"), check.alias("ocr_check"),
        *[fx.is_yes(F.col(c)).alias(c) for c in ("model_overrules", "blank_exempt", "ocr_authoritative")],
        page.alias("page"), F.lower(text["expected_format"]).alias("expected_format"),
        _whole(F.col("expected_digits")).alias("expected_digits"),
        *[fx.clean(F.col(c)).try_cast("double").alias(c) for c in ("minimum", "maximum")],
        text["anchor"].alias("anchor"), F.when(text["anchor"].isNotNull(), direction).alias("direction"),
    )
    outside = F.coalesce((F.col("page") < 0) | (F.col("page") >= pages_per_unit), F.lit(False))
    errors = typed.filter(outside).select("form_id", "number", F.concat(
        F.lit("page "), (F.col("page") + 1).cast("string"),
        F.lit(f" is outside the configured {pages_per_unit}-page form")).alias("reason"))
    return typed.filter(~outside), errors


def schema_violations(schema: DataFrame) -> DataFrame:
    """Unsupported formats, counts below one, swapped limits, unknown anchor directions."""
    fmt = F.col("expected_format")
    return _violations(schema, ["form_id", "number"], [
        F.when(~fmt.isin(*FORMATS), F.concat(F.lit("unsupported expected format "), fmt)),
        F.when(F.col("expected_digits") < 1, F.lit("expected digit count must be positive")),
        F.when(F.col("minimum") > F.col("maximum"), F.lit("minimum exceeds maximum")),
        F.when(F.col("anchor").isNotNull() & ~F.col("direction").isin(*DIRECTIONS),
               F.lit("anchor direction must be right or below")),
    ])


def empty_forms(forms: DataFrame, schema: DataFrame) -> DataFrame:
    """Forms without any question."""
    return forms.select("form_id").distinct().join(schema, "form_id", "left_anti")


def patch_questions(schema: DataFrame, overrides: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Listed questions take the override's text and choices; unknown numbers are returned."""
    given = overrides.select("form_id", "number", F.col("question_text").alias("o_text"), F.col("choices").alias("o_choices"))
    patched = schema.join(given, ["form_id", "number"], "left").withColumns({
        "question_text": F.coalesce("o_text", "question_text"), "choices": F.coalesce("o_choices", "choices"),
    }).select(*schema.columns)
    unknown = given.join(schema, ["form_id", "number"], "left_anti").select("form_id", "number")
    return patched, unknown


def replace_questions(schema: DataFrame, overrides: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The overrides are each form's whole list; questions they leave out are returned."""
    old = schema.select("form_id", "number", "group_key", F.col("question_text").alias("old_text"))
    replaced = overrides.join(old, ["form_id", "number"], "left").select(
        "form_id", "number", "group_key",
        F.coalesce("question_text", "old_text", F.lit("")).alias("question_text"),
        F.coalesce("choices", F.lit("")).alias("choices"))
    touched = schema.join(overrides.select("form_id").distinct(), "form_id", "left_semi")
    dropped = touched.join(overrides, ["form_id", "number"], "left_anti").select("form_id", "number")
    return replaced, dropped.orderBy("form_id", F.length("number"), "number")


def approved_forms(setup: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Form profiles with parsed values, and why the others may not run."""
    names = ["FORM_SETUP_STATUS", "FORM_NAME", "PAGES_PER_SURVEY", "FORM_DETECTION_MODE", "FORM_INK_THRESHOLD",
             "GRID_COLUMN_CENTERS_JSON", "BASELINE_MARKS_JSON"]
    cells = setup.select("form_id", fx.clean(F.col("parameter")).alias("p"), fx.clean(F.col("value")).alias("v"))
    wide = cells.groupBy("form_id").agg(*[F.max(F.when(F.col("p") == n, F.col("v"))).alias(n.lower()) for n in names])

    def given(name: str) -> Column:
        return F.nullif(F.col(name), F.lit(""))

    parsed = wide.select(
        "form_id", F.upper(F.coalesce("form_setup_status", F.lit("APPROVED"))).alias("status"), given("form_name").alias("form_name"),
        F.coalesce(given("pages_per_survey").try_cast("double").cast("int"), F.lit(2)).alias("pages_per_unit"),
        F.lower(F.coalesce(given("form_detection_mode"), F.lit("hybrid"))).alias("detection_mode"),
        given("form_ink_threshold").try_cast("double").cast("int").alias("ink_threshold"),
        F.from_json("grid_column_centers_json", "array<double>").alias("grid_columns"),
        F.from_json("baseline_marks_json", "map<string,array<array<double>>>").alias("baseline_marks"),
    )
    reasons = [
        F.when(F.col("status") != "APPROVED", F.lit("the form setup is still a draft")),
        F.when(F.col("pages_per_unit") < 1, F.lit("pages per survey must be at least 1")),
        F.when(~F.col("detection_mode").isin(*MODES), F.lit("detection mode must be hybrid or model_only")),
    ]
    broken = _violations(parsed, ["form_id"], reasons)
    return parsed.join(broken, "form_id", "left_anti"), broken


def _checked_controls(rows: DataFrame, schema: DataFrame, forms: DataFrame) -> tuple[DataFrame, DataFrame]:
    shaped = rows.select(
        "form_id", fx.clean(F.col("question")).alias("question"), fx.clean(F.col("label")).alias("label"),
        F.lower(fx.clean(F.col("control_type"))).alias("control_type"), (_whole(F.col("page")) - 1).alias("page"),
        F.coalesce(F.nullif(fx.clean(F.col("layout")), F.lit("")), F.lit("1")).alias("layout"), "x0", "x1", "y0", "y1")
    choices = schema.select("form_id", F.col("number").alias("question"), fx.split_choices(F.col("choices")).alias("known"))
    joined = shaped.join(choices, ["form_id", "question"], "left").join(forms.select("form_id", "pages_per_unit"), "form_id", "left")
    inside = (F.col("page") >= 0) & (F.col("page") < F.coalesce("pages_per_unit", F.lit(2)))
    reason = (
        F.when((F.col("question") == "") | (F.col("label") == "") | ~F.col("control_type").isin(*CONTROL_TYPES),
               F.lit("needs a question number, choice label and control type of checkbox or circle"))
        .when(~F.coalesce(F.array_contains("known", F.col("label")), F.lit(False)),
              F.lit("does not match a configured question and answer choice"))
        .when(~F.coalesce((F.col("x0") < F.col("x1")) & (F.col("y0") < F.col("y1")), F.lit(False)), F.lit("invalid rectangle"))
        .when(~F.coalesce(inside, F.lit(False)), F.lit("page is outside the configured form"))
    )
    checked = joined.withColumn("reason", reason).drop("known", "pages_per_unit")
    return checked.filter("reason IS NULL").drop("reason"), checked.filter("reason IS NOT NULL").select(
        "form_id", "question", "label", "layout", "reason")


def approved_controls(rows: DataFrame, schema: DataFrame, forms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Approved control rows that hold together, and why the other approved ones do not."""
    approved = rows.filter(F.upper(fx.clean(F.col("approval"))) == "APPROVED")
    good, broken = _checked_controls(approved, schema, forms)
    known_page = schema.select("form_id", F.col("number").alias("question"), F.col("page").alias("known_page"))
    spread = good.join(known_page, ["form_id", "question"], "left").groupBy("form_id", "question").agg(
        F.min("page").alias("low"), F.max("page").alias("high"), F.max("known_page").alias("known_page")).filter(
        (F.col("low") != F.col("high")) | (F.col("known_page") != F.col("low"))).select("form_id", "question")
    moved = good.join(spread, ["form_id", "question"], "left_semi").select(
        "form_id", "question", "label", "layout", F.lit("controls of the question span multiple pages").alias("reason"))
    return good.join(spread, ["form_id", "question"], "left_anti"), broken.unionByName(moved)


def reference_controls(rows: DataFrame, schema: DataFrame, forms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Generated geometry rows under the same checks, without approval; blank rows go."""
    blank = F.lit(True)
    for column in ("question", "label", "control_type"):
        blank = blank & (fx.clean(F.col(column)) == "")
    return _checked_controls(rows.filter(~blank), schema, forms)


def hybrid_violations(rows: DataFrame, approved: DataFrame, forms: DataFrame) -> DataFrame:
    """Forms in hybrid mode that are not ready for it."""
    hybrid = forms.filter("detection_mode = 'hybrid'").select("form_id")
    pending = rows.filter(F.upper(fx.clean(F.col("approval"))) != "APPROVED").select("form_id").distinct()
    counts = approved.groupBy("form_id").agg(
        F.count("*").alias("controls"),
        F.count_if((F.col("control_type") == "circle") & (F.col("question") != CIRCLE_QUESTION)).alias("circles"))
    joined = hybrid.join(counts, "form_id", "left").join(pending.withColumn("pending", F.lit(True)), "form_id", "left")
    return _violations(joined, ["form_id"], [
        F.when(F.col("pending"), F.lit("every populated control row must be approved")),
        F.when(F.col("controls").isNull(), F.lit("no approved control")),
        F.when(F.col("circles") > 0, F.lit("circles are supported on one question only")),
    ])


def review_violations(review: DataFrame, forms: DataFrame) -> DataFrame:
    """Approved forms with no review item, or one that is neither approved nor reference."""
    status = F.upper(fx.clean(F.col("status")))
    counts = review.groupBy("form_id").agg(F.count_if(~status.isin("APPROVED", "REFERENCE")).alias("open_items"))
    joined = forms.select("form_id").join(counts, "form_id", "left")
    return _violations(joined, ["form_id"], [
        F.when(F.col("open_items").isNull(), F.lit("no review item")),
        F.when(F.col("open_items") > 0, F.lit("review items are not approved")),
    ])


def missing_pages(schema: DataFrame, forms: DataFrame) -> DataFrame:
    """Questions of approved forms that have no page."""
    return schema.filter(F.col("page").isNull()).join(forms.select("form_id"), "form_id", "left_semi").select(
        "form_id", "number")


def runtime_overrides(defaults: DataFrame, overrides: DataFrame, enabled: bool = True) -> DataFrame:
    """Calibration parameters with the table's values in place of the built-in ones."""
    if not enabled:
        return defaults
    given = overrides.select("form_id", "parameter", F.col("value").try_cast("double").alias("given"))
    return defaults.join(given, ["form_id", "parameter"], "left").withColumn(
        "value", F.coalesce("given", "value")).select(*defaults.columns)
