"""Independent readings of one answer brought to one value, with every doubt noted.

Each rule is a Column of its own, null where it does not fire, so a rule can be
corrected alone. Where the rule's source is prose without a number, the number
is a parameter with our own default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formspark import functions as fx
from formspark.functions.text import DATE_PATTERNS, WHITESPACE
from formspark.operators.quality import latest_profile
from formspark.sources.readers import unpack_question_rects
from formspark.sources.writers import replace_by_folder, replace_by_key

# Least margin between best and second mark, by control.
MARGINS = {"grid": 0.05, "box": 0.15, "circle": 0.8}
MULTI_MARKED, OVERLAP, CONFIDENCE, INK_FLOOR = 0.10, 0.7, 0.7, 0.40
NEAR_ZERO = 0.02

# What a rule of an answer's format holds, in the order in which the check takes it.
RULE = (("answer_format", "string"), ("format_digits", "int"), ("date_format", "string"), ("format_year", "int"),
        ("minimum", "double"), ("maximum", "double"))
RULES = f"array<struct<{','.join(f'{name}:{kind}' for name, kind in RULE)}>>"
FORMATS = ("digits", "integer", "decimal", "date")


def _text(column: str | Column) -> Column:
    return F.trim(F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")), F.lit(WHITESPACE))


def pixel_single(cells: DataFrame, near_zero: float = NEAR_ZERO) -> DataFrame:
    """Best and second mark of each single-choice question, and whether they decide it."""
    rank = F.row_number().over(Window.partitionBy("file_name", "question").orderBy(F.desc("density"), "choice"))
    top = cells.withColumn("place", rank).filter(F.col("place") <= 2)
    pair = top.groupBy("file_name", "question").agg(
        F.max(F.when(F.col("place") == 1, F.col("choice"))).alias("best_choice"),
        F.max(F.when(F.col("place") == 1, F.col("density"))).alias("best"),
        F.max(F.when(F.col("place") == 2, F.col("density"))).alias("second"),
        F.max("control").alias("control"))
    margin = F.col("best") - F.coalesce("second", F.lit(0.0))
    blank = (F.col("best") < near_zero) & (margin < near_zero)
    least = least_margin(F.col("control"))
    return pair.select(
        "file_name", "question", "best", "second", margin.alias("margin"), blank.alias("blank"),
        F.when(~blank & (margin >= least), F.col("best_choice")).alias("pixel_choice"))


def pixel_multi(cells: DataFrame, marked: float = MULTI_MARKED) -> DataFrame:
    """Choices of each multi-select question whose own ink says marked."""
    return cells.groupBy("file_name", "question").agg(
        F.array_sort(F.collect_set(F.when(F.col("density") >= marked, F.col("choice")))).alias("pixel_choices"))


def multi_delta(model: Column, pixel: Column) -> Column:
    """``struct<veto, fill>``: model choices without ink, inked choices the model missed."""
    return F.struct(F.array_except(model, pixel).alias("veto"), F.array_except(pixel, model).alias("fill"))


def self_consistency_note(answer: Column, position: Column, choices: Column) -> Column:
    """Why an answer and its own mark position do not agree; null when they do."""
    text, place = _text(answer), _text(position)
    options = fx.split_choices(choices)
    index = place.try_cast("int")
    chosen = F.try_element_at(options, F.when(index > 0, index))
    return (
        F.when((text == "") & (place == ""), F.lit(None).cast("string"))
        .when(place == "", F.lit("no mark_position"))
        .when(text == "", F.lit("no answer text"))
        .when(index.isNull(), F.concat(F.lit("mark_position "), place, F.lit(" is not a number")))
        .when((index < 1) | (index > F.size(options)), F.concat(F.lit("mark_position "), place, F.lit(" is out of range")))
        .when(chosen != text, F.concat(F.lit("answer does not match choice at "), place))
    )


def ocr_token_ok(model: Column, ocr: Column, overlap: float = OVERLAP) -> Column:
    """Short code: equal once punctuation is off, or enough of its characters are there."""
    left, right = (F.regexp_replace(F.lower(_text(c)), "[^\\p{L}\\p{N}]", "") for c in (model, ocr))
    letters, others = (F.array_distinct(F.split(c, "")) for c in (left, right))
    share = F.size(F.array_intersect(letters, others)) / F.size(letters)
    return (left == right) | ((left != "") & (right != "") & (share >= overlap))


def ocr_freeform_ok(model: Column, ocr: Column, coverage: float = OVERLAP) -> Column:
    """Longer text: enough of the model's words are among the words read."""
    left, right = (F.filter(F.array_distinct(F.split(fx.norm_text(c), " ")), lambda w: w != "") for c in (model, ocr))
    share = F.size(F.array_intersect(left, right)) / F.nullif(F.size(left), F.lit(0))
    return F.coalesce(share >= coverage, F.size(right) == 0)


def _shown(value: Column) -> Column:
    return F.when(_text(value) == "", F.lit("(blank)")).otherwise(F.concat(F.lit("'"), _text(value), F.lit("'")))


def _optional(df: DataFrame, name: str, kind: str) -> Column:
    """A column that readings may lack; null then."""
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def least_margin(control: Column) -> Column:
    """The margin a pixel reading needs, by control; an unknown control is a box."""
    return F.when(control == "grid", MARGINS["grid"]).when(control == "circle", MARGINS["circle"]).otherwise(MARGINS["box"])


def pixel_vs_model(df: DataFrame) -> DataFrame:
    """Adds ``answer``, ``detection_method``, ``pixel_note`` and ``pixel_flag``.

    ``control`` sets the margin. Where ``calibration_validated`` is false every disagreement is flagged.
    """
    model, pixel = _text("model_answer"), F.col("pixel_answer")
    ran = F.coalesce("pixel_ran", F.lit(False))
    resolved = ran & F.coalesce((pixel != "") & (F.col("pixel_margin") >= least_margin(_optional(df, "control", "string"))), F.lit(False))
    unproven = ~F.coalesce(_optional(df, "calibration_validated", "boolean"), F.lit(True))
    blank = ran & F.coalesce(pixel == "", F.lit(False))
    keeps = F.coalesce("model_overrules", F.lit(False))
    differs, emptied = resolved & (pixel != model), blank & (model != "")
    kept_note = F.concat(F.lit("pixel read "), _shown(pixel), F.lit(", kept the model's "), _shown(F.col("model_answer")))
    return df.withColumns({
        "answer": F.when(resolved & ~keeps, pixel).when(emptied & ~keeps, F.lit("")).otherwise(model),
        "detection_method": F.when(resolved & ~keeps, "pixel").when(emptied & ~keeps, "pixel_blank").otherwise("model"),
        "pixel_note": F.when((differs | emptied) & keeps, kept_note)
        .when(emptied, F.concat(F.lit("no box confidently marked, but the model read "), _shown(F.col("model_answer"))))
        .when(differs, F.concat(F.lit("auto-corrected to the pixel reading from "), _shown(F.col("model_answer")))),
        "pixel_flag": ((differs | emptied) & (keeps | unproven)) | emptied,
    })


def apply_multi_select(df: DataFrame) -> DataFrame:
    """Adds ``multi_note``; the inked choices replace the model's unless the model overrules.

    ``model_choices`` and ``pixel_choices`` are comma-joined; a row without the first is no multi-select question.
    """
    claimed, inked = (F.split(F.coalesce(_optional(df, c, "string"), F.lit("")), ",") for c in ("model_choices", "pixel_choices"))
    delta = multi_delta(F.array_remove(claimed, ""), F.array_remove(inked, ""))
    asked = _optional(df, "model_choices", "string").isNotNull() & F.coalesce("pixel_ran", F.lit(False))
    differs = asked & ((F.size(delta["veto"]) > 0) | (F.size(delta["fill"]) > 0))
    takes = differs & ~F.coalesce("model_overrules", F.lit(False))
    why = F.concat_ws(
        " and ", F.when(F.size(delta["veto"]) > 0, F.concat(F.lit("the model claimed "), F.array_join(delta["veto"], ","))),
        F.when(F.size(delta["fill"]) > 0, F.concat(F.lit("the model missed "), F.array_join(delta["fill"], ","))))
    chosen = F.array_join(F.array_remove(inked, ""), ",")
    return df.withColumns({
        "answer": F.when(takes, chosen).otherwise(F.col("answer")),
        "detection_method": F.when(takes, "pixel_multi").otherwise(F.col("detection_method")),
        "multi_note": F.when(takes, F.concat(F.lit("reconciled to "), _shown(chosen), F.lit(": "), why))
        .when(differs, F.concat(F.lit("pixel found "), _shown(chosen), F.lit(", kept the model's choices: "), why)),
    })


def fill_comments(df: DataFrame) -> DataFrame:
    """Adds ``fill_note``; a blank answer of a ``comment_question`` takes the text read on the page, always flagged."""
    fills = F.coalesce(_optional(df, "comment_question", "boolean") & F.col("ocr_ran"), F.lit(False)) \
        & (F.col("answer") == "") & (_text("ocr_text") != "")
    return df.withColumns({
        "answer": F.when(fills, _text("ocr_text")).otherwise(F.col("answer")),
        "detection_method": F.when(fills, "ocr_fill").otherwise(F.col("detection_method")),
        "fill_note": F.when(fills, "blank comment filled from the text read on the page"),
    })


def correction_note(df: DataFrame) -> Column:
    return F.when(F.coalesce(_optional(df, "cross_out", "boolean") & F.col("pixel_ran"), F.lit(False)),
                  "the pixel reader saw a correction or cross-out")


def constraint_violations(constraints: DataFrame) -> DataFrame:
    """Rules that cannot be meant as they stand, with the reason."""
    kind = F.lower(F.coalesce("answer_format", F.lit("")))
    reason = (
        F.when((kind != "") & ~kind.isin(*FORMATS), F.concat(F.lit("unsupported answer format "), _shown(F.col("answer_format"))))
        .when(_optional(constraints, "format_digits", "int") < 1, F.lit("the digit count must be positive"))
        .when((kind == "date") & ~F.upper(F.coalesce(_optional(constraints, "date_format", "string"), F.lit("MM/DD/YYYY"))).isin(*DATE_PATTERNS),
              F.lit("unsupported date format"))
        .when(_optional(constraints, "minimum", "double") > _optional(constraints, "maximum", "double"),
              F.lit("the minimum exceeds the maximum")))
    return constraints.withColumn("reason", reason).filter("reason IS NOT NULL")


def _rule(df: DataFrame) -> Column:
    return F.struct(*[_optional(df, name, kind).cast(kind).alias(name) for name, kind in RULE])


def with_rules(df: DataFrame, constraints: DataFrame | None) -> DataFrame:
    """Adds ``rules``, an array of what the row's question asks of its answer.

    ``constraints`` holds a rule a row (``answer_format``, ``format_digits``, ``date_format``, ``format_year``, ``minimum``,
    ``maximum``, each may be missing) for ``question_number`` and, where both sides have it, ``form_id``. Without a table
    the rule is in columns of that name of the row itself.
    """
    if constraints is None:
        return df.withColumn("rules", F.array(_rule(df)))
    keys = [*(["form_id"] if {"form_id"} <= {*df.columns} & {*constraints.columns} else []), "question_number"]
    packed = constraints.groupBy(*keys).agg(F.sort_array(F.collect_list(_rule(constraints))).alias("rules"))
    return df.join(packed, keys, "left")


def format_note() -> Column:
    """Every reason why the final answer breaks a rule of its question."""

    def reason(rule: Column) -> Column:
        return fx.format_ok(F.col("answer"), *[rule[name] for name, _kind in RULE])["reason"]

    broken = F.array_distinct(F.array_compact(F.transform(F.coalesce("rules", F.array().cast(RULES)), reason)))
    return F.nullif(F.array_join(broken, "; "), F.lit(""))


def apply_ocr_authority(df: DataFrame) -> DataFrame:
    """Adds ``ocr_note``; an authoritative, non-empty OCR reading replaces the answer it contradicts."""
    read = F.coalesce("ocr_ran", F.lit(False))
    checked = F.col("ocr_check") if "ocr_check" in df.columns else F.lit("token")
    agrees = F.when(checked == "freeform", ocr_freeform_ok(F.col("model_answer"), F.col("ocr_text"))).otherwise(
        ocr_token_ok(F.col("model_answer"), F.col("ocr_text")))
    # A column of its own, so that the comparison is not repeated wherever the answer is looked at.
    df = df.withColumn("ocr_against", read & (checked != "none") & ~F.coalesce(agrees, F.lit(False)))
    against = F.col("ocr_against")
    takes = against & F.coalesce("ocr_authoritative", F.lit(False)) & (_text("ocr_text") != "")
    note = F.concat(F.lit("Cloud Vision read "), _shown(F.col("ocr_text")), F.lit(", the model read "), _shown(F.col("model_answer")))
    return df.withColumns({
        "answer": F.when(takes, _text("ocr_text")).otherwise(F.col("answer")),
        "detection_method": F.when(takes, "ocr").otherwise(F.col("detection_method")),
        "ocr_note": F.when(against, note),
    }).drop("ocr_against")


def both_blank(df_has_ocr: bool = True) -> Column:
    """Model blank, and an independent reading that ran is blank too."""
    pixel = F.coalesce(F.col("pixel_ran") & (_text("pixel_answer") == ""), F.lit(False))
    ocr = F.coalesce(F.col("ocr_ran") & (_text("ocr_text") == ""), F.lit(False)) if df_has_ocr else F.lit(False)
    return (_text("model_answer") == "") & (pixel | ocr)


def low_confidence_note(threshold: float = CONFIDENCE) -> Column:
    alone = ~F.coalesce("pixel_ran", F.lit(False)) & ~F.coalesce("ocr_ran", F.lit(False))
    return F.when(alone & ~both_blank() & (F.col("model_confidence") < threshold), F.concat(
        F.lit("self-reported confidence "), F.format_string("%.2f", "model_confidence"), F.lit(f" below {threshold}")))


def blank_note() -> Column:
    """A final blank to be confirmed, with what each source read."""
    exempt = F.coalesce("blank_exempt", F.lit(False)) | both_blank()
    readings = F.concat_ws(
        ", ", F.concat(F.lit("model said "), _shown(F.col("model_answer"))),
        F.when(F.col("pixel_ran"), F.concat(F.lit("pixel said "), _shown(F.col("pixel_answer")))),
        F.when(F.col("ocr_ran"), F.concat(F.lit("vision said "), _shown(F.col("ocr_text")))))
    return F.when((F.col("answer") == "") & ~exempt, F.concat(F.lit("confirm this is a genuine skip ("), readings, F.lit(")")))


def second_mark_note() -> Column:
    """Two marks in one question, unless the model's answer vouches for one of them."""
    model, agrees = _text("model_answer"), _text("pixel_answer") == _text("model_answer")
    vouched = F.when(F.coalesce("grid_question", F.lit(False)), agrees).otherwise(agrees | (model != ""))
    return F.when(F.coalesce("second_mark", F.lit(False)) & ~vouched, F.lit("ambiguous second mark"))


def grid_failures(df: DataFrame) -> DataFrame:
    """Files on which no grid row was located; their grid questions all need review."""
    return df.filter("grid_question").groupBy("file_name").agg(
        F.bool_or(F.coalesce("grid_row_found", F.lit(False))).alias("any_row")).filter("NOT any_row").select("file_name")


def reconcile(readings: DataFrame, constraints: DataFrame | None = None) -> DataFrame:
    """Final answer, review flag and notes of every reading, rules in order.

    What answers have to look like comes from ``constraints``, see ``with_rules``. The only exchange of the readings is the
    per-file grid check; the rules are a small table, and everything else is projection.
    """
    failed = grid_failures(readings).withColumn("grid_failed", F.lit(True))
    ruled = with_rules(readings, constraints)
    rows = fill_comments(apply_ocr_authority(apply_multi_select(pixel_vs_model(ruled)))).join(failed, "file_name", "left")
    alone = ~F.coalesce("pixel_ran", F.lit(False))
    consistency = F.when(alone, self_consistency_note(F.col("model_answer"), F.col("mark_position"), F.col("choices")))
    grid = F.when(F.col("grid_failed") & F.col("grid_question"), F.lit("answer grid could not be located on this file"))
    always = [consistency, F.col("multi_note"), F.col("ocr_note"), F.col("fill_note"), low_confidence_note(), blank_note(),
              second_mark_note(), correction_note(rows), format_note(), grid]
    flag = F.col("pixel_flag")
    for note in always:
        flag = flag | note.isNotNull()
    notes = F.array_compact(F.array(always[0], F.col("pixel_note"), *always[1:]))
    return rows.withColumns({"needs_review": flag, "review_note": F.nullif(F.array_join(notes, "; "), F.lit(""))}).select(
        *readings.columns, F.col("answer").alias("survey_answer"), "detection_method", "needs_review", "review_note")


def tiered_lookup(files: DataFrame, log: DataFrame, ts: str = "profiled_at", tie: str | None = None) -> DataFrame:
    """Newest log row by full address, else by file name; ``tier`` says which."""
    columns = [c for c in log.columns if c not in ("gcs_uri", "file_name")]
    by_uri = latest_profile(log.filter("gcs_uri IS NOT NULL"), "gcs_uri", ts, tie).select("gcs_uri", F.struct(*columns).alias("u"))
    by_name = latest_profile(log, "file_name", ts, tie).select("file_name", F.struct(*columns).alias("n"))
    joined = files.join(by_uri, "gcs_uri", "left").join(by_name, "file_name", "left")
    return joined.withColumn("hit", F.coalesce("u", "n")).select(
        *files.columns, "hit.*",
        F.when(F.col("u").isNotNull(), "gcs_uri").when(F.col("n").isNotNull(), "file_name").alias("tier"))


def rect_hints(profiles: DataFrame, keys: tuple[str, ...] = ("file_name",)) -> DataFrame:
    """Stored rectangles of the questions whose boxes were all confirmed on that file."""
    return unpack_question_rects(profiles, keys).filter(
        (F.col("boxes_total") > 0) & (F.col("boxes_confirmed") == F.col("boxes_total")))


def ink_floor(quality: Column, mark_lo: Column, usual: float = INK_FLOOR) -> Column:
    """Floor a mark must clear: the usual one, or just under the file's own on a tight scan."""
    return F.when((quality == "tight") & mark_lo.isNotNull(), F.least(F.lit(usual), mark_lo - 0.0001)).otherwise(F.lit(usual))


def report_date(folder: Column, run_date: Column) -> Column:
    return F.coalesce(fx.strict_folder_date(folder), fx.folder_date(folder, run_date))


def load_answers(target: DataFrame, new: DataFrame, scope: str = "folder") -> DataFrame:
    """Replace the answers of each incoming folder, or of each incoming file only."""
    if scope == "folder":
        return replace_by_folder(target, new)
    return replace_by_key(target, new, ["folder_name", "file_name"])
