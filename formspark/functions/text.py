"""Question texts, answer choices, review notes and cell values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separators of a choice cell, the present one and the older one.
CHOICE_SEPARATOR = "|"
OLD_CHOICE_SEPARATOR = " / "
# Cells that mean yes.
YES_WORDS = ("y", "yes", "true", "1")
# Review-note phrases and the category each leads to. The first
# rule that holds wins; within a rule any phrase, or all phrases of a tuple, do.
REVIEW_CATEGORIES = (
    (("cloud vision",),
     "independent OCR cross-check disagreement (Vision couldn't confirm the model's written-text answer)"),
    (("no box confidently marked",), "model answered but scan appears blank here"),
    (("auto-corrected to the pixel reading",),
     "model/pixel disagreement (auto-corrected to the pixel reading)"),
    (("reconciled to", ("claimed", "missed"), "pixel found"), "multi-select pixel reconciliation"),
    (("self-reported confidence",), "low model confidence"),
    (("does not match choice at", "is not a number", "is out of range", "no mark_position",
      "no answer text", "mark position(s)"),
     "model self-inconsistent (answer vs. mark position)"),
    (("should be a 6-digit number", "should be a date in mm/dd/yyyy format"),
     "answer doesn't match this field's expected format (H1/H6)"),
)
OWN_ACCOUNT_PHRASE = "model's own account of the scan"
OWN_ACCOUNT_CATEGORY = "model-reported scan-quality issue"
OTHER_CATEGORY = "flagged for review"
# Question type labels.
TYPE_SINGLE = "Single Choice (pick one)"
TYPE_MULTI = "Multiple Choice (pick several)"
TYPE_TOKEN = "Written Answer - Short Code or Number"
TYPE_FREEFORM = "Written Answer - Longer Text"
TYPE_UNCHECKED = "Written Answer - Not Checked by Cloud Vision"
# Header questions in form order.
HEADER_QUESTIONS = ("H1", "H2", "H3", "H4", "H5", "H6")
# Marks of an error worth another try.
RETRYABLE_MARKS = ("429", "RESOURCE_EXHAUSTED", "403", "PERMISSION_DENIED")

# Characters taken off both ends of a text.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(WHITESPACE))


def _has(text: Column, phrase) -> Column:
    if isinstance(phrase, tuple):
        return reduce(lambda a, b: a & b, [_has(text, p) for p in phrase])
    return F.contains(text, F.lit(phrase))


def _has_any(text: Column, phrases) -> Column:
    return reduce(lambda a, b: a | b, [_has(text, p) for p in phrases])


def clean(cell: Column) -> Column:
    """Null or NaN cell to an empty string, anything else trimmed."""
    text = cell.cast("string")
    return F.when(text.isNull() | (F.lower(text) == "nan"), F.lit("")).otherwise(strip(text))


def is_yes(cell: Column) -> Column:
    return F.lower(strip(F.coalesce(cell.cast("string"), F.lit("")))).isin(*YES_WORDS)


def is_choice_list(cell: Column) -> Column:
    return _has_any(F.coalesce(cell, F.lit("")), (CHOICE_SEPARATOR, OLD_CHOICE_SEPARATOR))


def _trim_nonempty(parts: Column) -> Column:
    return F.filter(F.transform(parts, strip), lambda part: part != "")


def split_choices(cell: Column) -> Column:
    """Choice cell to its options; a cell without a separator has none."""
    text = F.coalesce(cell, F.lit(""))
    parts = (
        F.when(_has(text, CHOICE_SEPARATOR), F.split(text, r"\|"))
        .when(_has(text, OLD_CHOICE_SEPARATOR), F.split(text, " / "))
        .otherwise(F.array().cast("array<string>"))
    )
    return _trim_nonempty(parts)


def join_choices(parts: Column) -> Column:
    return F.array_join(_trim_nonempty(parts), f" {CHOICE_SEPARATOR} ")


def page_range(text: Column) -> Column:
    """``"s-e"`` to ``struct<start, end, bad>``; bad means there is text but no range."""
    pattern = r"^\s*(\d+)\s*-\s*(\d+)\s*$"
    start = F.regexp_extract(text, pattern, 1).try_cast("int")
    end = F.regexp_extract(text, pattern, 2).try_cast("int")
    bad = F.coalesce((text != "") & (start.isNull() | end.isNull()), F.lit(False))
    return F.struct(start.alias("start"), end.alias("end"), bad.alias("bad"))


def question_number(survey_question: Column) -> Column:
    """Leading question number of a stored question text, ``?`` when none."""
    text = strip(F.coalesce(survey_question, F.lit("")))
    tries = []
    for separator in (". ", ") ", "."):
        head = strip(F.substring_index(text, separator, 1))
        tries.append(
            F.when(_has(text, separator) & head.rlike("^([0-9]+|[Hh][0-9]+)$"), F.upper(head))
        )
    return F.coalesce(*tries, F.lit("?"))


def review_category(note: Column) -> Column:
    """Short category of a review note."""
    raw = F.coalesce(note, F.lit(""))
    text = F.lower(raw)
    first, *rest = REVIEW_CATEGORIES
    chain = F.when(_has_any(text, first[0]), F.lit(first[1]))
    for phrases, category in rest:
        chain = chain.when(_has_any(text, phrases), F.lit(category))
    alone = _has(text, OWN_ACCOUNT_PHRASE) & ~_has(raw, ";")
    return chain.when(alone, F.lit(OWN_ACCOUNT_CATEGORY)).otherwise(F.lit(OTHER_CATEGORY))


def question_page(number: Column, override: Column | None = None) -> Column:
    """1-based page of a question: headers and 1-23 on page 1, 24-35 on page 2."""
    n = F.when(number.rlike("^(0|[1-9][0-9]{0,8})$"), number.try_cast("int"))
    usual = (
        F.when(number.isin(*HEADER_QUESTIONS) | n.between(1, 23), F.lit(1))
        .when(n.between(24, 35), F.lit(2))
    )
    return usual if override is None else F.coalesce(override.cast("int"), usual)


def norm_text(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)[\s\x1c-\x1f]+", " ")))


def _drop_colon(text: Column) -> Column:
    return strip(F.regexp_replace(strip(F.coalesce(text, F.lit(""))), r"\s*:\s*$", ""))


def clean_transcribed(number: Column, text: Column, choices: Column) -> Column:
    """``struct<question_text, choices>`` without printed colons and own number."""
    own = F.concat(F.lit(r"^\Q"), number, F.lit(r"\E\s*[.)]?\s*"))
    body = strip(F.regexp_replace(_drop_colon(text), own, F.lit("")))
    parts = split_choices(choices)
    joined = F.when(F.size(parts) > 0, join_choices(F.transform(parts, _drop_colon))).otherwise(
        _drop_colon(choices)
    )
    return F.struct(body.alias("question_text"), joined.alias("choices"))


def question_rank(number: Column) -> Column:
    """Order of questions: headers, then whole numbers, then other text."""
    is_number = number.rlike("^[0-9]+$")
    header = F.array_position(F.array(*[F.lit(h) for h in HEADER_QUESTIONS]), number)
    return F.struct(
        F.when(header > 0, 0).when(is_number, 1).otherwise(2).alias("tier"),
        F.when(header > 0, header.cast("decimal(38,0)"))
        .when(is_number, number.try_cast("decimal(38,0)"))
        .otherwise(F.lit(0).cast("decimal(38,0)")).alias("n"),
        F.when((header > 0) | is_number, F.lit("")).otherwise(number).alias("s"),
    )


def full_text(number: Column, text: Column) -> Column:
    return F.concat(number, F.lit(". "), text)


def answer_type(text: Column, choices: Column) -> Column:
    return (
        F.when(F.size(split_choices(choices)) == 0, F.lit("open-text"))
        .when(_has(F.lower(F.coalesce(text, F.lit(""))), "mark all"), F.lit("multi-select"))
        .otherwise(F.lit("single-choice"))
    )


def question_type(is_multi: Column, ocr_check: Column, choices: Column) -> Column:
    return (
        F.when(is_multi, F.lit(TYPE_MULTI))
        .when(ocr_check == "token", F.lit(TYPE_TOKEN))
        .when(ocr_check == "freeform", F.lit(TYPE_FREEFORM))
        .when(~is_choice_list(choices), F.lit(TYPE_UNCHECKED))
        .otherwise(F.lit(TYPE_SINGLE))
    )


# Date formats a question may ask for, and their Spark pattern.
DATE_PATTERNS = {
    "MM/DD/YYYY": "MM/dd/yyyy", "DD/MM/YYYY": "dd/MM/yyyy", "YYYY-MM-DD": "yyyy-MM-dd",
}


def format_ok(answer: Column, fmt: Column, digits: Column, date_format: Column,
              year: Column, minimum: Column, maximum: Column) -> Column:
    """``struct<ok, reason>`` of an answer against its question's format.

    A blank answer or a question without a format passes; blanks have their own check.
    """
    text = strip(F.coalesce(answer, F.lit("")))
    kind = F.lower(F.coalesce(fmt, F.lit("")))
    asked = F.upper(F.coalesce(date_format, F.lit("MM/DD/YYYY")))
    day = F.coalesce(*[
        F.when(asked == name, F.try_to_date(text, pattern)) for name, pattern in DATE_PATTERNS.items()
    ])
    number = text.try_cast("double")
    reason = (
        F.when((text == "") | (kind == ""), F.lit(None).cast("string"))
        .when((kind == "digits") & ~(text.rlike("^[0-9]+$") & (F.length(text) == F.coalesce(digits, F.length(text)))),
              F.concat(F.lit("should be a "), F.coalesce(digits.cast("string"), F.lit("")), F.lit("-digit number")))
        .when((kind == "integer") & ~text.rlike("^[+-]?[0-9]+$"), F.lit("should be a whole number"))
        .when((kind == "decimal") & ~text.rlike(r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)$"), F.lit("should be a number"))
        .when((kind == "date") & day.isNull(), F.concat(F.lit("should be a date in "), asked, F.lit(" format")))
        .when((kind == "date") & (F.year(day) != year), F.concat(F.lit("year should be "), year.cast("string")))
        .when(kind.isin("digits", "integer", "decimal") & (number < minimum), F.lit("is below the minimum"))
        .when(kind.isin("digits", "integer", "decimal") & (number > maximum), F.lit("is above the maximum"))
    )
    return F.struct(reason.isNull().alias("ok"), reason.alias("reason"))


def is_retryable(error: Column) -> Column:
    return F.coalesce(_has_any(error, RETRYABLE_MARKS), F.lit(False))
