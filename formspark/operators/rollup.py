"""Answers rolled up to one row per file: what needs review, and why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formspark import functions as fx
from formspark.functions.text import OTHER_CATEGORY, OWN_ACCOUNT_CATEGORY, REVIEW_CATEGORIES

FILE = ["folder_name", "file_name"]
SEVERAL_NOTES = "several notes"
# Every category that a note can have, in the order of the texts.
CATEGORIES = sorted({*(category for _phrases, category in REVIEW_CATEGORIES), OWN_ACCOUNT_CATEGORY, OTHER_CATEGORY})


def question_lookup(responses: DataFrame) -> DataFrame:
    """Question number of each distinct stored question text."""
    texts = responses.select("survey_question").filter("survey_question <> ''").distinct()
    return texts.withColumn("question_number", fx.question_number(F.col("survey_question")))


def _numbered(responses: DataFrame, pages: DataFrame | None) -> DataFrame:
    """Answers with their flag; flagged ones also with question number, page and note."""
    flagged = F.coalesce("needs_review", F.lit(False))
    rows = responses.withColumns({
        "flagged": flagged, "qnum": F.when(flagged, fx.question_number(F.col("survey_question"))),
        "note": F.when(flagged, F.coalesce("review_note", F.lit(""))),
    })
    if pages is None:
        return rows.withColumn("page", fx.question_page(F.col("qnum")))
    override = pages.select(F.col("question_number").alias("qnum"), (F.col("page") + 1).alias("page_override"))
    return rows.join(override, "qnum", "left").withColumn(
        "page", F.when(F.col("flagged"), fx.question_page(F.col("qnum"), F.col("page_override"))))


def _with_texts(numbered: DataFrame) -> DataFrame:
    """The two strings of each flagged answer, and its place in the list."""
    number, note = F.col("qnum"), F.col("note")
    place = F.coalesce(F.concat(F.lit("page "), F.col("page").cast("string")), F.lit("page unknown"))
    return numbered.withColumns({
        "rank": F.when(F.col("flagged"), fx.question_rank(number)),
        "issue": F.when(F.col("flagged"), F.concat(F.lit("Q"), number, F.lit(": "), fx.review_category(note))),
        "area": F.concat(F.lit("Question "), number, F.lit(" ("), place, F.lit("): "), note),
    })


def file_issues(responses: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """One row per flagged answer; the long form of the two lists in the roll-up."""
    return _with_texts(_numbered(responses, pages).filter("flagged")).select(*FILE, "issue", "area", "note")


def _report_date(responses: DataFrame) -> Column:
    is_date = dict(responses.dtypes)["report_date"] == "date"
    return F.col("report_date") if is_date else fx.iso_date(F.col("report_date"))


def _times(phrase: Column, n: Column) -> Column:
    return F.when(n > 1, F.concat(phrase, F.lit(" (x"), n.cast("string"), F.lit(")"))).otherwise(phrase)


def file_quality(responses: DataFrame, refreshed_at: Column, pages: DataFrame | None = None) -> DataFrame:
    """One row per file, clean files too, with counts, lists and a summary.

    ``issues`` holds one phrase per question and category, ``unreadable_areas`` one per question and page; what was flagged
    more than once carries its number. So the lists are as long as the form, however many answers a file has. A question
    with different notes says so; the notes themselves are the rows of ``file_issues``.
    """
    names = F.array(*[F.lit(name) for name in CATEGORIES])
    category = F.array_position(names, fx.review_category(F.col("note"))).cast("int")
    # Sorts compare the digest first: names alike in their first letters are then seldom read.
    file = [F.xxhash64(*FILE).alias("file_digest"), *FILE]
    per_category = _numbered(responses, pages).withColumn("category", F.when(F.col("flagged"), category)).groupBy(
        *file, "qnum", "page", "category").agg(
            F.count("*").alias("n"), F.min("note").alias("low"), F.max("note").alias("high"),
            F.min(_report_date(responses)).alias("report_date"))
    # What has a question number was flagged.
    flagged, note = F.col("qnum").isNotNull(), F.when(F.col("low") == F.col("high"), F.col("low"))
    issue = _times(F.concat(F.lit("Q"), F.col("qnum"), F.lit(": "), F.element_at(names, F.col("category"))), F.col("n"))
    entry = F.struct(fx.question_rank(F.col("qnum")).alias("rank"), "qnum", "page", "category", "n", note.alias("note"),
                     issue.alias("issue"), _area(F.col("qnum"), F.col("page"), note, F.col("n")).alias("area"))
    gathered = per_category.groupBy("file_digest", *FILE).agg(
        F.sum("n").alias("total_question_count"),
        F.coalesce(F.sum(F.when(flagged, F.col("n"))), F.lit(0).cast("bigint")).alias("flagged_question_count"),
        F.min("report_date").alias("report_date"),
        F.sort_array(F.collect_list(F.when(flagged, entry))).alias("entries"),
    )
    total, count = F.col("total_question_count").cast("string"), F.col("flagged_question_count").cast("string")
    summary = F.when(
        F.col("flagged_question_count") > 0,
        F.concat(count, F.lit(" of "), total, F.lit(" question(s) flagged for review in "), F.col("file_name"),
                 F.lit(": "), F.array_join("issues", "; "), F.lit(".")),
    ).otherwise(F.concat(F.lit("No issues detected in "), F.col("file_name"), F.lit(" - all "), total,
                         F.lit(" question(s) passed review.")))
    return gathered.withColumn("issues", F.col("entries.issue")).select(
        *FILE, "report_date", refreshed_at.alias("refreshed_at"), F.to_date(refreshed_at).alias("refreshed_date"),
        (F.col("flagged_question_count") > 0).alias("needs_review"), "flagged_question_count", "total_question_count",
        summary.alias("issue_summary"), "issues", _areas().alias("unreadable_areas"))


def _area(number: Column, page: Column, note: Column, n: Column) -> Column:
    """The text of a question and its page; a null note stands for several."""
    place = F.coalesce(F.concat(F.lit("page "), page.cast("string")), F.lit("page unknown"))
    return _times(F.concat(F.lit("Question "), number, F.lit(" ("), place, F.lit("): "), F.coalesce(note, F.lit(SEVERAL_NOTES))), n)


def _areas() -> Column:
    """One text per question and page of ``entries``, which lie in that order; a question's categories are neighbours."""
    entries = F.col("entries")

    def same(a: Column, b: Column) -> Column:
        return (a["qnum"] == b["qnum"]) & a["page"].eqNullSafe(b["page"])

    def text(e: Column, i: Column) -> Column:
        own = F.filter(F.slice(entries, i + 1, len(CATEGORIES)), lambda other: same(other, e))
        note = F.when(F.forall(own, lambda other: other["note"].eqNullSafe(e["note"])), e["note"])
        n = F.aggregate(own, F.lit(0).cast("bigint"), lambda a, other: a + other["n"])
        return F.when((i == 0) | ~same(F.get(entries, i - 1), e), _area(e["qnum"], e["page"], note, n))

    once = F.size(F.array_distinct("entries.qnum")) == F.size(entries)
    return F.when(once, F.col("entries.area")).otherwise(F.array_compact(F.transform(entries, text)))


def quality_totals(responses: DataFrame) -> DataFrame:
    """Files, answers and files with a flagged answer, counted from the answers themselves."""
    flagged = F.coalesce("needs_review", F.lit(False))
    files = responses.groupBy(*FILE).agg(F.count("*").alias("n"), F.bool_or(flagged).alias("flagged"))
    return files.agg(F.count("*").alias("files"), F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("answers"),
                     F.count_if("flagged").alias("flagged_files"))
