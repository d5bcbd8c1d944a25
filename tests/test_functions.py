from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from formspark import functions as fx


def column(spark, values, body, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in frame.select("i", body(F.col("x")).alias("y")).orderBy("i").select("y").collect()]


def test_natural_order(spark):
    names = ["Nov18_10.pdf", "nov18_2.pdf", "a ", "a1", "a01b", "a" + "9" * 40, "a1" + "0" * 40, "A"]
    frame = spark.createDataFrame([(n,) for n in names], "x string")
    got = [r[0] for r in frame.orderBy(fx.natural_key(F.col("x")), "x").collect()]
    assert got == ["A", "a1", "a01b", "a" + "9" * 40, "a1" + "0" * 40, "a ", "nov18_2.pdf", "Nov18_10.pdf"]


def test_folder_dates(spark):
    default = dt.date(2025, 12, 1)
    cases = {
        "Nov 10 2025": dt.date(2025, 11, 10), "Nov10_2025": dt.date(2025, 11, 10),
        "November 10, 2024": dt.date(2024, 11, 10), "2025-11-10": dt.date(2025, 11, 10),
        "2025_2_30": default, "Nov1": dt.date(2025, 11, 1), "20251110": default, "Sept 3 2025": default,
        "batch 12": default, "2025-13-40 May 7": dt.date(2025, 5, 7), "": default, None: default,
    }
    got = column(spark, list(cases), lambda c: fx.folder_date(c, F.lit(default)))
    assert dict(zip(cases, got, strict=True)) == cases


def test_strict_dates_and_file_names(spark):
    assert column(spark, ["Novish 3 2025", "Nov 31 2025", "Xyz 1 2025", " Dec 3 2025 "], fx.strict_folder_date) == [
        dt.date(2025, 11, 3), None, None, dt.date(2025, 12, 3)]
    got = column(spark, ["Dec14_1.pdf", "Dec32_1.pdf", "Decem1_", "may7.pdf", "Nov7"], fx.file_name_month_day)
    assert [tuple(g) if g else None for g in got] == [(12, 14), None, None, (5, 7), None]


def test_addresses(spark):
    uris = ["gs://b/x%20y/z%zz+1.pdf", "https://storage.googleapis.com//b/o", "http://elsewhere/b/o", "gs://b", "gs:///o", None]
    got = column(spark, uris, fx.parse_uri)
    assert [(g["bucket"], g["object"]) for g in got] == [
        ("b", "x y/z%zz+1.pdf"), ("b", "o"), (None, None), (None, None), (None, None), (None, None)]
    assert [g["error"] is None for g in got] == [True, True, False, False, False, False]
    assert column(spark, ["gs://b/root/Nov 1/a.pdf", "gs://b/root/a.pdf", "gs://b/other/a.pdf"],
                  lambda c: fx.relative_folder(c, F.lit("gs://b/root/"))) == ["Nov 1", None, "other"]


@pytest.mark.parametrize(("text", "number"), [
    ("H1. Provider", "H1"), ("h2) x", "H2"), ("23) a. b", "23"), ("24.Comment", "24"), ("No number", "?"),
    ("  7. x", "7"), ("", "?"), (None, "?"), ("Hx. y", "?"), ("1.5 dose. x", "1"),
])
def test_question_number(spark, text, number):
    assert column(spark, [text], fx.question_number) == [number]


def test_review_categories_in_order(spark):
    notes = {
        "Cloud Vision disagreed; self-reported confidence low": "independent OCR cross-check disagreement (Vision couldn't confirm the model's written-text answer)",
        "no box confidently marked": "model answered but scan appears blank here",
        "it claimed A but missed B": "multi-select pixel reconciliation",
        "it claimed A": "flagged for review",
        "self-reported confidence 0.2": "low model confidence",
        "no mark_position": "model self-inconsistent (answer vs. mark position)",
        "should be a date in MM/DD/YYYY format": "answer doesn't match this field's expected format (H1/H6)",
        "Model's own account of the scan: torn": "model-reported scan-quality issue",
        "model's own account of the scan; torn": "flagged for review",
        None: "flagged for review",
    }
    assert column(spark, list(notes), fx.review_category) == list(notes.values())


def test_choices(spark):
    cells = ["A|B | |C", "OP/IOP / Detox/WM", "plain", None, "a / b|c"]
    assert column(spark, cells, fx.split_choices) == [["A", "B", "C"], ["OP/IOP", "Detox/WM"], [], [], ["a / b", "c"]]
    assert column(spark, cells, lambda c: fx.join_choices(fx.split_choices(c)))[0] == "A | B | C"
    assert column(spark, ["\tYes\n", "TRUE", "on", None, "1"], fx.is_yes) == [True, True, False, False, True]
    assert column(spark, ["NaN", " x ", None], fx.clean) == ["", "x", ""]


def test_transcribed_question(spark):
    got = column(spark, ["24. Comment :", "H3 Setting:", "AB109"],
                 lambda c: fx.clean_transcribed(F.when(c.startswith("H3"), "H3").otherwise("24"), c, F.lit("Yes: | No :")))
    assert [tuple(g) for g in got] == [("Comment", "Yes | No"), ("Setting", "Yes | No"), ("AB109", "Yes | No")]


def test_pages_and_ranks(spark):
    assert column(spark, ["H6", "23", "24", "35", "36", "?", "007"], fx.question_page) == [1, 1, 2, 2, None, None, None]
    frame = spark.createDataFrame([(q,) for q in ["10", "H2", "2", "x", "H1", "H7"]], "q string")
    assert [r[0] for r in frame.orderBy(fx.question_rank(F.col("q"))).collect()] == ["H1", "H2", "2", "10", "H7", "x"]
    got = column(spark, ["3-4", " 3 - 4 ", "3", "", None, "a-b", "1-2-3"], fx.page_range)
    assert [(g["start"], g["bad"]) for g in got] == [
        (3, False), (3, False), (None, True), (None, False), (None, False), (None, True), (None, True)]


def test_verdicts(spark):
    assert column(spark, ["english", " MATCH", "UNCERTAIN", None], fx.language_ok) == [True, False, False, False]
    assert column(spark, [" MATCH"], lambda c: fx.language_ok(c, generic=True)) == [True]
    got = column(spark, ["blank declined_scribble", "OK", "", None, "UNREADABLE  DECLINED_WORD"], fx.content_verdict)
    assert [g["decline_marking"] for g in got] == ["SCRIBBLE", None, None, None, "WORD"]
    assert [g["content_issue"] is not None for g in got] == [True, False, False, False, True]
