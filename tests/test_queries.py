"""Every registered query against its SQL on DuckDB, and the shape of its plan."""

from __future__ import annotations

import contextlib
import io

import pytest
from compare import differences
from conftest import SMALL

import __spark_entry__ as driver
from formspark.plans import load_queries

QUERIES = load_queries()


def plan_of(frame) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        frame.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    q = QUERIES[name]
    frame = driver.queries()[name](spark, SMALL)
    plan = plan_of(frame)
    assert "CartesianProduct" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    if q.sql:
        assert differences(frame, duck, q.sql) is None
    else:
        assert frame.count() > 0


def test_entry_is_the_flagship(spark):
    frame = driver.entry(spark)
    assert frame.count() > 0
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_filters_and_columns_reach_the_scan(spark):
    from formspark.sources.readers import in_folders

    rows = spark.read.parquet(f"{SMALL}/nation.parquet").withColumnRenamed("n_name", "folder_name")
    plan = plan_of(in_folders(rows, ["FRANCE", "KENYA"]).select("folder_name"))
    assert "In(n_name, [FRANCE,KENYA])" in plan
    assert "ReadSchema: struct<n_name:string>" in plan


def test_newest_row_is_limited_before_the_exchange(spark):
    plan = plan_of(driver.queries()["quality_latest_profile"](spark, SMALL))
    assert plan.count("WindowGroupLimit") >= 2


def test_no_query_joins_without_keys(spark):
    """Nested loops appear nowhere: every join has an equality the exchange can use."""
    loops = [name for name, run in driver.queries().items()
             if not name.startswith(("intake_stream", "sink_bucketed", "sink_append", "feedback_ingest", "feedback_load"))
             and "NestedLoopJoin" in plan_of(run(spark, SMALL))]
    assert loops == []


def test_partitions_follow_the_tables(spark, tmp_path):
    """A shuffle starts with more partitions over more bytes; what a session had comes back after it."""
    from formspark.session import ADVISORY, INITIAL, INPUT_A_PART, as_came, shuffle_by_size

    as_came(spark)
    before = spark.conf.get(INITIAL, None), spark.conf.get(ADVISORY)
    started = []
    for n in (1, 20, 60):
        (tmp_path / f"{n}.parquet").write_bytes(b"x" * n * INPUT_A_PART)
        shuffle_by_size(spark, str(tmp_path))
        started.append(int(spark.conf.get(INITIAL)))
    assert started == [8, 21, 81]
    driver.queries()["op6_url_filter"](spark, SMALL)
    assert (spark.conf.get(INITIAL, None), spark.conf.get(ADVISORY)) == before
    driver.queries()["quality_failure_stubs"](spark, SMALL)
    assert int(spark.conf.get(INITIAL)) >= 8


def test_ocr_comparison_is_reckoned_once(spark):
    """However often the answer is looked at after it, the plan holds the comparison of characters once."""
    plan = driver.queries()["reading_reconciled_answers"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_intersect") == 1
