"""Named queries, each with the SQL that must give the same table on DuckDB."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formspark.plans.fixtures import Views, oracle


@dataclass(frozen=True)
class Query:
    """A query, the operators it stands for, and its oracle (None: rows only)."""

    run: Callable[[SparkSession, str], DataFrame]
    operators: tuple[str, ...]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(operators: str, sql: str | None = None, dates: str = ""):
    """Register a function of the views under its own name.

    The columns named in ``dates`` are compared as text, the same in both engines.
    """
    named = dates.split()
    if sql and named:
        shown = ", ".join(f"CAST({name} AS VARCHAR) AS {name}" for name in named)
        sql = f"SELECT * REPLACE ({shown}) FROM ({sql.strip()}) shown"

    def add(build: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            frame = build(Views(spark, folder))
            return frame.withColumns({name: F.col(name).cast("string") for name in named}) if named else frame

        if build.__name__ in QUERIES:
            raise ValueError(f"query {build.__name__} is registered twice")
        QUERIES[build.__name__] = Query(run, tuple(operators.split()), oracle(sql) if sql else None)
        return build

    return add
