"""Runs registered queries on Spark and their SQL on DuckDB, and compares."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from formspark.plans.fixtures import TABLES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _cell(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, (int, float)):
        if isinstance(value, float) and math.isnan(value):
            return (0, "")
        return (2, f"{float(value) + 0.0:.6f}" if value else "0.000000")
    return (3, str(value))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(frame, con, sql):
    """None when both sides hold the same table, else a short account."""
    got_columns, got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want_columns, want = rows_of(names, result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        extra, lacking = set(got) - set(want), set(want) - set(got)
        return f"rows {len(got)} != {len(want)}; extra {list(extra)[:2]} lacking {list(lacking)[:2]}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(wrong)} rows differ; spark {wrong[0][0]} duckdb {wrong[0][1]}" if wrong else None


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    from __spark_entry__ import queries
    from formspark.plans.registry import QUERIES
    from formspark.session import build_session

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    spark = build_session(master="local[8]", **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries()
    bad = 0
    for name, q in QUERIES.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            frame = q.run(spark, folder)
            if q.sql:
                problem = differences(frame, con, q.sql)
            else:
                problem = None if frame.count() else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        n = con.execute(f"SELECT count(*) FROM ({q.sql})").fetchall()[0][0] if q.sql and not problem else ""
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s rows={n} {problem or ''}", flush=True)
    print("failed", bad)
