"""Appends, keyed replacement, logs and packed columns.

The frame functions return lazy plans, so a dry run is simply not writing them.
Parquet has no MERGE or DELETE. A table that must take replacements is partitioned
by a hash bucket of its key: a replaced row and its new row then share a bucket, so
a batch reads and rewrites only the buckets it touches, by Spark's dynamic partition
overwrite. Every write lands in a folder of its own first, so a job that fails leaves
what was there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formspark.session import move_into_place, remove_path, scratch_dir

BUCKET = "key_bucket"


class NothingToLoad(ValueError):
    """An append was asked for without any row."""


def append_partitioned(df: DataFrame, path: str, by: str, load_id: str) -> DataFrame:
    """Append one load, partitioned by a date; returns one row (rows, partitions).

    Every load owns a folder, so running a load again replaces itself instead of
    doubling. The load is written beside the log, in a folder that readers skip, and
    moved into place when it is whole: a run that fails leaves the load's earlier run.
    The counts come from the files' footers alone. The rebalance hint splits a dominant
    date over several tasks. An empty frame is an error and changes nothing either.
    """
    if df.isEmpty():
        raise NothingToLoad("nothing to load: the frame has no rows")
    spark, root = df.sparkSession, path.rstrip("/")
    aside = f"{root}/_writing-{spark.sql('SELECT uuid()').first()[0]}"
    try:
        df.hint("rebalance", by).write.partitionBy(by).parquet(aside)
    except Exception:
        remove_path(spark, aside)
        raise
    folder = f"{root}/load_id={load_id}"
    move_into_place(spark, aside, folder)
    return spark.read.schema(df.schema).parquet(folder).agg(F.count("*").alias("rows"), F.count_distinct(by).alias("partitions"))


def read_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Every load of an append log, as declared; what a load lacks is null. No footer is opened to find that out."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("load_id", T.StringType())])).parquet(path)


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def without_keys(target: DataFrame, keys_gone: DataFrame, keys: list[str]) -> DataFrame:
    """Target without the rows whose key (nulls equal) is among the given ones."""
    return target.join(keys_gone, _null_safe(target, keys_gone, keys), "left_anti")


def replace_by_key(target: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Target without the rows whose key (nulls equal) comes in, plus the new rows."""
    return without_keys(target, new.select(*keys).distinct(), keys).unionByName(new, allowMissingColumns=True)


def replace_by_folder(target: DataFrame, new: DataFrame, replace: bool = True,
                      folder: str = "folder_name") -> DataFrame:
    """Drop every row of each non-empty incoming folder, then add the new rows."""
    if replace:
        named = F.coalesce(F.col(folder) != "", F.lit(False))
        target = target.join(new.filter(named).select(folder).distinct(), folder, "left_anti")
    return target.unionByName(new, allowMissingColumns=True)


class KeyedTable:
    """A Parquet table, partitioned by a hash bucket of its key, that takes keyed replacement.

    Rows spread over the buckets by their whole key, so a dominant source does not fill one
    bucket. A table replaced by folder is bucketed by folder alone. Rows come in as ``schema``
    declares them: a column they lack is null, one that is not declared is an error. One
    writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], schema: T.StructType, buckets: int = 1024,
                 by_folder: bool = False):
        self.spark, self.path, self.keys, self.schema, self.buckets = spark, path.rstrip("/"), keys, schema, buckets
        self.bucket_keys = keys[:1] if by_folder else keys

    def _declared(self, df: DataFrame) -> DataFrame:
        strange = set(df.columns) - set(self.schema.names)
        if strange:
            raise ValueError(f"the table declares no {sorted(strange)}")
        rows = df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                           for f in self.schema.fields])
        return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*self.bucket_keys), F.lit(self.buckets)).cast("int"))

    def _rows(self) -> DataFrame:
        shape = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        try:
            return self.spark.read.schema(shape).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], shape)

    def read(self) -> DataFrame:
        return self._rows().drop(BUCKET)

    def is_empty(self) -> bool:
        return self._rows().isEmpty()

    def append(self, new: DataFrame) -> None:
        self._declared(new).hint("rebalance", BUCKET).write.mode("append").partitionBy(BUCKET).parquet(self.path)

    def replace(self, new: DataFrame, gone: DataFrame | None = None) -> int:
        """Replace by the table's keys; returns the number of buckets rewritten. The first load just fills the table.

        Rows whose key is in ``gone`` go too, whether or not new ones come for them.
        """
        if gone is None:
            return self._rewrite(new, lambda old, rows: replace_by_key(old, rows, self.keys))
        keys = gone.select(*self.keys).distinct()
        return self._rewrite(new, lambda old, rows: replace_by_key(without_keys(old, keys, self.keys), rows, self.keys), keys)

    def replace_folders(self, new: DataFrame) -> int:
        """Replace every row of the non-empty folders that come in."""
        if self.bucket_keys != self.keys[:1]:
            raise ValueError("the table is not bucketed by folder")
        return self._rewrite(new, lambda old, rows: replace_by_folder(old, rows, folder=self.keys[0]))

    def _rewrite(self, new: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], gone: DataFrame | None = None) -> int:
        """Rewrite the buckets that the new rows, and keys to be ``gone``, fall in.

        An empty table has nothing to merge, so its first rows are written once. Otherwise the new rows are written out
        first, because they are read twice and their lineage may start in this very table. A dynamic overwrite puts its
        files beside the table and moves them in when all are there, so the merged buckets are read from the table itself
        and go straight into it. The bucket list is at most ``buckets`` integers.

        A bucket that loses its last row would be left as it was by the overwrite, so its folder is removed after it;
        where keys are to be ``gone`` the merged buckets are written out to find those.
        """
        if self.is_empty():
            self.append(new)
            return self._rows().select(BUCKET).distinct().count()
        with saved(self._declared(new)) as rows:
            buckets = rows.select(BUCKET)
            if gone is not None:
                buckets = buckets.unionByName(self._declared(gone).select(BUCKET))
            touched = [row[0] for row in buckets.distinct().collect()]
            if touched:
                old = self._rows().filter(F.col(BUCKET).isin(touched)).drop(BUCKET)
                merged = self._declared(merge(old, rows.drop(BUCKET)))
                if gone is None:
                    self._overwrite(merged)
                else:
                    with saved(merged) as whole:
                        self._overwrite(whole)
                        left = {row[0] for row in whole.select(BUCKET).distinct().collect()}
                    for bucket in set(touched) - left:
                        remove_path(self.spark, f"{self.path}/{BUCKET}={bucket}")
            return len(touched)

    def _overwrite(self, rows: DataFrame) -> None:
        rows.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy(BUCKET).parquet(self.path)


@contextmanager
def saved(df: DataFrame) -> Iterator[DataFrame]:
    """The frame written once to the shared folder and read back, cut from its lineage; removed at the end."""
    path = scratch_dir(df.sparkSession, "saved")
    try:
        df.write.parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        remove_path(df.sparkSession, path)


def stored(df: DataFrame) -> DataFrame:
    """As ``saved``, for a frame that outlives the call: its copy stays until the shared folder is cleared."""
    path = scratch_dir(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def failure_rows(manifest: DataFrame, errors: DataFrame | None, failed_at: Column) -> DataFrame:
    """One row per rejected or review-flagged unit, and one per failed source."""
    uri = F.col("source_gcs_uri")
    units = manifest.filter(F.col("rejected") | F.col("needs_review")).select(
        failed_at.alias("failed_at_utc"),
        uri.alias("source_uri"),
        F.when(F.coalesce(F.col("source_page_range") != "", F.lit(False)),
               F.concat(uri, F.lit(" (pages "), F.col("source_page_range"), F.lit(")")))
        .otherwise(uri).alias("bad_pdf"),
        F.coalesce("rejected_reason", "needs_review_reason").alias("error"),
    )
    if errors is None:
        return units
    return units.unionByName(errors.select(
        failed_at.alias("failed_at_utc"), F.col("source_gcs_uri").alias("source_uri"),
        F.col("source_gcs_uri").alias("bad_pdf"), F.col("error"),
    ))


def issue_rows(audited: DataFrame) -> DataFrame:
    """Audit rows as they go to the issues file: problems in one text column."""
    return audited.filter(F.size("problems") > 0).withColumn(
        "issues", F.array_join("problems", " | ")
    ).drop("problems")


def write_issues(audited: DataFrame, path: str) -> None:
    issue_rows(audited).write.mode("append").option("header", "true").csv(path)


def append_done_log(sources: DataFrame, path: str) -> None:
    """Log finished sources; called after their issues are written."""
    done = sources.select(F.col("source_gcs_uri").alias("value")).filter("value IS NOT NULL").distinct()
    done.write.mode("append").text(path)


def pack_question_rects(questions: DataFrame, keys: tuple[str, ...] = ("file_name",)) -> DataFrame:
    """Per-question geometry rows to one JSON column keyed by question key.

    Rows of one key are first reduced to one, so the packed map is as large as
    the form's question list and no larger.
    """
    entry = F.struct(
        "page_idx", "candidate", "kind", "boxes_confirmed", "boxes_total", "baseline_correction", "rects"
    )
    single = questions.groupBy(*keys, "question_key").agg(
        F.max_by(entry, F.struct("boxes_confirmed", "boxes_total", F.to_json("rects"))).alias("entry")
    )
    packed = single.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("question_key", "entry"))).alias("entries")
    )
    names = F.array_sort(F.map_keys("entries"))
    ordered = F.map_from_arrays(names, F.transform(names, lambda name: F.element_at("entries", name)))
    return packed.select(*keys, F.to_json(ordered).alias("question_rects_json"))
