"""Incremental intake: new documents, each once, into the manifest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from formspark.operators import manifest as man
from formspark.sources.writers import KeyedTable, saved


def new_documents(spark: SparkSession, root: str) -> DataFrame:
    """Stream of PDFs that appear below a root, without their content."""
    return (
        spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
        .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[pP][dD][fF]")
        .load(root)
        .select(F.col("path").alias("uri"), "length", F.col("modificationTime").alias("modified"))
    )


def new_inventory(spark: SparkSession, folder: str, schema: StructType, pattern: str = "*.parquet") -> DataFrame:
    """Stream of inventory files (rows of sources) that land in a folder; ``seen_at`` is when a row's file was written."""
    rows = spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)
    return rows.select("*", F.col("_metadata.file_modification_time").alias("seen_at"))


def stream_intake(sources: DataFrame, verdicts: Callable[[], DataFrame], table: KeyedTable, checkpoint: str,
                  bucket: str, prefix: str, pages_per_unit: int, moved_at: Column,
                  failures: Callable[[DataFrame], None] | None = None, once_within: str = "30 days") -> StreamingQuery:
    """Expand and judge every new source and put its rows into the manifest, then stop.

    The checkpoint remembers which files were taken, and for ``once_within`` after ``seen_at`` which sources: one that
    stands in several rows or files, in one batch or in later ones, is judged once. After that time it counts as handed in
    anew and its rows replace the old ones. State is a key for each source of that time, spread by key. A batch that is
    run again after a failure sees the same sources and replaces its own rows, so nothing is lost or doubled. Units that
    are rejected and for review at once go to ``failures``; without it they fail the batch.
    """

    def load(batch: DataFrame, _batch_id: int) -> None:
        # Every run of the batch would go through the state again, so its sources are written out once.
        with saved(batch.select("source_gcs_uri", "page_count")) as taken:
            if taken.isEmpty():
                return
            units = man.expand_units(taken, pages_per_unit)
            judged = man.categorise_units(units, verdicts()).drop("page_count", "unit_index")
            broken = man.malformed_sources(taken, verdicts(), pages_per_unit).select(*judged.columns)
            rows, both = man.manifest_rows(
                man.flag_duplicate_names(judged.unionByName(broken)), bucket, prefix, moved_at)
            table.replace(man.settled(rows, both, failures))

    return (
        sources.withWatermark("seen_at", once_within).dropDuplicatesWithinWatermark(["source_gcs_uri"])
        .writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
