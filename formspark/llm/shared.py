"""Small helpers of the operators here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formspark.session import scratch_dir

HASH_BYTES = 32 << 20


def checkpointed(frame: DataFrame) -> DataFrame:
    """Written to the shared checkpoint folder and read back with the same partitions.

    The folder is the one in ``spark.checkpoint.dir``; a temporary one is made only where that is unset (tests).
    """
    spark = frame.sparkSession
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or scratch_dir(spark, "checkpoints"))
    return frame.checkpoint(eager=True)


def hashed_if_small(frame: DataFrame, row_bytes: Column) -> DataFrame:
    """``frame`` as the build side of a hash join where its bytes, spread over the shuffle's partitions, are few.

    Otherwise as it is, for a join that can spill. Keys have to be near unique for the parts to be of a size.
    """
    total = frame.agg(F.sum(row_bytes)).first()[0] or 0
    parts = max(1, int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return frame.hint("shuffle_hash") if total <= parts * HASH_BYTES else frame
