"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession


def build_session(app: str = "formspark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here relies on.

    Partition counts are left to adaptive execution; skewed joins are split even
    where that costs another exchange, because one source or file may dominate.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


INITIAL, ADVISORY = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
SCANNED = "spark.sql.files.maxPartitionBytes"
# The JVM compiles no method of more bytecode than this; wider projections are then split instead of run uncompiled.
METHOD, METHOD_MOST = "spark.sql.codegen.hugeMethodLimit", "8000"
# Input bytes for each partition that a shuffle starts with, shuffled bytes up to which partitions are joined, bytes of a scan.
INPUT_A_PART, SHUFFLED_A_PART, SCANNED_A_PART = 4 << 20, 8 << 20, 16 << 20
# What ``shuffle_by_size`` found, by application, and what it set.
_came: dict[str, dict[str, tuple[str | None, str]]] = {}
_UNITS = {"": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def shuffle_by_size(spark: SparkSession, folder: str) -> None:
    """Shuffles start with as many partitions as the tables in ``folder`` ask for, and at least the session's number.

    What one task sorts or hashes then stays the same however large the tables are; adaptive execution joins small
    partitions, up to a size from which rows come out several times as large.
    """
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    wanted = -(-files.getContentSummary(place).getLength() // INPUT_A_PART)
    as_came(spark)
    settings = {INITIAL: str(max(int(spark.conf.get("spark.sql.shuffle.partitions")), wanted)), METHOD: METHOD_MOST}
    for key, most in ((ADVISORY, SHUFFLED_A_PART), (SCANNED, SCANNED_A_PART)):
        number, unit = re.match(r"(\d+)([kmgt]?)", spark.conf.get(key).lower()).groups()
        if int(number) * _UNITS[unit] > most:
            settings[key] = str(most)
    found = _came.setdefault(spark.sparkContext.applicationId, {})
    for key, value in settings.items():
        found[key] = (spark.conf.get(key, None), value)
        spark.conf.set(key, value)


def as_came(spark: SparkSession) -> None:
    """Undo ``shuffle_by_size``, where nobody has set the values anew since."""
    for key, (before, value) in _came.pop(spark.sparkContext.applicationId, {}).items():
        if spark.conf.get(key, None) == value:
            spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the cluster's shared checkpoint folder; nothing lies there yet.

    Where ``spark.checkpoint.dir`` is unset a temporary folder does on one machine; on a cluster that is an error, for
    executors could not see each other's files.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="spark-")
    run = spark.sql("SELECT replace(uuid(), '-', '')").first()[0]
    return f"{shared.rstrip('/')}/{name}-{run}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it lies."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def move_into_place(spark: SparkSession, source: str, target: str) -> None:
    """Put a written folder where another may lie; that one goes only when the new one stands in its place."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    new, place = path(source), path(target)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = path(place.getParent(), f"_replaced-{new.getName()}")
    had = files.exists(place)
    if had and not files.rename(place, old):
        raise OSError(f"{target} cannot be moved")
    if not files.rename(new, place):
        if had:
            files.rename(old, place)
        raise OSError(f"{source} cannot be moved to {target}")
    if had:
        files.delete(old, True)
