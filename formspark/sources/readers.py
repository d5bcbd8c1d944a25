"""Object listings, tables, sheets and the small text inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from formspark.functions import base_name, natural_key
from formspark.sources.layouts import MANIFEST

AUDIT_COLUMNS = [
    "source_file", "source_gcs_uri", "destination_folder", "destination_gcs_uri",
    "source_page_range", "output_category", "rejected", "rejected_reason",
    "needs_review", "needs_review_reason", "moved_at",
]
FEEDBACK_COLUMNS = ["folder_name", "file_name", "question_number", "correct_answer"]
OVERRIDE_SCHEMA = "map<string,struct<question_text:string,choices:string,question_type:string>>"
RECTS_SCHEMA = (
    "map<string,struct<question:string,page_idx:int,candidate:int,kind:string,"
    "boxes_confirmed:bigint,boxes_total:bigint,baseline_correction:array<double>,"
    "rects:map<string,array<int>>>>"
)


def list_documents(spark: SparkSession, root: str) -> DataFrame:
    """Every PDF below a root (or the one file it names), without its content."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.[pP][dD][fF]")
        .load(root)
    )
    return files.select(
        F.col("path").alias("uri"),
        base_name(F.col("path")).alias("object_name"),
        "length",
        F.col("modificationTime").alias("modified"),
    )


def documents_in(listing: DataFrame, root: str, uri: str = "uri") -> DataFrame:
    """The same choice over an inventory table of object names.

    The prefix ends at a folder boundary, so ``.../scans`` does not take in
    ``.../scans_old``; a root that names one PDF stands for that file.
    """
    name = F.col(uri)
    if root.lower().endswith(".pdf"):
        return listing.filter(name == root)
    anchored = root if root.endswith("/") else root + "/"
    return listing.filter(name.startswith(anchored) & F.lower(name).endswith(".pdf"))


def select_sources(df: DataFrame, root: str, uri: str = "uri", loose_only: bool = False,
                   only_file: str | None = None, limit: int | None = None) -> DataFrame:
    """Narrow a listing: loose files only, one file name, first N in natural order."""
    rest = F.substring(F.col(uri), len(root if root.endswith("/") else root + "/") + 1, 1 << 30)
    if loose_only:
        df = df.filter(~F.contains(rest, F.lit("/")))
    if only_file is not None:
        df = df.filter(base_name(F.col(uri)) == only_file)
    if limit is not None:
        df = df.orderBy(natural_key(F.col(uri)), uri).limit(limit)
    return df


def latest_export(listing: DataFrame, prefix: str, suffix: str = ".csv", name: str = "object_name") -> DataFrame:
    """One row with the newest export's full name; no row when none matches."""
    pattern = rf"^\Q{prefix}\E\d{{8}}_\d{{6}}\Q{suffix}\E$"
    # Most names of a listing fall to the plain tests; the pattern is for the rest.
    likely = F.endswith(F.col(name), F.lit(suffix)) & F.contains(F.col(name), F.lit(prefix))
    return (
        listing.filter(likely & base_name(F.col(name)).rlike(pattern))
        .agg(F.max(name).alias(name))
        .filter(F.col(name).isNotNull())
    )


def read_feedback(spark: SparkSession, path: str) -> DataFrame:
    """Reviewer sheet as trimmed text; only a null or blank cell is no answer."""
    schema = ", ".join(f"{c} string" for c in FEEDBACK_COLUMNS)
    header = spark.read.option("header", "true").csv(path).columns
    order = ", ".join(f"`{c}` string" for c in header)
    sheet = spark.read.option("header", "true").option("nullValue", "").schema(order or schema).csv(path)
    return feedback_rows(sheet)


def feedback_rows(sheet: DataFrame) -> DataFrame:
    return sheet.select(*[F.trim(F.col(c).cast("string")).alias(c) for c in FEEDBACK_COLUMNS])


def in_folders(responses: DataFrame, folders: list[str] | DataFrame | None = None) -> DataFrame:
    """Restrict to folders: a list is pushed to the scan, a frame is a semi join."""
    if folders is None:
        return responses
    if isinstance(folders, DataFrame):
        return responses.join(folders.select("folder_name").distinct(), "folder_name", "left_semi")
    return responses.filter(F.col("folder_name").isin(*folders)) if folders else responses


def read_responses(spark: SparkSession, path: str, folders: list[str] | DataFrame | None = None) -> DataFrame:
    return in_folders(spark.read.parquet(path), folders)


def manifest_projection(df: DataFrame) -> DataFrame:
    return df.select(*AUDIT_COLUMNS)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return manifest_projection(spark.read.parquet(path))


def overrides_from_text(df: DataFrame, text: str = "value", keys: tuple[str, ...] = ()) -> DataFrame:
    """JSON objects keyed by question number, one row per question.

    ``has_text`` and ``has_choices`` tell an absent entry from an empty one.
    """
    parsed = df.select(*keys, F.explode(F.from_json(F.col(text), OVERRIDE_SCHEMA)).alias("number", "entry"))
    return parsed.select(
        *keys, "number",
        F.col("entry.question_text").alias("question_text"),
        F.col("entry.choices").alias("choices"),
        F.col("entry.question_type").alias("question_type"),
        F.col("entry.question_text").isNotNull().alias("has_text"),
        F.col("entry.choices").isNotNull().alias("has_choices"),
    )


def read_overrides(spark: SparkSession, path: str) -> DataFrame:
    return overrides_from_text(spark.read.text(path, wholetext=True))


def done_log_rows(lines: DataFrame, line: str = "value") -> DataFrame:
    text = F.trim(F.col(line))
    return lines.filter(text != "").select(text.alias("source_gcs_uri")).distinct()


def read_done_log(spark: SparkSession, path: str) -> DataFrame:
    return done_log_rows(spark.read.text(path))


def reprocess_rows(rows: DataFrame) -> DataFrame:
    def given(c: str) -> Column:
        return F.coalesce(F.col(c) != "", F.lit(False))

    return rows.filter(given("source_gcs_uri") & given("source_page_range")).select(
        "source_gcs_uri", "source_page_range"
    )


def read_reprocess_list(spark: SparkSession, path: str) -> DataFrame:
    return reprocess_rows(spark.read.option("header", "true").csv(path))


def unpack_question_rects(profiles: DataFrame, keys: tuple[str, ...] = ("file_name",),
                          column: str = "question_rects_json") -> DataFrame:
    """Stored geometry to one row per question key; bad JSON has no questions."""
    parsed = F.from_json(F.coalesce(F.col(column), F.lit("{}")), RECTS_SCHEMA)
    rows = profiles.select(*keys, F.explode(parsed).alias("question_key", "entry"))
    return rows.select(
        *keys, "question_key",
        F.coalesce(F.col("entry.question"), F.substring_index("question_key", "#", 1)).alias("question"),
        F.coalesce(F.col("entry.page_idx"), F.lit(0)).alias("page_idx"),
        F.col("entry.candidate").alias("candidate"),
        F.col("entry.kind").alias("kind"),
        F.coalesce(F.col("entry.boxes_confirmed"), F.lit(0).cast("bigint")).alias("boxes_confirmed"),
        F.coalesce(F.col("entry.boxes_total"), F.lit(0).cast("bigint")).alias("boxes_total"),
        F.col("entry.baseline_correction").alias("baseline_correction"),
        F.col("entry.rects").alias("rects"),
    )


MANIFEST_COLUMNS = [name for name, _kind, _note in MANIFEST]
