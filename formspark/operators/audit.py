"""Checks of the manifest against reality, and what to do again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formspark import functions as fx
from formspark.operators import manifest as man
from formspark.sources.readers import AUDIT_COLUMNS
from formspark.sources.writers import replace_by_key

# The texts of the problems, here and below.


def _quoted(value: Column) -> Column:
    """Text in quotes as the problem messages show it; null shows as None."""
    double = F.contains(value, F.lit("'")) & ~F.contains(value, F.lit('"'))
    return F.coalesce(
        F.when(double, F.concat(F.lit('"'), value, F.lit('"'))).otherwise(
            F.concat(F.lit("'"), F.replace(value, F.lit("'"), F.lit("\\'")), F.lit("'"))
        ),
        F.lit("None"),
    )


def _problems(*parts: Column) -> Column:
    return F.array_compact(F.array(*parts))


def placement_problems(bucket: str, prefix: str) -> Column:
    """Is the destination in the bucket, prefix, category folder and source folder it should be in?"""
    uri, category, folder = (F.col(c) for c in ("destination_gcs_uri", "output_category", "destination_folder"))
    root = f"gs://{bucket}/"
    in_bucket = uri.startswith(root)
    rel = F.substring(uri, len(root) + 1, 1 << 30)
    in_prefix = rel.startswith(prefix)
    rel = F.substring(rel, len(prefix) + 1, 1 << 30)
    wanted = fx.category_subdir(category)
    has_subdir = (wanted != "") & F.startswith(rel, wanted)
    below = F.when(has_subdir, F.substring(rel, F.length(wanted) + 1, F.length(rel))).otherwise(rel)
    shown = F.concat(F.lit("output_category="), _quoted(category), F.lit(" but destination path "))
    astray = [
        F.when((wanted == "") & rel.startswith(bad),
               F.concat(shown, F.lit(f"starts with '{bad}': "), _quoted(rel)))
        for bad in ("Declined/", "Rejected/")
    ]
    checks = _problems(
        F.when((wanted != "") & ~has_subdir,
               F.concat(shown, F.lit("doesn't start with "), _quoted(wanted), F.lit(": "), _quoted(rel))),
        *astray,
        F.when((folder != "") & ~F.startswith(below, F.concat(folder, F.lit("/"))),
               F.concat(F.lit("destination_folder="), _quoted(folder), F.lit(
                   " doesn't match destination_gcs_uri's source-name folder segment: "), _quoted(below))),
    )
    return (
        F.when(uri.isNull(), F.array().cast("array<string>"))
        .when(~in_bucket, F.array(F.concat(F.lit("destination_gcs_uri not under expected bucket: "), _quoted(uri))))
        .when(~in_prefix, F.array(F.concat(F.lit("destination_gcs_uri not under DESTINATION_PREFIX: "), _quoted(uri))))
        .otherwise(checks)
    )


def check_placement(manifest: DataFrame, bucket: str, prefix: str) -> DataFrame:
    return manifest.withColumn("problems", placement_problems(bucket, prefix)).filter(F.size("problems") > 0)


def check_destination(manifest: DataFrame, listing: DataFrame, bucket: str) -> DataFrame:
    """Manifest rows whose destination, in our bucket, is not in the listing."""
    uri = F.col("destination_gcs_uri")
    missing = manifest.filter(uri.startswith(f"gs://{bucket}/")).join(
        listing.select(F.col("uri").alias("destination_gcs_uri")).distinct(), "destination_gcs_uri", "left_anti"
    )
    return missing.select(*manifest.columns, F.array(
        F.concat(F.lit("destination file does not exist in GCS: "), uri)).alias("problems"))


def category_problems(page_count: Column, language_verdict: Column, content: Column) -> Column:
    """Stored category and flags against what fresh verdicts say."""
    text = F.col("source_page_range")
    pages = fx.page_range(text)
    issue, marking = content["content_issue"], content["decline_marking"]
    note = F.when(~fx.language_ok(language_verdict),
                  F.lit("the survey appears to be written in a language other than English"))
    expected = (
        F.when(marking.isNotNull(), F.lit("declined")).when(issue.isNotNull(), F.lit("rejected"))
        .otherwise(F.lit("normal"))
    )
    stored = F.col("output_category")

    def flag(name: str, wanted: Column) -> Column:
        held = F.coalesce(F.col(name), F.lit(False))
        shown = [F.when(b, F.lit("True")).otherwise(F.lit("False")) for b in (wanted, held)]
        return F.when(held != wanted, F.concat(
            F.lit(f"re-check says {name} should be "), shown[0], F.lit(" but manifest has "), shown[1]))

    checks = _problems(
        F.when(~expected.eqNullSafe(stored), F.concat(
            F.lit("re-check says output_category should be "), _quoted(expected),
            F.lit(" (content_issue="), _quoted(issue), F.lit(", decline_marking="), _quoted(marking),
            F.lit(", language_note="), _quoted(note), F.lit("), but manifest has "), _quoted(stored))),
        flag("rejected", expected == "rejected"),
        flag("needs_review", (expected == "declined") | ((expected == "normal") & note.isNotNull())),
    )
    outside = (pages["start"] < 1) | (pages["end"] > page_count) | (pages["start"] > pages["end"])
    return (
        F.when(F.coalesce(text == "", F.lit(True)), F.array().cast("array<string>"))
        .when(pages["bad"], F.array(F.concat(F.lit("unparseable source_page_range: "), _quoted(text))))
        .when(outside, F.array(F.concat(
            F.lit("source_page_range "), _quoted(text), F.lit(" out of bounds for a "),
            page_count.cast("string"), F.lit("-page source"))))
        .otherwise(checks)
    )


def _with_verdict(manifest: DataFrame, verdicts: DataFrame, pages_per_unit: int) -> DataFrame:
    start = fx.page_range(F.col("source_page_range"))["start"]
    index = F.floor((start - 1) / pages_per_unit).cast("int") + 1
    judged = verdicts.select(*man.VERDICT_KEY, "language_verdict", "content_verdict")
    return manifest.withColumn("unit_index", index).join(judged, man.VERDICT_KEY, "left")


def check_category(manifest: DataFrame, verdicts: DataFrame, sources: DataFrame, pages_per_unit: int) -> DataFrame:
    """Rows of well-formed sources whose stored category or flags a re-check contradicts."""
    sized = manifest.join(
        sources.select("source_gcs_uri", "page_count").filter(F.col("page_count") % pages_per_unit == 0),
        "source_gcs_uri",
    )
    found = category_problems(
        F.col("page_count"), F.col("language_verdict"), fx.content_verdict(F.col("content_verdict"))
    )
    return (
        _with_verdict(sized, verdicts, pages_per_unit).withColumn("problems", found)
        .filter(F.size("problems") > 0).select(*manifest.columns, "problems")
    )


def _bare_rows(df: DataFrame, problem: Column) -> DataFrame:
    """Rows that stand for a source rather than a manifest entry."""
    known = {"source_file", "source_gcs_uri", "source_page_range"}
    kinds = {"rejected": "boolean", "needs_review": "boolean", "moved_at": "timestamp"}
    return df.select(
        *[F.col(c) if c in known else F.lit(None).cast(kinds.get(c, "string")).alias(c) for c in AUDIT_COLUMNS],
        F.array(problem).alias("problems"),
    )


def _source_files(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("source_gcs_uri").agg(
        F.min("source_file").alias("source_file"),
        F.count("*").alias("manifest_rows"),
        F.max(F.when(F.col("rejected"), F.col("rejected_reason"))).alias("rejection"),
    )


def missing_units(sources: DataFrame, manifest: DataFrame, pages_per_unit: int) -> DataFrame:
    """Expected page ranges of audited, well-formed sources without a manifest row, by first page."""
    named = sources.join(_source_files(manifest).select("source_gcs_uri", "source_file"), "source_gcs_uri")
    expected = man.expand_units(named.select("source_gcs_uri", "page_count", "source_file"), pages_per_unit)
    gone = expected.join(manifest.select(*man.KEY).distinct(), man.KEY, "left_anti")
    return _bare_rows(gone, _missing_text())


def _missing_text() -> Column:
    return F.concat(F.lit("no manifest row at all for page range "), F.col("source_page_range"), F.lit(" of this source PDF"))


def _malformed_text(pages: Column, pages_per_unit: int) -> Column:
    return F.concat(F.lit("source PDF has "), pages.cast("string"), F.lit(
        f" page(s), not a multiple of {pages_per_unit} - cannot verify completeness by page range"))


def _rejected_as_malformed(pages: Column) -> Column:
    """Whether the source's one manifest row is a rejection that names the page count."""
    return F.coalesce(
        (F.col("manifest_rows") == 1)
        & F.contains(F.col("rejection"), F.concat(pages.cast("string"), F.lit(" page(s)")))
        & F.contains(F.col("rejection"), F.lit("not a multiple of")),
        F.lit(False),
    )


def check_malformed(sources: DataFrame, manifest: DataFrame, pages_per_unit: int) -> DataFrame:
    """Malformed sources that are not already one rejected row naming the page count."""
    joined = sources.filter(F.col("page_count") % pages_per_unit != 0).join(_source_files(manifest), "source_gcs_uri")
    rows = joined.filter(~_rejected_as_malformed(F.col("page_count"))).withColumn("source_page_range", F.lit(None).cast("string"))
    return _bare_rows(rows, _malformed_text(F.col("page_count"), pages_per_unit))


def with_source_problem(manifest: DataFrame, listing: DataFrame, open_errors: DataFrame | None,
                        bucket: str) -> DataFrame:
    """Adds ``source_problem``: address not ours, source gone, or source would not open."""
    there = listing.select(F.col("uri").alias("source_gcs_uri")).distinct().withColumn("there", F.lit(True))
    rows = manifest.join(there, "source_gcs_uri", "left")
    if open_errors is not None:
        failed = open_errors.groupBy("source_gcs_uri").agg(F.min("error").alias("open_error"))
        rows = rows.join(failed, "source_gcs_uri", "left")
    else:
        rows = rows.withColumn("open_error", F.lit(None).cast("string"))
    return rows.select(*manifest.columns, _source_problem(bucket).alias("source_problem"))


def _source_problem(bucket: str) -> Column:
    uri = F.col("source_gcs_uri")
    return (
        F.when(~F.coalesce(uri.startswith(f"gs://{bucket}/"), F.lit(False)),
               F.concat(F.lit("unrecognized source_gcs_uri: "), _quoted(uri)))
        .when(F.col("there").isNull(), F.concat(F.lit("source PDF no longer exists in GCS: "), uri))
        .when(F.col("open_error").isNotNull(),
              F.concat(F.lit("failed to open source PDF: "), F.col("open_error")))
    )


def check_source(manifest: DataFrame, listing: DataFrame, open_errors: DataFrame | None, bucket: str) -> DataFrame:
    flagged = with_source_problem(manifest, listing, open_errors, bucket).filter("source_problem IS NOT NULL")
    return flagged.select(*manifest.columns, F.array("source_problem").alias("problems"))


def _source_facts(manifest: DataFrame, sources: DataFrame, listing: DataFrame, open_errors: DataFrame | None,
                  bucket: str) -> DataFrame:
    """A row for each source of the manifest: its file, rows, rejection and page count, and ``source_problem``.

    What is wrong with a source is the same for all its rows, so it is found out once for each.
    """
    there = listing.select(F.col("uri").alias("source_gcs_uri")).distinct().withColumn("there", F.lit(True))
    facts = _source_files(manifest).join(there, "source_gcs_uri", "left").join(
        sources.select("source_gcs_uri", "page_count"), "source_gcs_uri", "left")
    if open_errors is not None:
        failed = open_errors.groupBy("source_gcs_uri").agg(F.min("error").alias("open_error"))
        facts = facts.join(failed, "source_gcs_uri", "left")
    else:
        facts = facts.withColumn("open_error", F.lit(None).cast("string"))
    return facts.withColumn("source_problem", _source_problem(bucket)).drop("there", "open_error")


def _without_rows(facts: DataFrame, manifest: DataFrame, pages_per_unit: int) -> DataFrame:
    """Rows for what sound sources lack in the manifest: units of well-formed ones, and malformed ones not rejected as such."""
    n, size = F.col("page_count"), pages_per_unit
    starts = F.sequence(F.lit(0), (n - size).cast("int"), F.lit(size))
    units = F.transform(starts, lambda s: F.concat_ws("-", s + 1, s + size))
    whole = F.array(F.lit(None).cast("string"))
    expected = F.when((n >= size) & (n % size == 0), units).when((n % size != 0) & ~_rejected_as_malformed(n), whole)
    due = facts.filter("source_problem IS NULL").withColumn("source_page_range", F.explode(expected))
    # A malformed source has no range, so it meets no row.
    gone = due.join(manifest.select(*man.KEY).distinct(), man.KEY, "left_anti")
    return _bare_rows(gone, F.when(F.col("source_page_range").isNull(), _malformed_text(n, size)).otherwise(_missing_text()))


def audit(manifest: DataFrame, sources: DataFrame, listing: DataFrame, verdicts: DataFrame, bucket: str,
          prefix: str, pages_per_unit: int, open_errors: DataFrame | None = None) -> DataFrame:
    """All checks, one row per manifest row with problems, plus the source-level rows.

    The checks of a source run once for each source; a manifest row meets their outcome, its destination and its verdict in
    one left join each. Nothing is gathered per source, and a dominant source splits like any other join key.
    """
    rows = manifest.select(*AUDIT_COLUMNS)
    facts = _source_facts(rows, sources, listing, open_errors, bucket)
    there = listing.select(F.col("uri").alias("destination_gcs_uri")).distinct().withColumn("placed", F.lit(True))
    known = facts.select(F.col("source_gcs_uri").alias("of_source"), "page_count", "source_problem")
    sized = rows.join(there, "destination_gcs_uri", "left").join(
        known, F.col("source_gcs_uri").eqNullSafe(F.col("of_source")), "left").drop("of_source")
    judged = _with_verdict(sized, verdicts, pages_per_unit)
    uri = F.col("destination_gcs_uri")
    none = F.array().cast("array<string>")
    destination = F.when(
        uri.startswith(f"gs://{bucket}/") & F.col("placed").isNull(),
        F.array(F.concat(F.lit("destination file does not exist in GCS: "), uri)),
    ).otherwise(none)
    category = F.when(
        F.col("page_count") % pages_per_unit == 0,
        category_problems(F.col("page_count"), F.col("language_verdict"),
                          fx.content_verdict(F.col("content_verdict"))),
    ).otherwise(none)
    problems = F.when(F.col("source_problem").isNotNull(), F.array("source_problem")).otherwise(
        F.concat(placement_problems(bucket, prefix), destination, category)
    )
    per_row = judged.select(*AUDIT_COLUMNS, problems.alias("problems")).filter(F.size("problems") > 0)
    return per_row.unionByName(_without_rows(facts, rows, pages_per_unit))


def of_sources(frame: DataFrame, names: DataFrame) -> DataFrame:
    """Rows of the named sources; a null source is one like others."""
    wanted = names.select(F.col("source_gcs_uri").alias("wanted"))
    return frame.join(wanted, F.col("source_gcs_uri").eqNullSafe(F.col("wanted")), "left_semi")


def source_digests(manifest: DataFrame, sources: DataFrame, listing: DataFrame, verdicts: DataFrame,
                   open_errors: DataFrame | None = None) -> DataFrame:
    """``source_gcs_uri`` and ``digest`` of everything that its audit reads, for every source of the manifest.

    A row of the manifest counts with whether its destination is listed. Hashes of rows are added up, so the order of
    rows and how they are dealt make no difference, and sums combine map-side.
    """
    listed = listing.select("uri").distinct()
    rows = manifest.select(*AUDIT_COLUMNS).join(
        listed.select(F.col("uri").alias("destination_gcs_uri"), F.lit(True).alias("placed")), "destination_gcs_uri", "left")

    def part(frame: DataFrame, tag: str, *columns: str, uri: str = "source_gcs_uri") -> DataFrame:
        return frame.select(F.col(uri).alias("source_gcs_uri"), F.xxhash64(F.lit(tag), *columns).alias("hash"),
                            F.lit(int(tag == "row")).alias("own"))

    parts = [part(rows, "row", *AUDIT_COLUMNS, "placed"), part(sources, "pages", "page_count"),
             part(verdicts, "verdict", *man.VERDICT_KEY, *man.VERDICTS), part(listed, "there", uri="uri")]
    if open_errors is not None:
        parts.append(part(open_errors, "error", "error"))
    both = parts[0]
    for more in parts[1:]:
        both = both.unionByName(more)
    total = F.sum(F.col("hash").cast("decimal(20,0)")).cast("string")
    return both.groupBy("source_gcs_uri").agg(F.sum("own").alias("rows"), F.concat_ws(":", F.count("*"), total).alias("digest")) \
        .filter("rows > 0").drop("rows")


def changed_sources(digests: DataFrame, audited: DataFrame, limit: int | None = None) -> DataFrame:
    """Digests that ``audited`` doesn't hold, by source, the first ``limit`` of them."""
    seen = audited.select(F.col("source_gcs_uri").alias("s"), F.col("digest").alias("d"))
    due = digests.join(seen, F.col("source_gcs_uri").eqNullSafe(F.col("s")) & (F.col("digest") == F.col("d")), "left_anti")
    return due if limit is None else due.orderBy(F.col("source_gcs_uri").asc_nulls_last()).limit(limit)


def pending_sources(manifest: DataFrame, done: DataFrame, limit: int | None = None) -> DataFrame:
    """Audit sources still to do: sorted, null last; the first-N cut comes before the resume filter."""
    sources = manifest.select("source_gcs_uri").distinct()
    if limit is not None:
        sources = sources.orderBy(F.col("source_gcs_uri").asc_nulls_last()).limit(limit)
    left = sources.join(done.select("source_gcs_uri").distinct(), "source_gcs_uri", "left_anti")
    return left.orderBy(F.col("source_gcs_uri").asc_nulls_last())


def reprocess_units(flags: DataFrame, listing: DataFrame, bucket: str) -> DataFrame:
    """Flagged units with ``skip_reason``; null means the unit is to be done again."""
    uri = F.col("source_gcs_uri")
    there = listing.select(F.col("uri").alias("source_gcs_uri")).distinct().withColumn("there", F.lit(True))
    return flags.join(there, "source_gcs_uri", "left").select(
        *flags.columns,
        F.when(~uri.startswith(f"gs://{bucket}/"), F.lit("source_gcs_uri not under expected bucket"))
        .when(F.col("there").isNull(), F.lit("source PDF no longer exists")).alias("skip_reason"),
    )


def apply_reprocess(flags: DataFrame, sources: DataFrame, verdicts: DataFrame, listing: DataFrame,
                    manifest: DataFrame, bucket: str, prefix: str, pages_per_unit: int, moved_at: Column,
                    ) -> tuple[DataFrame, DataFrame]:
    """Flagged units categorised anew: the replaced manifest, and the superseded destinations."""
    wanted = reprocess_units(flags, listing, bucket).filter("skip_reason IS NULL").select(*man.KEY).distinct()
    involved = sources.join(wanted.select("source_gcs_uri").distinct(), "source_gcs_uri", "left_semi")
    units = man.expand_units(involved.select("source_gcs_uri", "page_count"), pages_per_unit).join(
        wanted, man.KEY, "left_semi"
    )
    fresh = man.all_or_error(*man.manifest_rows(man.categorise_units(units, verdicts), bucket, prefix, moved_at))
    return replace_by_key(manifest, fresh, man.KEY), man.superseded(manifest, fresh, listing, bucket)
