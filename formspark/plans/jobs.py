"""Whole jobs. With ``dry_run`` each returns its lazy frame and writes nothing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from formspark.operators import audit as aud
from formspark.operators import calibrate, feedback, geometry, quality, rollup
from formspark.operators import manifest as man
from formspark.sources import layouts, readers, writers


class MissingExport(FileNotFoundError):
    """No reviewer export matches the naming rule."""


def intake_rows(sources: DataFrame, listing: DataFrame, verdicts: DataFrame, bucket: str, prefix: str,
                pages_per_unit: int, moved_at: Column) -> tuple[DataFrame, DataFrame]:
    """Manifest rows of a run and the rows that break its constraint.

    A source counts once, however often it is named. Complete sources are taken from where their files lie; the rest are categorised by their verdicts; malformed ones,
    which have no units and so are never complete, become one rejected row. Every unit meets the listing and the
    verdicts once, whatever becomes of it.
    """
    known = sources.select("source_gcs_uri", "page_count").distinct()
    placed = man.with_places(man.expand_units(known, pages_per_unit), listing, bucket, prefix)
    done = man.completed(placed.filter("place IS NOT NULL"), pages_per_unit).withColumn("done", F.lit(True))
    judged = man.with_verdicts(placed, verdicts).join(done, "source_gcs_uri", "left").withColumn(
        "done", F.coalesce("done", F.lit(False)))
    units = man.placed_or_fresh(judged)
    broken = man.malformed_sources(known, verdicts, pages_per_unit).withColumn("done", F.lit(False))
    return man.manifest_rows(man.flag_duplicate_names(units.unionByName(broken.select(*units.columns))), bucket, prefix, moved_at)


def run_intake(table: writers.KeyedTable, sources: DataFrame, listing: DataFrame, verdicts: DataFrame,
               bucket: str, prefix: str, pages_per_unit: int, moved_at: Column, dry_run: bool = False,
               failures: Callable[[DataFrame], None] | None = None) -> DataFrame:
    """Manifest rows of a run, put in place; units that break its constraint go to ``failures`` or are an error.

    A dry run returns those units among the others, rejected and for review at once, and writes nothing.
    """
    rows, broken = intake_rows(sources, listing, verdicts, bucket, prefix, pages_per_unit, moved_at)
    if dry_run:
        return rows.unionByName(broken)
    table.replace(man.settled(rows, broken, failures))
    return rows


def audit_changes(issues: writers.KeyedTable, audited: writers.KeyedTable, manifest: DataFrame, sources: DataFrame,
                  listing: DataFrame, verdicts: DataFrame, bucket: str, prefix: str, pages_per_unit: int,
                  open_errors: DataFrame | None = None, limit: int | None = None) -> int:
    """Audit the sources of which anything changed since their last audit; returns how many those are.

    ``issues`` (keyed by source) holds what is wrong now: the old issues of an audited source go, whether or not new ones
    come. ``audited`` (``source_gcs_uri``, ``digest``) is written after the issues, so a run that breaks off audits its
    sources again and loses none. With ``limit`` a run takes so many of them; the next goes on from there.
    """
    digests = aud.source_digests(manifest, sources, listing, verdicts, open_errors)
    with writers.saved(aud.changed_sources(digests, audited.read(), limit)) as due:
        # The audit reads these rows several times over.
        with writers.saved(aud.of_sources(manifest.select(*readers.AUDIT_COLUMNS), due)) as rows:
            found = aud.audit(rows, aud.of_sources(sources, due), listing, aud.of_sources(verdicts, due),
                              bucket, prefix, pages_per_unit, open_errors)
            issues.replace(writers.issue_rows(found).select(*issues.schema.names), due)
        audited.replace(due)
        return due.count()


def calibrate_files(marks: DataFrame, questions: DataFrame, ratios: DataFrame, pages: DataFrame) -> DataFrame:
    """Calibration rows from measurements: fits, active layouts, ink split, roll-up."""
    fits = geometry.fit_residual(geometry.fit_similarity(marks)).select(
        F.col("page_id"), "scale", "rotation_deg", "offset_dx", "offset_dy", "fit_residual")
    fitted = pages.join(fits, "page_id", "left").withColumn("marks_found", F.col("scale").isNotNull())
    active = geometry.active_layout(questions)
    used = ratios.filter("confirmed").join(
        active.filter("active_layout").select("file_name", "question_key"), ["file_name", "question_key"], "left_semi")
    return calibrate.profile_rollup(fitted, active, calibrate.ink_split(used))


def grade_files(files: DataFrame, log: DataFrame, measured: DataFrame, signals: DataFrame,
                judged: DataFrame | None, tie: str | None = None) -> DataFrame:
    """Quality rows: newest profile or own measurement, ratings, judgements, route."""
    profile = quality.profile_or_fallback(files, log, measured, tie)
    return quality.derive_route(quality.classify_measured(profile.join(signals, "file_name")), judged)


def refresh_file_quality(table: writers.KeyedTable, responses: DataFrame, refreshed_at: Column,
                         folders: list[str] | None = None, replace: bool = True, dry_run: bool = False) -> DataFrame:
    """Roll answers up and put each touched folder's rows in place of its old ones.

    ``table`` is keyed by folder. Rows without a folder are only ever added.
    """
    rows = layouts.conform(
        rollup.file_quality(readers.in_folders(responses, folders), refreshed_at), layouts.FILE_QUALITY)
    if dry_run:
        return rows
    if replace:
        table.replace_folders(rows)
    else:
        table.append(rows)
    return rows


def ingest_latest(spark: SparkSession, listing: DataFrame, prefix: str, responses: DataFrame,
                  feedback_rows: DataFrame | None, now: Column, suffix: str = ".csv") -> DataFrame:
    """Newest export merged into the synced feedback rows; without answers they are only synced.

    The export's own name, one row, decides which file is read.
    """
    path = _newest_export(listing, prefix, suffix)
    synced = feedback.sync_feedback(responses, feedback_rows)
    return feedback.merge_feedback(synced, readers.read_feedback(spark, path), F.lit(path), now)


def _newest_export(listing: DataFrame, prefix: str, suffix: str) -> str:
    newest = readers.latest_export(listing, prefix, suffix).first()
    if newest is None:
        raise MissingExport(f"no export {prefix}*{suffix} in the listing")
    return newest["object_name"]


def load_feedback(table: writers.KeyedTable, listing: DataFrame, prefix: str, responses: DataFrame, now: Column,
                  suffix: str = ".csv") -> int:
    """The newest export merged into the feedback table; returns the number of answers applied.

    Rows already answered stay, so loading an export again applies nothing. Only rows that change are written: answers
    the table lacked and those the export answers, the latter with what else stands under their key.
    """
    if table.is_empty():
        table.append(ingest_latest(table.spark, listing, prefix, responses, None, now, suffix).drop("applied_now"))
        return table.read().filter("updated_with_feedback").count()
    known, path = table.read(), _newest_export(listing, prefix, suffix)
    unanswered = known.filter("updated_with_feedback IS NULL").withColumn("added", F.lit(False))
    synced = unanswered.unionByName(feedback.lacking_feedback(responses, known).withColumn("added", F.lit(True)), allowMissingColumns=True)
    merged = feedback.merge_feedback(synced, readers.read_feedback(table.spark, path), F.lit(path), now)
    with writers.saved(merged.filter("applied_now OR added").drop("added")) as rows:
        taken = rows.filter("applied_now").select(*feedback.KEY).distinct()
        applied = rows.filter("applied_now").count()
        answered = known.filter("updated_with_feedback IS NOT NULL").join(taken, feedback.KEY, "left_semi")
        table.replace(rows.drop("applied_now").unionByName(answered, allowMissingColumns=True) if applied else rows.drop("applied_now"))
    return applied
