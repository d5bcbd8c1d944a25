"""Reviewer corrections: sync, export, merge, and the corrections log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = ["folder_name", "file_name", "question_number"]
EXTRA = {
    "correct_answer": "string", "updated_with_feedback": "boolean",
    "feedback_updated_time": "timestamp", "ingested_from": "string",
}


class DuplicateFeedback(ValueError):
    """The sheet answers one question of one file more than once."""


def sync_feedback(responses: DataFrame, feedback: DataFrame | None) -> DataFrame:
    """Feedback rows plus the answers it lacks, those with null feedback columns.

    Keys compare null-safe, so running it again adds nothing.
    """
    lacking = lacking_feedback(responses, feedback)
    return lacking if feedback is None else feedback.unionByName(lacking, allowMissingColumns=True)


def lacking_feedback(responses: DataFrame, feedback: DataFrame | None) -> DataFrame:
    """The answers that the feedback rows lack, with null feedback columns."""
    blank = responses.select("*", *[F.lit(None).cast(kind).alias(c) for c, kind in EXTRA.items()])
    if feedback is None:
        return blank
    # Null or not is a key of its own, so that the join takes the known keys as they were dealt to become distinct.
    keys = {f"_{kind}_{k}": column for k in KEY for kind, column in (("is", F.col(k).isNotNull()), ("at", F.coalesce(k, F.lit(""))))}
    known = feedback.select(*[column.alias(name) for name, column in keys.items()]).distinct()
    return blank.withColumns(keys).join(known, [*keys], "left_anti").drop(*keys)


def pending_feedback(feedback: DataFrame) -> DataFrame:
    return feedback.filter(F.col("needs_review") & F.col("updated_with_feedback").isNull())


def sheet_duplicates(sheet: DataFrame) -> DataFrame:
    """Keys the sheet holds more than once; a key with a null part can match nothing."""
    return sheet.dropna(subset=KEY).groupBy(*KEY).agg(F.count("*").alias("rows")).filter("rows > 1")


def merge_feedback(feedback: DataFrame, sheet: DataFrame, uri: Column, now: Column) -> DataFrame:
    """Take in the answers of rows still without feedback; ``applied_now`` marks them."""
    if not sheet_duplicates(sheet).isEmpty():
        raise DuplicateFeedback("the sheet holds a question of a file more than once")
    given = sheet.filter(F.col("correct_answer") != "").select(*KEY, F.col("correct_answer").alias("given"))
    merged = feedback.join(given, KEY, "left")
    applies = F.col("given").isNotNull() & F.col("updated_with_feedback").isNull()
    changed = {
        "survey_answer": F.col("given"), "correct_answer": F.col("given"), "updated_with_feedback": F.lit(True),
        "feedback_updated_time": now, "ingested_from": uri,
    }
    return merged.select(
        *[F.when(applies, changed[c]).otherwise(F.col(c)).alias(c) if c in changed else F.col(c)
          for c in feedback.columns],
        applies.alias("applied_now"),
    )


def list_corrections(log: DataFrame, question: str | None = None, file: str | None = None,
                     root_cause: str | None = None, limit: int | None = None) -> DataFrame:
    """Corrections newest first, with ``recurrence``: not the first of its question and cause."""
    facet = ["question", "root_cause"]
    first = log.groupBy(*facet).agg(F.min(F.struct("logged_at", "correction_id")).alias("first_logged"))
    rows = log.join(first, facet, "left")
    for column, wanted in (("question", question), ("file_name", file), ("root_cause", root_cause)):
        if wanted is not None:
            rows = rows.filter(F.col(column) == wanted)
    rows = rows.select(
        *log.columns, (F.struct("logged_at", "correction_id") != F.col("first_logged")).alias("recurrence")
    )
    if limit is None:
        return rows
    return rows.orderBy(F.desc("logged_at"), F.desc("correction_id")).limit(limit)
