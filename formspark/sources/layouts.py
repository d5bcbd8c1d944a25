"""Declared table layouts, and shaping a frame to one of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Layout = list[tuple[str, str, str | None]]

TYPES = {
    "STRING": T.StringType(),
    "INTEGER": T.LongType(),
    "FLOAT": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "STRING[]": T.ArrayType(T.StringType()),
}


def _same(kind: str, names: str) -> Layout:
    return [(name, kind, None) for name in names.split()]


MANIFEST: Layout = [
    *_same("STRING", "source_file source_gcs_uri parsed_month_day destination_folder destination_gcs_uri"),
    ("moved_at", "TIMESTAMP", "when this run placed the unit"),
    ("moved_date", "DATE", "day of moved_at"),
    ("source_page_range", "STRING", "1-based first-last page of the unit"),
    ("output_category", "STRING", "normal, declined or rejected"),
    ("rejected", "BOOLEAN", "a rejection reason is present"),
    ("rejected_reason", "STRING", None),
    ("needs_review", "BOOLEAN", "a review reason is present"),
    ("needs_review_reason", "STRING", None),
]

CALIBRATION: Layout = [
    *_same("STRING", "gcs_uri file_name survey_folder"),
    ("partition_date", "DATE", "date of the folder, else the run date"),
    ("page_count", "INTEGER", None),
    *_same("STRING", "paper_sizes marks_found_pages"),
    *_same("FLOAT", "scale_p1 scale_p2 rotation_deg_p1 rotation_deg_p2 offset_dx_p1 offset_dy_p1 "
                    "offset_dx_p2 offset_dy_p2 fit_residual_p1 fit_residual_p2 paper_level_p1 "
                    "ink_threshold ink_blank_hi ink_mark_lo ink_gap"),
    ("ink_quality", "STRING", "clear, tight or null"),
    *_same("INTEGER", "ink_n_marked boxes_confirmed boxes_total"),
    ("confirm_rate", "FLOAT", "boxes_confirmed over boxes_total"),
    *_same("STRING", "question_rects_json warnings calibrator_version"),
    ("profiled_at", "TIMESTAMP", None),
]

QUALITY: Layout = [
    *_same("STRING", "gcs_uri file_name survey_folder"),
    ("partition_date", "DATE", "date of the folder, else the run date"),
    *_same("STRING", "tilted handwriting_readable marks_readable faint_marks ink_mark_style "
                     "marks_outside_box shadow_present tears_or_damage box_borders_readable "
                     "faint_border overall_quality"),
    ("error_reasons", "STRING[]", "every reason in check order"),
    ("recommended_route", "STRING", "pixel, vision or fallback"),
    ("needs_review", "BOOLEAN", None),
    *_same("FLOAT", "tilt_deg ink_gap ink_mark_lo ink_threshold border_rate border_cov_min shadow_coverage"),
    ("shadow_bands", "INTEGER", None),
    ("overflow_questions", "STRING", None),
    ("fit_residual_max", "FLOAT", None),
    ("vision_error", "STRING", None),
    *_same("BOOLEAN", "pixel_unreadable trig_marks_unreadable trig_borders_unreadable trig_tilted "
                      "trig_marks_missing trig_residual_high questionable_flag trig_marks_questionable "
                      "trig_marks_outside trig_handwriting_questionable trig_damage trig_flag_count"),
    *_same("STRING", "calibration_source classifier_version"),
    ("assessed_at", "TIMESTAMP", None),
]

FILE_QUALITY: Layout = [
    *_same("STRING", "folder_name file_name"),
    ("report_date", "DATE", None),
    ("refreshed_at", "TIMESTAMP", "one stamp per run"),
    ("refreshed_date", "DATE", "day of refreshed_at"),
    ("needs_review", "BOOLEAN", "at least one answer is flagged"),
    *_same("INTEGER", "flagged_question_count total_question_count"),
    ("issue_summary", "STRING", None),
    ("issues", "STRING[]", "one short phrase per flagged answer"),
    ("unreadable_areas", "STRING[]", "one note with its page per flagged answer"),
]

RESPONSES: Layout = [
    *_same("STRING", "folder_name file_name"),
    ("report_date", "DATE", None),
    *_same("STRING", "question_number survey_question survey_answer mark_position"),
    ("needs_review", "BOOLEAN", None),
    *_same("STRING", "review_note detection_method"),
    ("model_confidence", "FLOAT", None),
    ("vision_cross_check", "STRING", None),
]

FEEDBACK: Layout = [
    *RESPONSES,
    ("correct_answer", "STRING", None),
    ("updated_with_feedback", "BOOLEAN", "null until a reviewer's answer is taken in"),
    ("feedback_updated_time", "TIMESTAMP", None),
    ("ingested_from", "STRING", None),
]


def struct_of(layout: Layout) -> T.StructType:
    return T.StructType([
        T.StructField(name, TYPES[kind], True, {"comment": note} if note else {})
        for name, kind, note in layout
    ])


def _coerced(column: Column, found: T.DataType, kind: str) -> Column:
    """A column as the declared type; a value that does not fit becomes null."""
    wanted = TYPES[kind]
    if kind == "STRING[]":
        empty = F.array().cast(wanted)
        if isinstance(found, T.ArrayType):
            return F.coalesce(column.cast(wanted), empty)
        return empty
    if found == wanted:
        return column
    if isinstance(found, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(column) if kind == "STRING" else F.lit(None).cast(wanted)
    if isinstance(found, T.StringType) and kind == "INTEGER":
        number = column.try_cast("double")
        return F.when(number == F.floor(number), number.try_cast("bigint"))
    return column.try_cast(wanted)


def conform(df: DataFrame, layout: Layout) -> DataFrame:
    """Exactly the declared columns in order; missing ones null, bad values null."""
    have = {field.name: field.dataType for field in df.schema.fields}
    return df.select(*[
        _coerced(
            F.col(f"`{name}`") if name in have else F.lit(None),
            have.get(name, T.NullType()), kind,
        ).alias(name, metadata={"comment": note} if note else {})
        for name, kind, note in layout
    ])


def evolve(df: DataFrame, layout: Layout) -> DataFrame:
    """Declared columns the frame lacks are added as null; nothing is dropped or retyped."""
    have = set(df.columns)
    return df.select("*", *[
        F.lit(None).cast(TYPES[kind]).alias(name, metadata={"comment": note} if note else {})
        for name, kind, note in layout if name not in have
    ])
