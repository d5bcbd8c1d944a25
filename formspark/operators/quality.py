"""Scan quality: newest profile, measured ratings, and the route they lead to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formspark import functions as fx
from formspark.operators.calibrate import shown

# Rating thresholds.
TILT_DEG, FAINT_MARK, BORDERS_READABLE, FAINT_BORDER = 0.5, 0.30, 0.95, 0.70
SHADOW_COVERAGE, SHADOW_BANDS, MAX_RESIDUAL, FLAGS_FOR_VISION = 0.01, 6, 8.0, 5
# Where a profile came from, and how a file without one is explained; both are parameters.
TABLE_SOURCE, SELF_SOURCE = "pdf_calibration_profile", "self-measured"
NO_PROFILE = "no {} row found for this file - measured directly instead of using notebook 1's calibration"
TRIGGERS = [
    "pixel_unreadable", "trig_marks_unreadable", "trig_borders_unreadable", "trig_tilted", "trig_marks_missing",
    "trig_residual_high", "questionable_flag", "trig_marks_questionable", "trig_marks_outside",
    "trig_handwriting_questionable", "trig_damage", "trig_flag_count",
]


def latest_profile(log: DataFrame, key: str = "file_name", ts: str = "profiled_at",
                   tie: str | None = None) -> DataFrame:
    """Newest row of each key; among equal times the highest ``tie``, then a digest of the whole row, decides.

    So the choice does not hang on how the rows are dealt. The rank filter is applied before the shuffle too: a
    key with very many rows sends one row per task.
    """
    parts = [F.to_json(f.name) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in log.schema.fields]
    order = [F.col(ts).desc_nulls_last(), *([F.col(tie).desc()] if tie else []), F.xxhash64(*parts)]
    newest = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return log.withColumn("newest", newest).filter(F.col("newest") == 1).drop("newest")


def profile_or_fallback(files: DataFrame, log: DataFrame, measured: DataFrame, tie: str | None = None,
                        table: str = TABLE_SOURCE) -> DataFrame:
    """Stored profile of each file if there is one, else the file's own measurement, whole; ``table`` names the former."""
    columns = [c for c in measured.columns if c != "file_name"]
    stored = latest_profile(log, tie=tie).select("file_name", F.struct(*columns).alias("stored"))
    own = measured.select("file_name", F.struct(*columns).alias("own"))
    joined = files.join(stored, "file_name", "left").join(own, "file_name", "left")
    return joined.withColumn("p", F.coalesce("stored", "own")).select(
        *files.columns, "p.*",
        F.when(F.col("stored").isNotNull(), table).otherwise(SELF_SOURCE).alias("calibration_source"))


def qc_measure(pages: DataFrame, questions: DataFrame, coverage: DataFrame, shadow: DataFrame,
               absent: tuple[str, ...] = (), key: str = "file_name") -> DataFrame:
    """Measured signals of each file; every input is reduced per file before the joins."""
    per_page = pages.groupBy(key).agg(
        F.round(F.max(F.abs("rotation_deg")), 3).alias("tilt_deg"),
        F.round(F.max("fit_residual"), 2).alias("fit_residual_max"),
        F.bool_and(F.coalesce("marks_found", F.lit(False))).alias("marks_found_all_pages"),
        F.count("*").alias("page_count"),
        F.array_sort(F.collect_set(F.coalesce("paper", F.lit("?")))).alias("paper_sizes"))
    present = questions.filter(~F.col("question_key").isin(*absent)) if absent else questions
    borders = present.groupBy(key).agg(
        (F.sum("boxes_confirmed") / F.nullif(F.sum("boxes_total"), F.lit(0).cast("bigint"))).alias("border_rate"))
    traced = coverage.filter(~F.col("question_key").isin(*absent)) if absent else coverage
    worst = traced.groupBy(key).agg(F.round(F.min("coverage"), 3).alias("border_cov_min"))
    dark = shadow.groupBy(key).agg(F.max(F.struct("shadow_coverage", "shadow_bands")).alias("s")).select(
        key, F.round("s.shadow_coverage", 4).alias("shadow_coverage"), F.col("s.shadow_bands").alias("shadow_bands"))
    joined = per_page.join(borders, key, "left").join(worst, key, "left").join(dark, key, "left")
    return joined.withColumns({
        "border_rate": F.round("border_rate", 4),
        "shadow_coverage": F.coalesce("shadow_coverage", F.lit(0.0)),
        "shadow_bands": F.coalesce("shadow_bands", F.lit(0).cast("bigint")),
    })


def _percent(rate: Column) -> Column:
    return F.format_string("%.0f%%", rate * 100)


def _number(column: str) -> Column:
    return F.coalesce(shown(F.col(column)), F.lit("None"))


def classify_measured(df: DataFrame, no_profile: str = NO_PROFILE.format(TABLE_SOURCE)) -> DataFrame:
    """Eight ratings and the reasons behind them, in check order; ``no_profile`` is the first where a file had none stored."""
    tilt, ink, mark, overflow = (F.col(c) for c in ("tilt_deg", "ink_quality", "ink_mark_lo", "overflow_rows"))
    rate, cover, residual = (F.col(c) for c in ("border_rate", "border_cov_min", "fit_residual_max"))
    faint = F.coalesce(mark < FAINT_MARK, F.lit(False))
    over = F.coalesce(F.size(overflow) > 0, F.lit(False))
    dark = (F.col("shadow_coverage") >= SHADOW_COVERAGE) & (F.col("shadow_bands") >= SHADOW_BANDS)
    thin = F.coalesce(cover < FAINT_BORDER, F.lit(False))
    readable = F.coalesce(rate >= BORDERS_READABLE, F.lit(False))
    questions = F.array_join(F.transform(overflow, lambda q: F.concat(F.lit("Q"), q.cast("string"))), ", ")
    # The texts of the reasons.
    reasons = [
        F.when(F.col("calibration_source") == SELF_SOURCE, F.lit(no_profile)),
        F.when(tilt.isNull(), F.lit("page tilt could not be measured (registration marks not found)")).when(
            tilt > TILT_DEG, F.concat(F.lit("page tilted "), _number("tilt_deg"), F.lit(" deg"))),
        F.when(ink == "tight", F.concat(F.lit("marked and blank ink nearly touch (gap "), _number("ink_gap"),
                                        F.lit(") - thresholding this scan is unreliable"))).when(
            ink.isNull() | (ink != "clear"), F.lit("no separation between marked and blank ink could be measured")),
        F.when(faint, F.concat(F.lit("faintest mark reads "), _number("ink_mark_lo"), F.lit(" - light checkmark-style marks"))),
        F.when(overflow.isNull(), F.lit(
            "checkbox grid not locatable - could not check for marks overflowing their boxes")).when(
            over, F.concat(F.lit("marks overflow their box on "), questions)),
        F.when(dark, F.concat(F.lit("edge shadow band down the margin (coverage "), _number("shadow_coverage"),
                              F.lit(" across "), F.col("shadow_bands").cast("string"), F.lit("/20 bands)"))),
        F.when(rate.isNull(), F.lit("no checkbox borders could be located at all")).when(
            ~readable, F.concat(F.lit("only "), _percent(rate), F.lit(" of checkbox borders could be traced"))),
        F.when(thin, F.concat(F.lit("faintest checkbox border is only "), _percent(cover), F.lit(" covered"))),
        F.when(~F.col("marks_found_all_pages"), F.lit("registration marks missing on at least one page")),
        F.when(residual > MAX_RESIDUAL, F.concat(F.lit("registration marks do not form a rigid quad (residual "),
                                                 _number("fit_residual_max"), F.lit("px)"))),
    ]
    return df.withColumns({
        "tilted": F.when(tilt.isNull(), "unknown").when(tilt > TILT_DEG, "yes").otherwise("no"),
        "marks_readable": F.when(ink == "clear", "clear").when(ink == "tight", "questionable").otherwise("unreadable"),
        "faint_marks": F.when(faint, "yes").otherwise("no"),
        "ink_mark_style": F.when(mark.isNull(), "unknown").when(faint, "light_checkmark").otherwise("bold_x"),
        "marks_outside_box": F.when(overflow.isNull(), "unknown").when(over, "yes").otherwise("no"),
        "shadow_present": F.when(dark, "yes").otherwise("no"),
        "box_borders_readable": F.when(readable, "yes").otherwise("no"),
        "faint_border": F.when(thin, "yes").otherwise("no"),
        "reasons": F.array_compact(F.array(*reasons)),
    })


def derive_route(classified: DataFrame, judged: DataFrame | None = None, key: str = "file_name") -> DataFrame:
    """Triggers, overall quality and route, from ratings and any judgement of the page."""
    fields = ["handwriting_readable", "handwriting_notes", "tears_or_damage", "damage_notes", "vision_error"]
    if judged is None:
        rows = classified.withColumns({f"j_{c}": F.lit(None).cast("string") for c in fields})
    else:
        rows = classified.join(judged.select(key, *[F.col(c).alias(f"j_{c}") for c in fields]), key, "left")
    error, notes, damage_notes = (F.nullif(F.col(f"j_{c}"), F.lit("")) for c in
                                  ("vision_error", "handwriting_notes", "damage_notes"))

    def verdict(column: str) -> Column:
        return F.when(error.isNull(), F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit("unknown"))).otherwise("unknown")

    rows = rows.withColumns({
        "handwriting_readable": verdict("j_handwriting_readable"),
        "tears_or_damage": verdict("j_tears_or_damage"), "vision_error": error,
    })
    hand, damage = F.col("handwriting_readable"), F.col("tears_or_damage")

    def told(text: str, note: Column) -> Column:
        return F.concat(F.lit(text), F.coalesce(F.concat(F.lit(": "), note), F.lit("")))

    extra = F.array_compact(F.array(
        F.when((hand == "questionable") & notes.isNotNull(), told("handwriting questionable", notes)).when(
            hand == "unreadable", told("handwriting could not be read", notes)),
        F.when(damage == "yes", told("physical damage on the page", damage_notes)),
        F.when(error.isNotNull(), F.concat(F.lit("vision pass failed: "), error)),
    ))
    rows = rows.withColumn("reasons", F.concat("reasons", extra)).withColumns({
        "trig_marks_unreadable": F.col("marks_readable") == "unreadable",
        "trig_borders_unreadable": F.col("box_borders_readable") == "no",
        "trig_tilted": F.col("tilted").isin("yes", "unknown"),
        "trig_marks_missing": ~F.col("marks_found_all_pages"),
        "trig_residual_high": F.coalesce(F.col("fit_residual_max") > MAX_RESIDUAL, F.lit(False)),
        "trig_marks_questionable": F.col("marks_readable") == "questionable",
        "trig_marks_outside": F.col("marks_outside_box").isin("yes", "unknown"),
        "trig_handwriting_questionable": hand.isin("questionable", "unreadable"),
        "trig_damage": damage == "yes",
        "trig_flag_count": F.size("reasons") >= FLAGS_FOR_VISION,
    })

    def any_of(*names: str) -> Column:
        test = F.col(names[0])
        for name in names[1:]:
            test = test | F.col(name)
        return test

    rows = rows.withColumns({
        "pixel_unreadable": any_of("trig_marks_unreadable", "trig_borders_unreadable", "trig_tilted",
                                   "trig_marks_missing", "trig_residual_high"),
        "questionable_flag": any_of("trig_marks_questionable", "trig_marks_outside",
                                    "trig_handwriting_questionable", "trig_damage"),
    })
    unreadable, vision = F.col("pixel_unreadable"), any_of("questionable_flag", "trig_flag_count")
    count_only = ~unreadable & ~F.col("questionable_flag") & F.col("trig_flag_count")
    counted = F.concat(F.size("reasons").cast("string"),
                       F.lit(f" quality issues flagged (>= {FLAGS_FOR_VISION}) - routed to vision verification"))
    return rows.withColumns({
        "overall_quality": F.when(unreadable, "totally_unreadable").when(
            vision | (F.size("reasons") > 0), "unclear").otherwise("clear"),
        "recommended_route": F.when(unreadable, "fallback").when(vision, "vision").otherwise("pixel"),
        "needs_review": unreadable | vision,
        "error_reasons": F.when(count_only, F.array_append("reasons", counted)).otherwise(F.col("reasons")),
    }).drop("reasons", *[f"j_{c}" for c in fields])


def needs_judging(classified: DataFrame, only_flagged: bool = True, key: str = "file_name") -> DataFrame:
    """Files worth a look by eye: those the measured signals alone do not call clear."""
    if not only_flagged:
        return classified
    flagged = derive_route(classified).filter(F.col("overall_quality") != "clear").select(key)
    return classified.join(flagged, key, "left_semi")


def route_counts(quality: DataFrame) -> DataFrame:
    return quality.groupBy("recommended_route").agg(F.count("*").alias("files"))


def qc_failure_stubs(files: DataFrame, quality: DataFrame, errors: DataFrame, key: str = "file_name") -> DataFrame:
    """Quality rows plus one for every file that could not be assessed."""
    failed = errors.groupBy(key).agg(F.min("error").alias("error"))
    stubs = files.join(quality.select(key), key, "left_anti").join(failed, key, "left").select(
        *files.columns,
        F.lit("totally_unreadable").alias("overall_quality"), F.lit("fallback").alias("recommended_route"),
        F.lit(True).alias("needs_review"),
        F.array(F.concat(F.lit("could not be assessed: "), F.coalesce("error", F.lit("no result")))).alias("error_reasons"))
    return quality.unionByName(stubs, allowMissingColumns=True)


def quality_rows(df: DataFrame, run_date: Column, version: str, assessed_at: Column) -> DataFrame:
    """Rows as they are stored: overflow as text, partition date from the folder."""
    folder = F.col("survey_folder") if "survey_folder" in df.columns else F.lit(None).cast("string")
    overflow = F.nullif(F.array_join(F.col("overflow_rows").cast("array<string>"), ","), F.lit(""))
    return df.withColumns({
        "survey_folder": folder, "partition_date": fx.folder_date(folder, run_date),
        "overflow_questions": overflow, "classifier_version": F.lit(version), "assessed_at": assessed_at,
        "error_reasons": F.coalesce("error_reasons", F.array().cast("array<string>")),
    })
