"""Per-file calibration: ink thresholds, profile rows, geometry review."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formspark import functions as fx
from formspark.functions.paths import base_name

CLEAR_GAP = 0.08
# Samples needed, fewest and most marked boxes, for a form without a profile.
LIMITS_UNCONFIGURED = (12, 8, 25)
# Warning texts of a profile.
NO_MARKS = ("registration marks not found - no transform for this page, so its questions get no profile and "
            "fall back to the pipeline's own search")
HIGH_RESIDUAL = ("px is high - the marks do not form the expected rigid quad; boxes on this page are reported "
                 "but should be treated with suspicion")
NO_SPLIT = ("no blank/marked ink separation could be measured on this file - no per-file threshold emitted; "
            "the pipeline keeps its own global defaults")
NOT_SEEN = "no supplied PDF produced a candidate for this question"
NOT_VALID = "supplied PDFs did not validate the manual candidate geometry"


def shown(number: Column) -> Column:
    """A number of at most four decimals as plain text, with at least one decimal."""
    text = F.regexp_replace(number.cast("decimal(24,4)").cast("string"), "0+$", "")
    return F.when(text.endswith("."), F.concat(text, F.lit("0"))).otherwise(text)


def ink_limits(controls: DataFrame, configured: Column | None = None) -> DataFrame:
    """Sample and mark limits of each form from its approved checkboxes."""
    counted = controls.groupBy("form_id").agg(F.count_if(F.col("control_type") == "checkbox").alias("c"))
    c = F.col("c")
    set_up = F.lit(True) if configured is None else configured
    plain, low, high = LIMITS_UNCONFIGURED
    return counted.select(
        "form_id",
        F.when(~set_up, plain).when(c < 2, 2).otherwise(F.least(F.lit(12), c)).cast("int").alias("min_samples"),
        F.when(~set_up, low).otherwise(1).alias("min_marked"),
        F.when(~set_up, high).when(c < 2, 1).otherwise(c - 1).cast("int").alias("max_marked"),
    )


def ink_split(ratios: DataFrame, keys: Sequence[str] = ("file_name",), limits: tuple[int, int, int] = LIMITS_UNCONFIGURED,
              mode: str = "clear_first", clear_gap: float = CLEAR_GAP, value: str = "ratio",
              per_file: DataFrame | None = None) -> DataFrame:
    """Blank/marked threshold of each file from its sorted ink ratios, without sorting them whole.

    ``per_file`` holds a file's own limits (``keys`` and the columns of ``ink_limits``), so files of
    different forms are split in one job; files it lacks take ``limits``.

    A clear gap cannot lie inside a bucket narrower than it, so the clear pass
    needs only each bucket's count and edges. The windowed pass looks at the
    ``max_marked`` largest ratios, so only that many and one more leave a task.
    """
    names = ["min_samples", "min_marked", "max_marked"]
    samples, least, most = (F.col(name) for name in names)
    r, keys = F.col(value), list(keys)
    buckets = ratios.filter(r.isNotNull()).groupBy(*keys, F.floor(r / (clear_gap / 4)).alias("b")).agg(
        F.count("*").alias("size"), F.min(r).alias("low"), F.max(r).alias("high"))
    usual, largest = dict(zip(names, limits)), limits[2]
    if per_file is None:
        buckets = buckets.withColumns({name: F.lit(x) for name, x in usual.items()})
    else:
        buckets = buckets.join(per_file.select(*keys, *names), keys, "left").fillna(usual)
        largest = max(largest, per_file.agg(F.max("max_marked")).first()[0] or 0)
    order = Window.partitionBy(*keys).orderBy("b")
    edges = buckets.select(*names,
        *keys, "size", F.col("low").alias("mark_lo"), F.lag("high").over(order).alias("blank_hi"),
        F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("k"),
        F.sum("size").over(Window.partitionBy(*keys)).alias("n"),
    )
    n = F.col("n")
    lo = F.greatest(F.lit(1), n - most)
    hi = F.least(F.greatest(lo + 1, n - least), n - 1)
    gap = F.col("mark_lo") - F.col("blank_hi")
    in_window = F.col("k").between(lo, hi).cast("int")
    clear = edges.groupBy(*keys).agg(
        F.max("n").alias("n"), *(F.max(name).alias(name) for name in names),
        F.max(F.when(gap >= clear_gap, F.struct(
            gap.alias("gap"), in_window.alias("inside"), (-F.col("k")).alias("minus_k"), "blank_hi", "mark_lo"))).alias("c"),
    )
    top = ratios.filter(r.isNotNull()).select(*keys, r.alias("mark_lo")).withColumn(
        "j", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("mark_lo")))).filter(F.col("j") <= largest + 1)
    down = Window.partitionBy(*keys).orderBy(F.desc("mark_lo"))
    steps = top.withColumn("blank_hi", F.lead("mark_lo").over(down)).join(clear.select(*keys, "n", *names), keys)
    k = n - F.col("j")
    tight = steps.filter(F.col("blank_hi").isNotNull() & k.between(lo, hi)).groupBy(*keys).agg(
        F.max(F.struct(gap.alias("gap"), (-k).alias("minus_k"), "blank_hi", "mark_lo")).alias("t"))
    both = clear.join(tight, keys, "left")
    enough = n >= samples
    use_clear = enough & F.col("c").isNotNull() if mode == "clear_first" else F.lit(False)
    use_tight = enough & ~use_clear & F.col("t").isNotNull()

    def pick(field: str) -> Column:
        return F.when(use_clear, F.col(f"c.{field}")).when(use_tight, F.col(f"t.{field}"))

    marked = n + pick("minus_k")
    plausible = (F.col("t.gap") >= clear_gap) & marked.between(least, most)
    return both.select(
        *keys, F.col("n").alias("samples"),
        F.round((pick("blank_hi") + pick("mark_lo")) / 2, 4).alias("ink_threshold"),
        F.round(pick("blank_hi"), 4).alias("ink_blank_hi"), F.round(pick("mark_lo"), 4).alias("ink_mark_lo"),
        F.round(pick("gap"), 4).alias("ink_gap"),
        F.when(use_clear, "clear").when(use_tight, F.when(plausible, "clear").otherwise("tight")).alias("ink_quality"),
        marked.alias("ink_n_marked"),
    )


def profile_rollup(pages: DataFrame, questions: DataFrame, ink: DataFrame, rects: DataFrame | None = None,
                   key: str = "file_name") -> DataFrame:
    """One calibration row per file from its pages, active layouts and ink split."""
    def page(n: int, column: str) -> Column:
        return F.max(F.when(F.col("page") == n, F.col(column)))

    residual = F.col("fit_residual")
    warning = F.concat(F.lit("p"), F.col("page").cast("string"), F.lit(": "), F.when(
        ~F.col("marks_found"), F.lit(NO_MARKS)).when(
        residual > 8, F.concat(F.lit("registration fit residual "), shown(residual), F.lit(HIGH_RESIDUAL))))
    # One row per page first: what a file gathers is then its pages and no more.
    single = pages.groupBy(key, "page").agg(*[
        (F.bool_and(c) if c == "marks_found" else F.max(c)).alias(c) for c in
        ("paper", "marks_found", "scale", "rotation_deg", "offset_dx", "offset_dy", "fit_residual", "paper_level")])

    def by_page(column: Column) -> Column:
        return F.transform(F.array_sort(F.collect_list(F.struct("page", column.alias("t")))), lambda e: e["t"])

    per_page = single.groupBy(key).agg(
        F.count("*").alias("page_count"),
        F.array_join(F.array_sort(F.collect_set(F.coalesce("paper", F.lit("?")))), "|").alias("paper_sizes"),
        F.array_join(by_page(F.when(F.col("marks_found"), "yes").otherwise("no")), "|").alias("marks_found_pages"),
        *[page(n, c).alias(f"{c}_p{n}") for c in
          ("scale", "rotation_deg", "offset_dx", "offset_dy", "fit_residual") for n in (1, 2)],
        page(1, "paper_level").alias("paper_level_p1"),
        F.array_compact(by_page(warning)).alias("page_warnings"),
    )
    layouts = questions.groupBy(key, "question").agg(
        F.sum(F.when(F.col("active_layout"), F.col("boxes_confirmed"))).alias("confirmed"),
        F.sum(F.when(F.col("active_layout"), F.col("boxes_total"))).alias("total"),
        F.max(F.when(F.col("active_layout"), F.col("question_key"))).alias("active"),
        F.array_sort(F.collect_set(F.when(~F.col("active_layout"), F.struct("candidate", "question_key")))).alias("rest"),
    )
    swapped = F.when(F.size("rest") > 0, F.concat(
        F.lit("q"), F.col("question"), F.lit(": counted active layout "), F.col("active"),
        F.lit("; excluded alternative layout(s) "),
        F.array_join(F.transform("rest", lambda e: e["question_key"]), ", ")))
    counted = layouts.groupBy(key).agg(
        F.sum("confirmed").alias("boxes_confirmed"), F.sum("total").alias("boxes_total"),
        F.transform(F.array_sort(F.collect_list(F.when(swapped.isNotNull(), F.struct(
            fx.question_rank(F.col("question")).alias("rank"), swapped.alias("t"))))), lambda e: e["t"]).alias("layout_warnings"),
    )
    rows = per_page.join(counted, key, "left").join(ink.drop("samples"), key, "left")
    if rects is not None:
        rows = rows.join(rects.select(key, "question_rects_json"), key, "left")
    total, confirmed = F.coalesce("boxes_total", F.lit(0).cast("bigint")), F.coalesce("boxes_confirmed", F.lit(0).cast("bigint"))
    ink_warning = F.when((confirmed > 0) & F.col("ink_quality").isNull(), F.lit(NO_SPLIT)).when(
        F.col("ink_quality") == "tight", F.concat(
            F.lit("blank and marked ink nearly touch (gap "), shown(F.col("ink_gap")), F.lit(", "),
            F.col("ink_n_marked").cast("string"),
            F.lit(" boxes read as marked) - typical of a light-checkmark scan. Not safe to threshold on.")))
    none = F.array().cast("array<string>")
    warnings = F.concat(
        "page_warnings", F.coalesce("layout_warnings", none),
        F.when(ink_warning.isNotNull(), F.array(ink_warning)).otherwise(none))
    return rows.withColumns({
        "warnings": F.array_join(warnings, " | "), "boxes_total": total, "boxes_confirmed": confirmed,
        "confirm_rate": F.when(total > 0, F.round(confirmed / total, 4)),
    }).drop("page_warnings", "layout_warnings")


def validate_geometry(pages: DataFrame, totals: DataFrame, min_rate: float = 0.8, max_residual: float = 8.0,
                      key: str = "file_name") -> DataFrame:
    """Is a file's geometry good enough: marks on every page, small residuals, boxes confirmed?"""
    good = F.col("marks_found") & (F.col("fit_residual").isNull() | (F.col("fit_residual") <= max_residual))
    checked = pages.groupBy(key).agg(
        F.bool_and(good).alias("registration_ok"), F.max("fit_residual").alias("fit_residual_max"))
    rate = F.when(F.col("boxes_total") > 0, F.col("boxes_confirmed") / F.col("boxes_total")).otherwise(F.lit(0.0))
    joined = totals.select(key, "boxes_confirmed", "boxes_total").join(checked, key, "left")
    registered = F.coalesce("registration_ok", F.lit(False))
    return joined.select(
        key, (registered & (rate >= min_rate)).alias("valid"), registered.alias("registration_ok"),
        F.round(rate, 4).alias("confirm_rate"), "fit_residual_max", "boxes_confirmed", "boxes_total")


def geometry_candidates(questions: DataFrame, validated: DataFrame, min_rate: float = 0.8,
                        key: str = "file_name") -> DataFrame:
    """Every observed question geometry with whether its file and its boxes validate."""
    rate = F.col("boxes_confirmed") / F.nullif(F.col("boxes_total"), F.lit(0).cast("bigint"))
    joined = questions.join(validated.select(key, "valid"), key, "left")
    return joined.withColumn(
        "validated", F.coalesce(F.col("valid") & (rate >= min_rate), F.lit(False))).drop("valid")


def unresolved_geometry(candidates: DataFrame, expected: DataFrame) -> DataFrame:
    """Question keys never seen, or seen and never validated.

    The files behind a key are counted here; their names are the rows of
    :func:`observed_files`, so no key has to carry a list of files.
    """
    seen = candidates.groupBy("question_key").agg(
        F.count("*").alias("observations"), F.bool_or("validated").alias("any_valid"))
    every = expected.select("question_key").distinct().join(seen, "question_key", "full_outer")
    return every.filter(~F.coalesce("any_valid", F.lit(False))).select(
        "question_key", F.substring_index("question_key", "#", 1).alias("question"),
        F.when(F.col("observations").isNull(), F.lit(NOT_SEEN)).otherwise(F.lit(NOT_VALID)).alias("reason"),
        F.coalesce("observations", F.lit(0).cast("bigint")).alias("observations"))


def observed_files(unresolved: DataFrame, candidates: DataFrame, key: str = "file_name") -> DataFrame:
    return candidates.join(unresolved.select("question_key"), "question_key", "left_semi").select("question_key", key)


def review_queue(unresolved: DataFrame, semantics: DataFrame) -> DataFrame:
    """A prompt per unresolved question; reviewed questions get the shorter one."""
    known = semantics.select(
        "question", F.col("question_text").alias("known_text"), F.col("answer_type").alias("known_type"), "status")
    seen = F.when(F.col("observations") > 0, F.concat(
        F.lit(" Observed: "), F.col("observations").cast("string"), F.lit(" file(s)."))).otherwise(F.lit(""))
    reviewed = F.coalesce(F.col("status") == "reviewed", F.lit(False))
    end = F.concat(seen, F.lit(" Reason it needs review: "), F.col("reason"), F.lit("."))
    prompt = F.when(reviewed, F.concat(
        F.lit("Confirm question "), F.col("question"), F.lit(" geometry for '"), F.col("known_text"),
        F.lit("': verify the page (1-based), the "), F.col("known_type"), F.lit(" layouts, and checkbox locations."), end,
    )).otherwise(F.concat(
        F.lit("Confirm question "), F.col("question"),
        F.lit(": identify the printed question text, page (1-based), answer type (single-choice, multi-select, or open "
              "text), choice labels in visual order, and the checkbox/circle locations."), end))
    return unresolved.join(known, "question", "left").select(
        "question_key", "question", "reason", F.coalesce("status", F.lit("pending")).alias("status"), prompt.alias("prompt"))


def label_drift(geometry: DataFrame, schema: DataFrame, form: str = "form_id") -> DataFrame:
    """Where geometry labels and configured choices part: ``missing``, ``extra`` or ``dead``."""
    placed = geometry.select(form, "question", "label").distinct().withColumn("placed", F.lit(True))
    asked = placed.select(form, "question").distinct()
    wanted = schema.withColumn("choice_list", fx.is_choice_list(F.col("choices"))).filter("choice_list").join(
        asked.withColumnRenamed("question", "number"), [form, "number"], "left_semi"
    ).select(form, F.col("number").alias("question"), F.explode(fx.split_choices(F.col("choices"))).alias("label")).distinct()
    both = placed.join(wanted.withColumn("wanted", F.lit(True)), [form, "question", "label"], "full_outer")
    has_list = schema.filter(fx.is_choice_list(F.col("choices"))).select(
        form, F.col("number").alias("question"), F.lit(True).alias("has_list")).distinct()
    kind = (
        F.when(F.col("has_list").isNull(), "dead").when(F.col("placed").isNull(), "missing")
        .when(F.col("wanted").isNull(), "extra"))
    return both.join(has_list, [form, "question"], "left").withColumn("kind", kind).filter("kind IS NOT NULL").groupBy(
        form, "question", "kind").agg(F.array_sort(F.collect_set("label")).alias("labels"))


def expected_boxes(reference: DataFrame, controls: DataFrame, defaults: DataFrame, schema: DataFrame,
                   configured: DataFrame) -> DataFrame:
    """Boxes to look for on each form: reference rows, else approved controls, else defaults.

    Defaults serve only forms without a profile, and only questions that are choice lists.
    """
    columns = ["form_id", "question", "page", "layout", "label", "x0", "x1", "y0", "y1"]
    active = schema.filter(fx.is_choice_list(F.col("choices"))).select("form_id", F.col("number").alias("question"))
    plain = defaults.join(configured.select("form_id"), "form_id", "left_anti").join(
        active, ["form_id", "question"], "left_semi")
    boxes = None
    for rank, frame in enumerate((
        reference.filter("control_type = 'checkbox'"), controls.filter("control_type = 'checkbox'"),
        plain,
    )):
        part = frame.select(*columns, F.lit(rank).alias("source_rank"))
        boxes = part if boxes is None else boxes.unionByName(part)
    first = boxes.groupBy("form_id").agg(F.min("source_rank").alias("source_rank"))
    kept = boxes.join(first, ["form_id", "source_rank"], "left_semi")
    order = Window.partitionBy("form_id", "question").orderBy("layout")
    ranked = kept.select("form_id", "question", "layout").distinct().withColumn(
        "candidate", F.row_number().over(order) - 1).withColumn(
        "layouts", F.count("*").over(Window.partitionBy("form_id", "question")))
    multi = schema.filter("is_multi").select("form_id", F.col("number").alias("question"), F.lit(True).alias("multi")).distinct()
    key = F.when(F.col("layouts") > 1, F.concat_ws("#", "question", F.col("candidate").cast("string"))).otherwise(F.col("question"))
    return kept.join(ranked, ["form_id", "question", "layout"]).join(multi, ["form_id", "question"], "left").select(
        *columns, "candidate", key.alias("question_key"),
        F.when(F.col("multi"), "multiselect").otherwise("yesno_box").alias("kind"))


def folder_counts(listing: DataFrame, root: str, run_date: Column, uri: str = "uri") -> DataFrame:
    """Documents per first folder below the root, with the date the folder stands for."""
    folder = fx.relative_folder(F.col(uri), F.lit(root))
    counts = listing.groupBy(F.coalesce(folder, F.lit("(no folder)")).alias("folder")).agg(F.count("*").alias("documents"))
    dated = F.when(F.col("folder") == "(no folder)", run_date).otherwise(fx.folder_date(F.col("folder"), run_date))
    return counts.withColumn("partition_date", dated)


def with_failure_stubs(listing: DataFrame, profiles: DataFrame, errors: DataFrame, run_date: Column,
                       root: str | None = None) -> DataFrame:
    """Every listed file: its profile, or a stub with null measures and why."""
    failed = errors.groupBy("gcs_uri").agg(F.min("error").alias("error"))
    zero = F.lit(0).cast("bigint")
    folder = fx.relative_folder(F.col("gcs_uri"), F.lit(root)) if root else F.lit(None).cast("string")
    stubs = listing.select(F.col("uri").alias("gcs_uri")).join(profiles, "gcs_uri", "left_anti").join(
        failed, "gcs_uri", "left").withColumn("survey_folder", folder).select(
        "gcs_uri", base_name(F.col("gcs_uri")).alias("file_name"), "survey_folder",
        fx.folder_date(F.col("survey_folder"), run_date).alias("partition_date"),
        zero.alias("boxes_confirmed"), zero.alias("boxes_total"),
        F.concat(F.lit("could not be profiled: "), F.coalesce("error", F.lit("no result"))).alias("warnings"))
    return profiles.unionByName(stubs, allowMissingColumns=True)
