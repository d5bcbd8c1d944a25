"""Page geometry from measurement tables: marks, boxes, rows, controls.

Measurements are pixel positions, so what is gathered per page is bounded by the
page: before any ordering, positions are merged on a grid finer than the
tolerance at hand, with map-side combining.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formspark.functions.text import norm_text
from formspark.sources.writers import stored

# Registration mark side, its tolerance, and how full its box must be.
MARK_SIDE, MARK_TOLERANCE, MARK_FILL = 74, 28, 0.75
CORNERS = ("TL", "TR", "BL", "BR")
# A confirmed box's side limits, and inked share of each side.
BOX_SIDE_MIN, BOX_SIDE_MAX, BOX_SIDE_INK = 18, 55, 0.6
# Controls mapping scores.
ROW_LIMITS = {"yesno_box": (12.0, 600.0), "h3_circle": (18.0, 180.0)}
CHOICE_TYPES, SURE = ("single-choice", "multi-select"), 0.75
CELL = 64
# Cells along a side of the tiles that a page's centres are dealt by.
TILE = 16
TARGET = ["question", "control_type", "page", "layout"]


def _centre(low: str, high: str) -> Column:
    return (F.col(low) + F.col(high)) / 2


def registration_marks(components: DataFrame) -> DataFrame:
    """The four corner marks of each page; a page without exactly one per quadrant has none."""
    w, h = F.col("w"), F.col("h")
    low, high = MARK_SIDE - MARK_TOLERANCE, MARK_SIDE + MARK_TOLERANCE
    fits = (
        w.between(low, high) & h.between(low, high) & (F.abs(w - h) <= MARK_TOLERANCE)
        & (F.col("area") >= MARK_FILL * w * h)
    )
    cx, cy = F.col("x") + w / 2, F.col("y") + h / 2
    corner = F.concat(
        F.when(cy < F.col("page_h") / 2, "T").otherwise("B"),
        F.when(cx < F.col("page_w") / 2, "L").otherwise("R"),
    )
    here = [fits & (corner == c) for c in CORNERS]
    counted = components.groupBy("page_id").agg(
        *[F.count_if(test).alias(f"n_{c}") for test, c in zip(here, CORNERS, strict=True)],
        *[F.max(F.when(test, cx)).alias(f"x_{c}") for test, c in zip(here, CORNERS, strict=True)],
        *[F.max(F.when(test, cy)).alias(f"y_{c}") for test, c in zip(here, CORNERS, strict=True)],
    )
    found = F.lit(True)
    for c in CORNERS:
        found = found & (F.col(f"n_{c}") == 1)
    return counted.select(
        "page_id", found.alias("marks_found"),
        *[F.when(found, F.col(f"{axis}_{c}")).alias(f"{axis}_{c}") for c in CORNERS for axis in "xy"],
    )


def mark_rows(marks: DataFrame, baseline: dict[str, tuple[float, float]]) -> DataFrame:
    """Wide marks to one row per corner beside the baseline's corner."""
    corners = F.explode(F.array(*[
        F.struct(F.lit(c).alias("corner"), F.lit(float(x)).alias("ax"), F.lit(float(y)).alias("ay"),
                 F.col(f"x_{c}").alias("bx"), F.col(f"y_{c}").alias("b_y"))
        for c, (x, y) in baseline.items()
    ]))
    return marks.filter("marks_found").select("page_id", corners.alias("m")).select("page_id", "m.*")


def fit_similarity(marks: DataFrame) -> DataFrame:
    """Least-squares similarity of base onto page marks, all four corners present.

    One grouped pass: the complex factor follows from population moments, and
    each corner is kept beside it for the residual.
    """
    a, b = ("ax", "ay"), ("bx", "b_y")
    sums = marks.groupBy("page_id").agg(
        F.count_distinct("corner").alias("corners"), F.count("*").alias("n"),
        (F.var_pop("ax") + F.var_pop("ay")).alias("v"),
        (F.covar_pop("ax", "bx") + F.covar_pop("ay", "b_y")).alias("re"),
        (F.covar_pop("ax", "b_y") - F.covar_pop("ay", "bx")).alias("im"),
        *[F.avg(c).alias(f"mean_{c}") for c in (*a, *b)],
        *[F.max(F.when(F.col("corner") == k, F.col(c))).alias(f"{c}_{k}") for k in CORNERS for c in (*a, *b)],
    ).filter((F.col("corners") == 4) & (F.col("n") == 4))
    real, imag = F.col("re") / F.nullif(F.col("v"), F.lit(0.0)), F.col("im") / F.nullif(F.col("v"), F.lit(0.0))
    return sums.withColumns({"z_re": real, "z_im": imag}).select(
        "*",
        F.round(F.hypot("z_re", "z_im"), 5).alias("scale"),
        F.round(F.degrees(F.atan2("z_im", "z_re")), 3).alias("rotation_deg"),
        F.round(F.col("bx_TL") - F.col("ax_TL"), 1).alias("offset_dx"),
        F.round(F.col("b_y_TL") - F.col("ay_TL"), 1).alias("offset_dy"),
    ).filter(F.col("z_re").isNotNull())


def _moved(x: Column, y: Column) -> tuple[Column, Column]:
    dx, dy = x - F.col("mean_ax"), y - F.col("mean_ay")
    re, im = F.col("z_re"), F.col("z_im")
    return re * dx - im * dy + F.col("mean_bx"), re * dy + im * dx + F.col("mean_b_y")


def fit_residual(fits: DataFrame) -> DataFrame:
    """Adds ``fit_residual``: the largest error of any coordinate of any mark."""
    errors = []
    for k in CORNERS:
        px, py = _moved(F.col(f"ax_{k}"), F.col(f"ay_{k}"))
        errors += [F.abs(px - F.col(f"bx_{k}")), F.abs(py - F.col(f"b_y_{k}"))]
    return fits.withColumn("fit_residual", F.round(F.greatest(*errors), 2))


def project(points: DataFrame, fits: DataFrame, corrections: DataFrame | None = None,
            on: Sequence[str] = ("page_idx",)) -> DataFrame:
    """Template points on each fitted page, shifted by their question's correction first."""
    if corrections is not None:
        points = points.join(corrections.select("question", "dx", "dy"), "question", "left")
    else:
        points = points.withColumns({"dx": F.lit(0.0), "dy": F.lit(0.0)})
    keep = ["page_id", *on, "z_re", "z_im", "mean_ax", "mean_ay", "mean_bx", "mean_b_y"]
    placed = fits.select(*keep).join(points, list(on))
    px, py = _moved(F.col("x") + F.coalesce("dx", F.lit(0.0)), F.col("y") + F.coalesce("dy", F.lit(0.0)))
    return placed.select("page_id", *[c for c in points.columns if c not in ("dx", "dy")],
                         px.alias("px"), py.alias("py"))


def _cells(low: Column, high: Column) -> Column:
    return F.sequence(F.floor(low / CELL), F.floor(high / CELL))


def confirm_boxes(expected: DataFrame, candidates: DataFrame, pad: int = 8) -> DataFrame:
    """Best candidate rectangle of each expected box, null where none will do.

    The range join runs on page and grid cell: a box meets only the candidates
    whose corner lies in the few cells its window covers, never a whole page.
    """
    cand = candidates.select(
        "page_id", *[F.col(c).alias(f"c_{c}") for c in ("x0", "x1", "y0", "y1")],
        F.floor(F.col("x0") / CELL).alias("cell_x"), F.floor(F.col("y0") / CELL).alias("cell_y"),
    ).where(
        (F.col("x1") - F.col("x0")).between(BOX_SIDE_MIN, BOX_SIDE_MAX)
        & (F.col("y1") - F.col("y0")).between(BOX_SIDE_MIN, BOX_SIDE_MAX)
        & (F.least("ink_top", "ink_bottom", "ink_left", "ink_right") >= BOX_SIDE_INK)
    )
    x0, x1, y0, y1 = (F.col(c) for c in ("x0", "x1", "y0", "y1"))
    window = expected.withColumn("cell_x", F.explode(_cells(x0 - pad, x1 + pad))).withColumn(
        "cell_y", F.explode(_cells(y0 - pad, y1 + pad)))
    inside = (
        (F.col("c_x0") > x0 - pad) & (F.col("c_x1") < x1 + pad - 1)
        & (F.col("c_y0") > y0 - pad) & (F.col("c_y1") < y1 + pad - 1)
    )
    score = F.abs((F.col("c_x1") - F.col("c_x0")) - (x1 - x0)) + F.abs((F.col("c_y1") - F.col("c_y0")) - (y1 - y0))
    hits = window.join(cand, ["page_id", "cell_x", "cell_y"]).filter(inside)
    best = hits.groupBy("page_id", "box").agg(
        F.min(F.struct(score.alias("score"), "c_x0", "c_x1", "c_y0", "c_y1")).alias("best"))
    return expected.join(best, ["page_id", "box"], "left").select(
        "page_id", "box", F.col("best").isNotNull().alias("confirmed"),
        *[F.col(f"best.c_{c}").alias(f"found_{c}") for c in ("x0", "x1", "y0", "y1")],
    )


def cluster_1d(df: DataFrame, keys: Sequence[str], value: str, tolerance: float, mode: str = "round2",
               extra: Sequence[Column] = ()) -> DataFrame:
    """Chains of values whose step to the next is within tolerance, with their mean.

    Values are first merged into buckets of half the tolerance: members of a
    bucket always share a chain, so only bucket edges need ordering.
    """
    edges = _bucket_chains(df, keys, value, tolerance)
    mean = F.sum("bucket_sum") / F.sum("bucket_n")
    shown = mean.cast("int") if mode == "int" else F.round(mean, 2)
    return edges.groupBy(*keys, "chain").agg(
        shown.alias("center"), F.sum("bucket_n").alias("members"),
        F.min("bucket_min").alias("low"), F.max("bucket_max").alias("high"), *extra,
    )


def _bucket(value: Column, tolerance: float | Column) -> Column:
    if not isinstance(tolerance, Column) and tolerance <= 0:
        return value
    return F.floor(value / (tolerance / 2))


def _bucket_chains(df: DataFrame, keys: Sequence[str], value: str, tolerance: float | Column,
                   extra: Iterable[Column] = ()) -> DataFrame:
    buckets = df.groupBy(*keys, _bucket(F.col(value), tolerance).alias("bucket")).agg(
        F.min(value).alias("bucket_min"), F.max(value).alias("bucket_max"),
        F.count("*").alias("bucket_n"), F.sum(value).alias("bucket_sum"), *extra,
    )
    order = Window.partitionBy(*keys).orderBy("bucket")
    starts = F.coalesce(F.col("bucket_min") - F.lag("bucket_max").over(order) > tolerance, F.lit(False))
    return buckets.withColumn("starts", starts.cast("int")).withColumn(
        "chain", F.sum("starts").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("starts")


def _spans() -> list[Column]:
    return [
        F.min("x0").alias("b_x0"), F.max("x1").alias("b_x1"), F.min("y0").alias("b_y0"),
        F.max("y1").alias("b_y1"), F.sum(_centre("x0", "x1")).alias("b_cx"),
    ]


def control_rows(rects: DataFrame, keys: Sequence[str], y_gap: float | Column) -> DataFrame:
    """Controls grouped to visual rows by vertical centre; rows without extent are dropped.

    ``y_low`` and ``y_high`` are the outermost centres of a row; no centre of another row of its keys lies between them.
    The gap may depend on the keys, for instance on the control type.
    """
    chains = _bucket_chains(rects.withColumn("cy", _centre("y0", "y1")), keys, "cy", y_gap, _spans())
    rows = chains.groupBy(*keys, "chain").agg(
        F.sum("bucket_n").alias("count"),
        (F.max("b_x1") - F.min("b_x0")).alias("x_span"), (F.max("b_y1") - F.min("b_y0")).alias("y_span"),
        (F.sum("b_cx") / F.sum("bucket_n")).alias("x_center"),
        (F.sum("bucket_sum") / F.sum("bucket_n")).alias("y_center"),
        F.min("bucket_min").alias("y_low"), F.max("bucket_max").alias("y_high"),
    )
    return rows.filter((F.col("x_span") > 0) & (F.col("y_span") > 0))


def collapse_nested(rects: DataFrame, apart: float = 10) -> DataFrame:
    """Largest first, drop rectangles whose centre is within ``apart`` px of a kept one.

    Of equal centres only the first can be kept, so each centre comes down to one row map-side. The rest is settled in
    rounds: a centre with no open earlier one near it is kept, and what lies near it is dropped, which is what taking all
    of them in order gives. Two centres in one cell of side ``apart`` are always near, so a cell offers one centre a round.
    Rounds follow the longest chain of centres that hang on one another.
    """
    order = F.struct((-F.col("area")).alias("o_area"), F.col("y0").alias("o_y0"), F.col("x0").alias("o_x0"),
                     F.col("x1").alias("o_x1"), F.col("y1").alias("o_y1"))
    still_open = stored(rects.groupBy("page_id", _centre("x0", "x1").alias("cx"), _centre("y0", "y1").alias("cy")).agg(
        F.min(order).alias("o")).select("page_id", "o"))
    kept = []
    while True:
        settled = stored(_settle_nested(still_open, apart))
        kept.append(settled.filter("kept"))
        still_open = settled.filter("NOT kept").select("page_id", "o")
        if still_open.isEmpty():
            break
    chosen = reduce(DataFrame.unionByName, kept).select("page_id", "o.*")
    return chosen.select("page_id", F.col("o_x0").alias("x0"), F.col("o_x1").alias("x1"), F.col("o_y0").alias("y0"),
                         F.col("o_y1").alias("y1"), (-F.col("o_area")).alias("area"))


def _settle_nested(still_open: DataFrame, apart: float) -> DataFrame:
    """One round: the centres kept, and those left open, told apart by ``kept``; what was dropped is gone.

    Centres are dealt by tiles of a page; a tile also gets what lies within two cells of its edge. That decides all of
    its own: whether one is kept hangs on the cells next to it, whether one is dropped on a kept one that near. So
    neighbours meet on the key they were dealt by, and a centre meets at most one first of each cell of its tile.
    """
    tile, axes = ["page_id", "tile_x", "tile_y"], "xy"
    centre = {"x": (F.col("o.o_x0") + F.col("o.o_x1")) / 2, "y": (F.col("o.o_y0") + F.col("o.o_y1")) / 2}
    cells = {axis: F.floor(centre[axis] / apart) for axis in axes}
    dealt = still_open
    for axis in axes:
        low, high = (F.floor((cells[axis] + off) / TILE) for off in (-2, 2))
        dealt = dealt.withColumn(f"tile_{axis}", F.explode(F.sequence(low, high)))
    local = dealt.select(*tile, "o").repartition(*tile).select(
        *tile, "o", *[centre[a].alias(f"c{a}") for a in axes], *[cells[a].alias(f"cell_{a}") for a in axes])

    def met(frame: DataFrame) -> DataFrame:
        return frame.select(*[F.col(c).alias(f"n_{c}") for c in (*tile, "cx", "cy", "o")])

    meets = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"n_{c}") for c in tile]) \
        & (F.abs(F.col("cx") - F.col("n_cx")) < apart) & (F.abs(F.col("cy") - F.col("n_cy")) < apart)
    first = local.groupBy(*tile, "cell_x", "cell_y").agg(F.min("o").alias("o")).withColumns({f"c{a}": centre[a] for a in axes})
    known = reduce(lambda a, b: a & b, [
        (F.col(f"cell_{a}") >= F.col(f"tile_{a}") * TILE - 1) & (F.col(f"cell_{a}") <= (F.col(f"tile_{a}") + 1) * TILE) for a in axes])
    keeps = first.filter(known).join(met(local), meets & (F.col("n_o") < F.col("o")), "left_anti")
    own = reduce(lambda a, b: a & b, [F.floor(F.col(f"cell_{a}") / TILE) == F.col(f"tile_{a}") for a in axes])
    # Kept ones are never near each other, so one meets itself alone; the others that meet any are dropped.
    seen = local.filter(own).join(met(keeps), meets, "left")
    return seen.filter(F.col("n_o").isNull() | (F.col("n_o") == F.col("o"))).select("page_id", "o", F.col("n_o").isNotNull().alias("kept"))


def _form(*frames: DataFrame) -> list[str]:
    """The form's key, where every frame carries it."""
    return ["form_id"] if all("form_id" in frame.columns for frame in frames) else []


def _nearest_pairs(targets: DataFrame, detected: DataFrame, max_d: float) -> DataFrame:
    """Target and detected control pairs within reach, at most as many per target as can matter.

    A layout with T targets can use up at most T - 1 controls before a target's
    turn, so its T nearest always hold its match and farther ones are left out.
    """
    form = _form(targets, detected)
    target = [*form, *TARGET]
    size = targets.groupBy(*target).agg(F.count("*").alias("layout_size"))
    aimed = targets.join(size, target).select(
        *target, "label", "target_index", "layout_size",
        _centre("x0", "x1").alias("tx"), _centre("y0", "y1").alias("ty"))
    for axis in "xy":
        cell = F.floor(F.col(f"t{axis}") / max_d)
        aimed = aimed.withColumn(f"cell_{axis}", F.explode(F.sequence(cell - 1, cell + 1)))
    rect = ["x0", "x1", "y0", "y1"]
    shapes = detected.groupBy(*form, "doc", "page", "control_type", *rect).agg(F.count("*").alias("copies"))
    cells = shapes.select(
        "*", _centre("x0", "x1").alias("dx"), _centre("y0", "y1").alias("dy"),
        F.floor(_centre("x0", "x1") / max_d).alias("cell_x"), F.floor(_centre("y0", "y1") / max_d).alias("cell_y"))
    delta = F.sqrt((F.col("tx") - F.col("dx")) ** 2 + (F.col("ty") - F.col("dy")) ** 2)
    pairs = cells.join(aimed, [*form, "page", "control_type", "cell_x", "cell_y"]).withColumn("delta", delta).filter(
        F.col("delta") <= max_d)
    pairs = pairs.withColumn("copy", F.explode(F.sequence(
        F.lit(1).cast("bigint"), F.least("copies", "layout_size"))))
    nearest = Window.partitionBy("doc", *target, "target_index").orderBy("delta", "y0", "x0", "x1", "y1", "copy")
    # The largest layout, one number, as a literal: Spark then limits every task's rows before the exchange.
    most = size.agg(F.coalesce(F.max("layout_size"), F.lit(0))).first()[0]
    place = F.col("place")
    return pairs.withColumn("place", F.row_number().over(nearest)).filter((place <= most) & (place <= F.col("layout_size")))


def match_controls(targets: DataFrame, detected: DataFrame, max_d: float = 80.0) -> DataFrame:
    """Greedy one-to-one matching of detected controls to a layout's labelled targets.

    A layout of T targets has at most T * T pairs left, taken nearest first. With ``form_id`` on both
    sides a document meets the layouts of its own form only; here and in the functions below.
    """
    target = [*_form(targets, detected), *TARGET]
    control = ["y0", "x0", "x1", "y1", "copy"]
    pairs = F.array_sort(F.collect_list(F.struct("delta", "target_index", *control, "label")))

    def clash(one: Column, other: Column) -> Column:
        same = F.lit(True)
        for field in control:
            same = same & (one[field] == other[field])
        return (one["target_index"] == other["target_index"]) | same

    def take(chosen: Column, pair: Column) -> Column:
        taken = F.exists(chosen, lambda other: clash(pair, other))
        return F.when(taken, chosen).otherwise(F.array_append(chosen, pair))

    grouped = _nearest_pairs(targets, detected, max_d).groupBy("doc", *target).agg(pairs.alias("pairs"))
    matched = grouped.withColumn("m", F.explode(F.aggregate("pairs", F.slice("pairs", 1, 0), take)))
    return matched.select(
        "doc", *target, "m.label", "m.target_index", "m.x0", "m.x1", "m.y0", "m.y1", "m.delta",
        F.round(F.greatest(F.lit(0.0), 1 - F.col("m.delta") / max_d), 3).alias("confidence"))


def choose_layout(matches: DataFrame, targets: DataFrame, detected: DataFrame) -> DataFrame:
    """Layout of each question: most matches, then least distance, then highest layout."""
    form = _form(targets, detected)
    group, target = [*form, "question", "control_type", "page"], [*form, *TARGET]
    layouts = targets.groupBy(*target).agg(F.count("*").alias("layout_size"))
    offered = detected.select("doc", *form, "page").distinct().join(layouts, [*form, "page"])
    scored = matches.groupBy("doc", *target).agg(
        F.count("*").alias("matches"), F.sum("delta").alias("total"), F.max("delta").alias("farthest"))
    zero = offered.join(scored, ["doc", *target], "left").select(
        "doc", *target, "layout_size", F.coalesce("matches", F.lit(0).cast("bigint")).alias("matches"),
        F.coalesce("total", F.lit(0.0)).alias("total"), "farthest")
    best = zero.groupBy("doc", *group).agg(
        F.max(F.struct("matches", (-F.col("total")).alias("closeness"), "layout", "layout_size", "farthest")).alias("best"),
        F.count("*").alias("layouts"))
    return best.select(
        "doc", *group, F.col("best.layout").alias("layout"), F.col("best.matches").alias("matches"),
        (-F.col("best.closeness")).alias("total_delta"), F.col("best.layout_size").alias("layout_size"), "layouts",
        F.col("best.farthest").alias("farthest_delta"))


def match_metrics(chosen: DataFrame, matches: DataFrame, detected: DataFrame) -> DataFrame:
    """Per document: expected, detected and matched controls, and centre distances of the chosen layouts' matches.

    Rows of ``choose_layout`` carry number, sum and largest of the distances; ``matches`` are met only where they don't.
    """
    if "farthest_delta" not in chosen.columns:
        target = ["doc", *_form(chosen, matches), *TARGET]
        spread = matches.groupBy(*target).agg(F.sum("delta").alias("total_delta"), F.max("delta").alias("farthest_delta"))
        chosen = chosen.drop("total_delta").join(spread, target, "left")
    totals = chosen.groupBy("doc").agg(
        F.sum("layout_size").alias("expected_controls"), F.sum("layouts").alias("available_layout_candidates"),
        F.sum("matches").alias("matched_controls"),
        F.round(F.sum("total_delta") / F.nullif(F.sum("matches"), F.lit(0)), 2).alias("mean_center_delta_px"),
        F.round(F.max("farthest_delta"), 2).alias("max_center_delta_px"))
    seen = detected.groupBy("doc").agg(F.count("*").alias("detected_controls"))
    zero = F.lit(0).cast("bigint")
    counts = ["expected_controls", "available_layout_candidates", "matched_controls"]
    return (
        seen.join(totals, "doc", "left")
        .withColumns({c: F.coalesce(c, zero) for c in counts})
        .withColumns({
            "unmatched_expected_controls": F.col("expected_controls") - F.col("matched_controls"),
            "unmatched_detected_controls": F.col("detected_controls") - F.col("matched_controls"),
        })
    )


def _known_controls(controls: DataFrame) -> tuple[DataFrame, list[str], Column]:
    """Check boxes and circles, the keys of their rows, and the vertical gap that ends a row."""
    circle = F.col("control_type") == "circle"
    gap = F.when(circle, ROW_LIMITS["h3_circle"][0]).otherwise(ROW_LIMITS["yesno_box"][0])
    keys = [*(["form_id"] if "form_id" in controls.columns else []), "doc", "page", "control_type"]
    return controls.filter(F.col("control_type").isin("checkbox", "circle")), keys, gap


def mappable_rows(controls: DataFrame) -> DataFrame:
    """Control rows of each page wide enough to be a question's choices."""
    known, keys, gap = _known_controls(controls)
    circle = F.col("control_type") == "circle"
    wide = F.col("x_span") >= F.when(circle, ROW_LIMITS["h3_circle"][1]).otherwise(ROW_LIMITS["yesno_box"][1])
    return control_rows(known, keys, gap).filter((F.col("count") >= 2) & wide).withColumn(
        "kind", F.when(circle, "h3_circle").otherwise("yesno_box"))


def usable_template(template: DataFrame) -> DataFrame:
    """Questions of the form templates that controls can be mapped to, with what mapping needs to know of them.

    A template row is a question: ``form_id`` (where jobs hold several forms), ``question``, ``place`` in the form's
    order, ``labels``, and where given ``answer_type``, ``control_type`` (``checkbox`` or ``circle``) and ``anchors``,
    further words that name it. Without ``control_type``, H3 is the question of circles, named by its setting.
    Questions without labels are left out unless they are circles; open questions never take a row of boxes.
    """
    given = template.columns
    h3 = F.col("question") == "H3"
    circle = (F.col("control_type") == "circle") if "control_type" in given else h3
    anchors = F.coalesce(F.col("anchors"), F.array()) if "anchors" in given else F.when(
        h3, F.array(F.lit("h3"), F.lit("setting"))).otherwise(F.array().cast("array<string>"))
    chosen = F.col("answer_type").isin(*CHOICE_TYPES) if "answer_type" in given else F.lit(True)
    form = ["form_id"] if "form_id" in given else []
    rows = template.select(
        *form, "question", "place", F.coalesce("labels", F.array().cast("array<string>")).alias("labels"), anchors.alias("anchors"),
        F.when(circle, "h3_circle").otherwise("yesno_box").alias("kind"), (circle | F.coalesce(chosen, F.lit(False))).alias("takes_rows"))
    return rows.filter((F.size("labels") > 0) | (F.col("kind") == "h3_circle"))


def anchor_hits(words: DataFrame, template: DataFrame) -> DataFrame:
    """How often each page's words name a question, one of its choices or one of its anchors."""
    form = _form(words, template)
    named = F.concat(F.array("question"), "labels", "anchors")
    terms = template.select(*form, "question", F.explode(named).alias("term")).withColumn("term", norm_text(F.col("term")))
    said = words.select(*form, "doc", "page", norm_text(F.col("text")).alias("term")).filter("term <> ''")
    return said.join(terms, [*form, "term"]).groupBy(*form, "doc", "page", "question").agg(F.count("*").alias("hits"))


def _offers(controls: DataFrame, words: DataFrame, asked: DataFrame) -> DataFrame:
    """Rows of controls with their candidate questions, best first: ``off``, ``place``, ``question``, ``score``, ``sure``."""
    form = _form(controls, asked)
    row = [*form, "doc", "page", "control_type", "kind", "chain", "count", "y_center", "y_low", "y_high"]
    fits = asked.filter("takes_rows").select(*form, "kind", "question", "place", F.size("labels").alias("labels"))
    off = F.abs(F.col("labels") - F.col("count"))
    said = words.filter(norm_text(F.col("text")) != "").groupBy(*form, "doc", "page").agg(F.lit(True).alias("has_words"))
    offered = mappable_rows(controls).select(*row).join(fits, [*form, "kind"]).withColumn("off", off).filter("off <= 1") \
        .join(said, [*form, "doc", "page"], "left").join(anchor_hits(words, asked), [*form, "doc", "page", "question"], "left")
    score = F.when(F.col("off") == 0, 0.8).otherwise(0.65)
    score = F.when(F.col("hits") > 0, F.least(F.lit(0.96), score + 0.12 * F.least("hits", F.lit(3)))).otherwise(score)
    score = F.when(F.col("has_words"), F.least(F.lit(0.97), score + 0.05)).otherwise(score)
    best_first = F.array_sort(F.collect_list(F.struct("off", "place", "question", "score", (F.col("score") >= SURE).alias("sure"))))
    return offered.withColumn("score", score).groupBy(*row).agg(best_first.alias("candidates"))


def _assigned(offers: DataFrame, pages: DataFrame, form: list[str], pages_at_once: int) -> DataFrame:
    """Every offered row with the question it gets, in order of page and height.

    A row takes its best question that no earlier row has; if that one is sure it is gone for the rows below. What an
    ordered pass has to know is the list of questions gone and where, as long as the template. Boxes and circles never
    compete, so they pass apart; a document of more than ``pages_at_once`` pages passes in as many rounds, each
    starting from the list of the one before. ``pages`` (``page``) holds all pages that offers can lie on.
    """
    key = [*form, "doc", "kind"]
    block = F.floor(F.col("page") / pages_at_once)
    gone_type = "array<struct<page:int,y_center:double,question:string>>"

    def open_first(line: Column, gone: Column) -> Column:
        return F.get(F.filter(line["candidates"], lambda c: ~F.exists(gone, lambda g: g["question"] == c["question"])), 0)

    def take(gone: Column, line: Column) -> Column:
        best = open_first(line, gone)
        mark = F.struct(line["page"].alias("page"), line["y_center"].alias("y_center"), best["question"].alias("question"))
        return F.when(best["sure"], F.array_append(gone, mark)).otherwise(gone)

    def blocks_of(frame: DataFrame) -> list[int]:
        return [r[0] for r in frame.select(block.alias("block")).distinct().orderBy("block").collect()]

    # Most forms have fewer pages than a round takes; only where some have more are the offers worked out to find their rounds.
    blocks = blocks_of(pages)
    if len(blocks) > 1:
        offers = stored(offers)
        blocks = blocks_of(offers)
    known, found = None, []
    for number in blocks or [0]:
        part = offers if len(blocks) < 2 else offers.filter(block == number)
        lines = F.array_sort(F.collect_list(F.struct("page", "y_center", "control_type", "chain", "count", "y_low", "y_high", "candidates")))
        passed = part.groupBy(*key).agg(lines.alias("lines"))
        before = F.array().cast(gone_type)
        if known is not None:
            passed, before = passed.join(known, key, "left"), F.coalesce("known", before)
        # The pass gives where questions went; each row then looks at what had gone above it.
        passed = passed.withColumn("gone", F.aggregate("lines", before, take))
        if len(blocks) > 1:
            passed = stored(passed)
            latest = passed.select(*key, "gone")
            older = latest if known is None else latest.unionByName(known.withColumnRenamed("known", "gone"))
            known = stored(older.groupBy(*key).agg(F.max_by("gone", F.size("gone")).alias("known")))
        line = passed.select(*key, "gone", F.explode("lines").alias("line"))
        above = F.filter("gone", lambda g: (g["page"] < F.col("line.page")) | (
            (g["page"] == F.col("line.page")) & (g["y_center"] < F.col("line.y_center"))))
        best = open_first(F.col("line"), above)
        found.append(line.select(*key, "line.page", "line.control_type", "line.chain", F.col("line.count").alias("controls"),
                                 "line.y_low", "line.y_high", best.alias("best")))
    return reduce(DataFrame.unionByName, found).filter(F.col("best").isNotNull())


def map_controls(controls: DataFrame, words: DataFrame, template: DataFrame, pages_at_once: int = 500) -> DataFrame:
    """Control rows to the questions of their form's template, document by document.

    One row for each question tried, and one for each that is left open in a document: ``doc``, ``question``, ``page``,
    ``kind``, ``control_type``, ``chain`` (the row of the page), ``controls``, ``y_low``, ``y_high`` (its outermost centres),
    ``expected`` (its labels), ``confidence``, ``resolved`` and ``reason``. With ``form_id`` on all sides, documents meet the template of their own
    form. ``template`` is as in ``usable_template``.
    """
    form = _form(controls, words, template)
    asked = usable_template(template)
    tried = _assigned(_offers(controls, words, asked), controls.select("page"), form, pages_at_once).select(
        *form, "doc", "best.question", "page", "kind", "control_type", "chain", "controls", "y_low", "y_high",
        F.round("best.score", 3).alias("confidence"), F.col("best.sure").alias("resolved"))
    # Read for itself and for what it leaves open, so the assignment is written out once.
    tried = stored(tried)
    docs = controls.select(*form, "doc").unionByName(words.select(*form, "doc")).distinct()
    questions = asked.select(*form, "question", F.size("labels").alias("expected"))
    # A document has every question of its form once; without forms there is one template for all.
    due = docs.join(questions, form) if form else docs.withColumn("one", F.lit(1)).join(
        questions.withColumn("one", F.lit(1)), "one").drop("one")
    done = tried.filter("resolved").select(*form, "doc", "question")
    left = due.join(done, [*form, "doc", "question"], "left_anti").select(
        *form, "doc", "question", *[F.lit(None).cast(tried.schema[c].dataType).alias(c) for c in ("page", "kind", "control_type", "chain", "controls", "y_low", "y_high")],
        F.lit(0.0).alias("confidence"), F.lit(False).alias("resolved"))
    lines = tried.unionByName(left).join(questions, [*form, "question"])
    return lines.withColumn("reason", F.when(F.col("resolved"), F.lit(None).cast("string")).when(
        F.col("page").isNull(), F.lit("no high-confidence geometry match was found for this survey control")).otherwise(
        F.lit("count/order matched but layout confidence stayed below threshold")))


def mapped_labels(mapped: DataFrame, controls: DataFrame, template: DataFrame) -> DataFrame:
    """The rectangle of every choice label of the questions that ``map_controls`` resolved, left to right.

    The n-th label gets the row's n-th control by left, then upper edge; a label beyond the row's controls has none, and
    a control beyond the labels belongs to none. A resolved row holds at most one control more than its question has labels.
    """
    form = _form(mapped, controls, template)
    known = _known_controls(controls)[0]
    place = [*form, "doc", "page", "control_type"]
    row = [*place, "chain"]
    resolved = mapped.filter("resolved").select(*row, "kind", "question", "confidence", "y_low", "y_high")
    across = Window.partitionBy(*row).orderBy("x0", "y0", "x1", "y1")
    # A row holds all centres between its outermost, and a page has no more resolved rows than its form has questions.
    placed = known.select(*place, "x0", "x1", "y0", "y1").join(resolved, place) \
        .filter(_centre("y0", "y1").between(F.col("y_low"), F.col("y_high"))) \
        .withColumn("label_index", F.row_number().over(across) - 1)
    labels = usable_template(template).select(*form, "question", F.posexplode("labels").alias("label_index", "label"))
    return placed.join(labels, [*form, "question", "label_index"]).select(
        *form, "doc", "question", "label_index", "label", "page", "kind", "x0", "x1", "y0", "y1", "confidence")


def active_layout(questions: DataFrame, key: str = "file_name") -> DataFrame:
    """Flags, per question with alternatives, the layout with the best confirmed geometry."""
    rate = F.col("boxes_confirmed") / F.greatest(F.col("boxes_total"), F.lit(1))
    best = questions.groupBy(key, "question").agg(
        F.max(F.struct(F.col("boxes_confirmed"), rate.alias("rate"), (-F.col("candidate")).alias("first"))).alias("b"))
    chosen = best.select(key, "question", (-F.col("b.first")).alias("active_candidate"))
    return questions.join(chosen, [key, "question"]).withColumn(
        "active_layout", F.col("candidate") == F.col("active_candidate")).drop("active_candidate")


def border_coverage(sides: DataFrame) -> DataFrame:
    """Mean inked share of a box's four sides; a box that leaves the page has none."""
    return sides.groupBy("page_id", "box").agg(
        F.when(F.bool_and("inside"), F.avg("coverage")).otherwise(F.lit(0.0)).alias("coverage"))


def margin_shadow(strips: DataFrame, bands: int = 20, band_ink: float = 0.01) -> DataFrame:
    """Worse margin of each page: its ink coverage, and how many bands are inked.

    A strip is first brought to one row per pixel line, so what a side orders is
    bounded by page height.
    """
    lines = strips.groupBy("page_id", "side", "y").agg(F.avg("ink").alias("ink"))
    order = Window.partitionBy("page_id", "side").orderBy("y")
    banded = lines.withColumn("band", F.ntile(bands).over(order))
    per_band = banded.groupBy("page_id", "side", "band").agg(F.sum("ink").alias("s"), F.count("*").alias("n"))
    per_side = per_band.groupBy("page_id", "side").agg(
        (F.sum("s") / F.sum("n")).alias("coverage"), F.count_if(F.col("s") / F.col("n") > band_ink).alias("bands"))
    worst = per_side.groupBy("page_id").agg(F.max(F.struct(
        "coverage", F.when(F.col("side") == "left", 1).otherwise(0).alias("left_first"), "bands")).alias("w"))
    positive = F.col("w.coverage") > 0
    return worst.select(
        "page_id", F.when(positive, F.col("w.coverage")).otherwise(F.lit(0.0)).alias("shadow_coverage"),
        F.when(positive, F.col("w.bands")).otherwise(F.lit(0).cast("bigint")).alias("shadow_bands"))


def grid_rows(line_sums: DataFrame, columns: int = 6, lines: int = 19,
              low: float = 45, high: float = 145) -> DataFrame:
    """Ruled lines of the answer grid: the first ``lines`` of the longest evenly spaced run."""
    strong = line_sums.filter(F.col("line_sum") > F.col("page_w") * 0.5)
    if columns != 6:
        strong = strong.filter(F.lit(False))
    ruled = cluster_1d(strong, ["page_id"], "y", 3, "int")
    order = Window.partitionBy("page_id").orderBy("center")
    breaks = ~F.coalesce((F.col("center") - F.lag("center").over(order)).between(low, high), F.lit(False))
    runs = ruled.withColumn("breaks", breaks.cast("int")).withColumn(
        "run", F.sum("breaks").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    length = runs.groupBy("page_id", "run").agg(F.count("*").alias("length"))
    best = length.groupBy("page_id").agg(F.max(F.struct("length", (-F.col("run")).alias("first"))).alias("b")).filter(
        F.col("b.length") >= lines).select("page_id", (-F.col("b.first")).alias("run"))
    within = Window.partitionBy("page_id", "run").orderBy("center")
    kept = runs.join(best, ["page_id", "run"], "left_semi").withColumn("i", F.row_number().over(within)).filter(
        F.col("i") <= lines)
    return kept.groupBy("page_id").agg(F.array_sort(F.collect_list("center")).alias("rows"))


def overflow_rows(cells: DataFrame, least: float = 0.03) -> DataFrame:
    """Grid rows where ink between columns rises above the row's own floor."""
    per_row = cells.groupBy("page_id", "grid_row").agg(
        F.min(F.when(F.col("kind") == "box", F.col("density"))).alias("floor"),
        F.max(F.when(F.col("kind") == "gap", F.col("density"))).alias("between"))
    over = F.coalesce(F.greatest(F.lit(0.0), F.col("between") - F.col("floor")) >= least, F.lit(False))
    return per_row.groupBy("page_id").agg(
        F.array_sort(F.collect_list(F.when(over, F.col("grid_row")))).alias("overflow_rows"))


def draft_profile(pages: DataFrame, rects: DataFrame, key: str = "form_id") -> DataFrame:
    """Draft of a form: its first file, median ink threshold, median box side."""
    first = pages.groupBy(key).agg(F.min("file_name").alias("first_file"))
    sides = rects.select(key, F.explode(F.array(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))).alias("side"))
    ink, side = median_by_counts(pages, key, "ink_threshold"), median_by_counts(sides, key, "side")
    return first.join(ink, key, "left").join(side, key, "left").select(
        key, "first_file", F.round("ink_threshold", 2).alias("ink_threshold"), F.round("side", 2).alias("box_expected_size"))


def median_by_counts(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Exact median of the values of each key (nulls aside), whatever their number and however finely they differ.

    Equal values become a count map-side. Counts of whole units are summed along the key first, to find the one or two
    units that hold the middle; only the values in those are then ordered.
    """
    counts = rows.filter(F.col(value).isNotNull()).groupBy(key, F.col(value).cast("double").alias("v")).agg(F.count("*").alias("n"))
    counts = counts.withColumn("unit", F.floor("v"))
    along = Window.partitionBy(key).orderBy("unit").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    units = counts.groupBy(key, "unit").agg(F.sum("n").alias("held")).select(
        key, "unit", "held", (F.sum("held").over(along) - F.col("held")).alias("below"),
        F.sum("held").over(Window.partitionBy(key)).alias("total"))
    low, high = F.floor((F.col("total") + 1) / 2), F.floor(F.col("total") / 2) + 1
    middle = units.filter((F.col("below") < high) & (F.col("below") + F.col("held") >= low)).select(
        key, "unit", "below", low.alias("low"), high.alias("high"))
    inside = Window.partitionBy(key, "unit").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = F.col("below") + F.sum("n").over(inside)
    placed = counts.join(middle, [key, "unit"]).withColumn("upto", upto)

    def at(rank: str) -> Column:
        return F.min(F.when(F.col("upto") >= F.col(rank), F.col("v")))

    return placed.groupBy(key).agg(((at("low") + at("high")) / 2).alias(value))


def draft_baseline(pages: DataFrame, key: str = "form_id") -> DataFrame:
    """Marks of each page of a form's first file: a mix of scans would fit none of them."""
    first = pages.groupBy(key).agg(F.min("file_name").alias("file_name"))
    return pages.join(first, [key, "file_name"], "left_semi").filter("marks IS NOT NULL").select(
        key, "file_name", "page", "marks")


def draft_columns(rects: DataFrame, key: str = "form_id", tolerance: float = 12) -> DataFrame:
    """Column centres of a draft: chains of box centres."""
    return cluster_1d(rects.withColumn("cx", _centre("x0", "x1")), [key], "cx", tolerance)
