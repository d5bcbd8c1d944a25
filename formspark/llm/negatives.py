"""Hard negatives of anchors among all vectors, with pruning by length and by coordinate.

Vectors lie in buckets of similar length, each with sorted lists of its rows' coordinates. For a score to reach an anchor's
threshold, a row's direction must lie near the anchor's, which bounds each of its coordinates: the values allowed for the
anchor's largest (focus) coordinates are ranges of the sorted lists, and only rows in all of them go on. The focus coordinates'
partial product plus the lengths of both remainders bounds the score again, and what is left is multiplied out exactly.

Two rounds over the same blocks: the best rows of the anchor's label, which set thresholds; then rows of other labels with a
score between the thresholds. Anchors are a stated share of the rows; blocks of anchors meet blocks of rows in tasks of bounded
size, and a task returns a few rows per anchor.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formspark.llm.shared import checkpointed

SCALE = 256
ANCHOR_EVERY = 100
POSITIVES = 5
NEGATIVES = 5
LOW_PERCENT = 80
BLOCK_BYTES = 16 << 20
BUCKET_ROWS = 1024
LENGTH_STEP = 1.1
FOCUS = 3
_NONE = np.iinfo(np.int64).min
_MOST_SQUARE = float(1 << 55)


class Bucket:
    """Rows of similar length: integer vectors, their lengths, directions, and for every coordinate the rows in its order."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.lengths = np.linalg.norm(vectors.astype(np.float64), axis=1)
        self.longest = float(self.lengths.max(initial=0))
        self.turned = vectors / np.where(self.lengths > 0, self.lengths, 1)[:, None]
        self.order = np.argsort(self.turned, axis=0, kind="stable").T
        self.sorted = np.take_along_axis(self.turned.T, self.order, axis=1)

    def candidates(self, anchors: np.ndarray, lengths: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """(anchor, row) of all pairs whose score may reach the anchor's ``least``; None where nearly every pair may.

        ``anchors`` are directions. Rows of the bucket are at most ``longest`` long, so a pair needs a cosine of at least
        ``least / (length * longest)``; where that is not positive nothing can be pruned.
        """
        with np.errstate(divide="ignore", invalid="ignore"):
            need = np.where(lengths * self.longest > 0, least / (lengths * self.longest), np.where(least > 0, np.inf, -np.inf)) - 1e-9
        alive = np.flatnonzero(need <= 1)
        if not len(alive):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        width = anchors.shape[1]
        if not width or (need[alive] <= 0).mean() > 0.5:
            return None
        focus = np.argsort(-np.abs(anchors[alive]), axis=1)[:, :min(FOCUS, width)]
        theta = np.clip(need[alive], 0, 1)[:, None]
        value = np.take_along_axis(anchors[alive], focus, axis=1)
        give = np.sqrt((1 - theta * theta) * np.maximum(0, 1 - value * value)) + 1e-9
        # Below the threshold's own cosine a direction may turn to an edge of the range; beyond it the edge is 1.
        low = np.where(value <= -theta, -1.0, value * theta - give)
        high = np.where(value >= theta, 1.0, value * theta + give)
        free = need[alive] <= 0
        low[free], high[free] = -np.inf, np.inf
        first, last = np.empty(focus.shape, np.int64), np.empty(focus.shape, np.int64)
        for axis in np.unique(focus):
            here = focus == axis
            first[here] = np.searchsorted(self.sorted[axis], low[here] - 1e-9, "left")
            last[here] = np.searchsorted(self.sorted[axis], high[here] + 1e-9, "right")
        size = last - first
        tight = size.argmin(axis=1)
        pick = np.arange(len(alive))
        count = size[pick, tight]
        # Lists that hold most rows cost more to intersect than a product of the block.
        if count.sum() * 4 > len(alive) * len(self.ids):
            return None
        who = np.repeat(pick, count)
        at = np.arange(len(who)) - np.repeat(np.cumsum(count) - count, count) + first[pick, tight][who]
        rows = self.order[focus[pick, tight][who], at]
        product, mine, theirs = np.zeros(len(who)), np.zeros(len(who)), np.zeros(len(who))
        fits = np.ones(len(who), bool)
        for nth in range(focus.shape[1]):
            seen = self.turned[rows, focus[who, nth]]
            fits &= (seen >= low[who, nth] - 1e-9) & (seen <= high[who, nth] + 1e-9)
            product += seen * value[who, nth]
            mine += value[who, nth] ** 2
            theirs += seen ** 2
        rest = np.sqrt(np.maximum(0, 1 - mine) * np.maximum(0, 1 - theirs))
        fits &= product + rest >= need[alive][who] - 1e-9
        return alive[who[fits]], rows[fits]


def _exact(left: np.ndarray, right: np.ndarray) -> type:
    """A number type in which no sum of products of these rows is rounded (or wraps), by the lengths' product."""
    most = math.sqrt(float((left.astype(np.float64) ** 2).sum(axis=1).max(initial=0))) * \
        math.sqrt(float((right.astype(np.float64) ** 2).sum(axis=1).max(initial=0)))
    return np.float32 if most < 1 << 23 else np.float64 if most < 1 << 52 else np.int64


def scores_of(anchors: np.ndarray, bucket: Bucket, pairs: tuple[np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, exact integer score) of the pairs, or of all."""
    kind = _exact(anchors, bucket.vectors)
    a, b = anchors.astype(kind), bucket.vectors.astype(kind)
    if pairs is None:
        product = (a @ b.T).astype(np.int64)
        who, row = np.divmod(np.arange(product.size), max(1, len(b)))
        return who, row, product.ravel()
    who, row = pairs
    found = np.empty(len(who), np.int64)
    for start in range(0, len(who), 1 << 16):
        part = slice(start, start + (1 << 16))
        found[part] = np.einsum("ij,ij->i", a[who[part]], b[row[part]])
    return who, row, found


class Best:
    """The first ``most`` (higher score, then smaller id) of each key, fed in parts."""

    def __init__(self, keys: int, most: int):
        self.keys, self.most = keys, most
        self.key, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, key: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(key):
            return
        key, score, ids = (np.concatenate(x) for x in ((self.key, key), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, key))
        key, score, ids = key[order], score[order], ids[order]
        head = np.searchsorted(key, key, "left")
        stay = np.arange(len(key)) - head < self.most
        self.key, self.score, self.id = key[stay], score[stay], ids[stay]

    def last(self) -> np.ndarray:
        """The score that a further row of a key must reach to change its result."""
        out = np.full(self.keys, _NONE, np.int64)
        full = np.bincount(self.key, minlength=self.keys) >= self.most
        np.minimum.at(worst := np.full(self.keys, np.iinfo(np.int64).max), self.key, self.score)
        out[full] = worst[full]
        return out


def _directions(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.linalg.norm(vectors.astype(np.float64), axis=1)
    return vectors / np.where(lengths > 0, lengths, 1)[:, None], lengths


def _buckets(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> Iterator[Bucket]:
    """The rows of a task, longest first, a bucket at a time."""
    order = np.lexsort((ids, -(vectors.astype(np.float64) ** 2).sum(axis=1)))
    for start in range(0, len(order), BUCKET_ROWS):
        part = order[start:start + BUCKET_ROWS]
        yield Bucket(ids[part], labels[part], vectors[part])


def best_of_label(anchors: dict[str, np.ndarray], rows: dict[str, np.ndarray], most: int) -> Best:
    """Per anchor the first ``most`` other rows of its label among ``rows``."""
    best = Best(len(anchors["id"]), most)
    turned, lengths = _directions(anchors["x"])
    for bucket in _buckets(rows["id"], rows["label"], rows["x"]):
        least = best.last().astype(np.float64)
        least[best.last() == _NONE] = -np.inf
        for label in np.intersect1d(anchors["label"], bucket.labels):
            mine, theirs = np.flatnonzero(anchors["label"] == label), np.flatnonzero(bucket.labels == label)
            part = Bucket(bucket.ids[theirs], bucket.labels[theirs], bucket.vectors[theirs]) if len(theirs) < len(bucket.ids) else bucket
            who, row, score = scores_of(anchors["x"][mine], part, part.candidates(turned[mine], lengths[mine], least[mine]))
            keep = (score >= least[mine][who]) & (part.ids[row] != anchors["id"][mine][who])
            best.add(mine[who[keep]], score[keep], part.ids[row[keep]])
    return best


def best_between(anchors: dict[str, np.ndarray], rows: dict[str, np.ndarray], tops: np.ndarray, most: int, percent: int) -> Best:
    """Per anchor and positive the first ``most`` rows of other labels with a score from ``percent`` of the positive's to its own.

    ``tops`` has the positives' scores, a column each; none stands for a range that nothing is in. Keys of the result are
    ``anchor * columns + column``.
    """
    count, wide = tops.shape
    best = Best(count * wide, most)
    turned, lengths = _directions(anchors["x"])
    # In whole numbers: 100 * score >= percent * top.
    floors = np.where(tops >= 0, -(-(percent * tops) // 100), np.iinfo(np.int64).max)
    for bucket in _buckets(rows["id"], rows["label"], rows["x"]):
        need = np.maximum(floors, best.last().reshape(count, wide)).min(axis=1)
        hopeful = np.flatnonzero(need < np.iinfo(np.int64).max)
        if not len(hopeful):
            break
        pairs = bucket.candidates(turned[hopeful], lengths[hopeful], need[hopeful].astype(np.float64))
        who, row, score = scores_of(anchors["x"][hopeful], bucket, pairs)
        who = hopeful[who]
        keep = (score >= need[who]) & (bucket.labels[row] != anchors["label"][who])
        who, row, score = who[keep], row[keep], score[keep]
        for column in range(wide):
            inside = (score >= floors[who, column]) & (score <= tops[who, column])
            best.add(who[inside] * wide + column, score[inside], bucket.ids[row[inside]])
    return best


def prepared(vectors: DataFrame, scale: int = SCALE, relabel: Column | None = None) -> DataFrame:
    """``id``, ``label`` and ``x``, the whole numbers of the rows that take part (see ``hard_negatives``)."""
    parts = F.transform("embedding", lambda v: F.floor(F.lit(float(scale)) * v.cast("double")))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    label = F.col("label").cast("bigint")
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), label.alias("label"), "embedding") \
        .filter("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").filter(finite)
    square = F.aggregate("x", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    return rows.select(F.col("vec_id").alias("id"), (F.col("label") if relabel is None else relabel).alias("label"), parts.alias("x")) \
        .withColumn("square", square).filter(F.col("square") < F.lit(_MOST_SQUARE))


def shifted_label() -> Column:
    """Every seventh row's label is moved on by one, so that some neighbours are negatives."""
    return F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))


def hard_negatives(vectors: DataFrame, is_anchor: Column | None = None, relabel: Column | None = None, scale: int = SCALE,
                   positives: int = POSITIVES, negatives: int = NEGATIVES, low_percent: int = LOW_PERCENT,
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    A component becomes ``floor(scale * x)``, a score is the integer inner product with the anchor, higher first, ties by smaller
    id. An anchor's positives are its first rows of the same label. For each, the first rows of other labels whose score lies
    from ``low_percent`` of the positive's to the positive's come as negatives; a positive without any has no row, nor has a
    negative positive score (the range is empty).

    Rows take no part if id, label, vector or a component is null, a component is not finite, or the squared length of the whole
    numbers reaches 2**55, beyond which a hundredfold score need not fit a bigint. Only vectors of the same number of components are scored
    with one another. Repeated rows are rows of their own among positives and negatives, but no row of the anchor's own id is
    ever one; equal anchors count once, and different anchors of one id are mined separately under it. Other columns are
    ignored; no rows give no rows. ``is_anchor`` and ``relabel`` are expressions over ``id`` and over ``vec_id`` and ``label``.

    The driver sees a row of statistics for each number of components and each length bucket (a step of 10 %).
    """
    spark = vectors.sparkSession
    chosen = F.col("id") % ANCHOR_EVERY == 0 if is_anchor is None else is_anchor
    length = F.when(F.col("square") > 0, F.floor(F.log(F.sqrt("square")) / math.log(LENGTH_STEP))).otherwise(F.lit(-1)).cast("int")
    rows = checkpointed(prepared(vectors, scale, shifted_label() if relabel is None else relabel).select(
        "id", "label", "x", F.size("x").alias("wide"), length.alias("bucket"), chosen.alias("anchor")))
    peak = F.array_max(F.transform("x", lambda v: F.abs(v)))
    stats = rows.groupBy("wide", "bucket").agg(
        F.count("*").alias("n"), F.count_if("anchor").alias("anchors"), F.max(peak).alias("peak")).collect()
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if not any(s["anchors"] for s in stats):
        return spark.createDataFrame([], schema)
    # 16-bit numbers where they do; blocks of bounded bytes, and enough of them for the cluster's cores.
    small = max((s["peak"] or 0) for s in stats) < 1 << 15
    cores = spark.sparkContext.defaultParallelism
    parts, blocks = {}, {}
    for s in stats:
        most = max(1, block_bytes // (8 * max(1, s["wide"])))
        parts[s["wide"], s["bucket"]] = max(-(-s["n"] // most), min(2 * cores, -(-s["n"] // BUCKET_ROWS)))
        blocks[s["wide"]] = blocks.get(s["wide"], 0) + s["anchors"]
    blocks = {w: max(1, -(-n * 8 * max(1, w) // block_bytes)) for w, n in blocks.items()}
    layout = spark.createDataFrame([(w, b, n, blocks[w]) for (w, b), n in sorted(parts.items())],
                                   "wide int, bucket int, parts int, blocks int")
    rows = rows.withColumn("x", F.col("x").cast("array<smallint>" if small else "array<bigint>"))
    spread = rows.join(F.broadcast(layout), ["wide", "bucket"])
    part = F.pmod(F.xxhash64("id", "x"), F.col("parts")).cast("int")
    dealt = spread.select("wide", "bucket", part.alias("part"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
                          "id", "label", "x")
    # Anchors by number, so that two of one id stay apart.
    anchors = checkpointed(rows.filter("anchor").select("id", "label", "x", "wide").distinct()
                           .withColumn("key", F.monotonically_increasing_id()))
    block_of = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")

    def meet(found: DataFrame, task, returned: str) -> DataFrame:
        """Every block of anchors with every part of every length bucket."""
        sent = found.join(F.broadcast(layout), "wide").withColumn("block", block_of) \
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        sent = sent.toDF(*sent.columns)  # columns of their own, though both sides come from the same rows
        keys = ["wide", "bucket", "part", "block"]
        return dealt.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInArrow(task, returned)

    def first_positives(table: pa.Table, asked: pa.Table) -> pa.Table:
        best = best_of_label(_side(asked), _side(table), positives) if table.num_rows and asked.num_rows else Best(0, positives)
        key = asked.column("key").to_numpy()
        return pa.table({"key": pa.array(key[best.key], pa.int64()), "other": best.id, "score": best.score})

    def first_negatives(table: pa.Table, asked: pa.Table) -> pa.Table:
        if not (table.num_rows and asked.num_rows):
            return pa.table({c: pa.array([], t) for c, t in (("key", pa.int64()), ("nth", pa.int32()), ("other", pa.int64()), ("score", pa.int64()))})
        tops = np.full((asked.num_rows, positives), -1, np.int64)
        given = asked.column("tops").combine_chunks()
        size = np.diff(given.offsets.to_numpy())
        at = np.repeat(np.arange(len(size)), size)
        tops[at, np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size)] = given.flatten().to_numpy()
        best = best_between(_side(asked), _side(table), tops, negatives, low_percent)
        key = asked.column("key").to_numpy()
        return pa.table({"key": pa.array(key[best.key // positives], pa.int64()), "nth": pa.array(best.key % positives + 1, pa.int32()),
                         "other": best.id, "score": best.score})

    order = (F.desc("score"), F.asc("other"))
    found = meet(anchors.select("key", "id", "label", "x", "wide"), first_positives, "key bigint, other bigint, score bigint")
    ranked = found.withColumn("nth", F.row_number().over(Window.partitionBy("key").orderBy(*order)))
    tops = checkpointed(ranked.filter(F.col("nth") <= positives))
    floors = tops.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("nth", "score"))), lambda t: t["score"]).alias("tops"))
    asked = anchors.join(floors, "key").select("key", "id", "label", "x", "wide", "tops")
    pairs = meet(asked, first_negatives, "key bigint, nth int, other bigint, score bigint")
    pairs = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("key", "nth").orderBy(*order))).filter(F.col("rank") <= negatives)
    return pairs.join(tops.select("key", "nth", F.col("other").alias("positive_id"), F.col("score").alias("positive_score")), ["key", "nth"]) \
        .join(anchors.select("key", F.col("id").alias("anchor_id")), "key") \
        .select("anchor_id", "positive_id", "rank", F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def _side(table: pa.Table) -> dict[str, np.ndarray]:
    vectors = table.column("x").combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return {"id": table.column("id").to_numpy(), "label": table.column("label").to_numpy(),
            "x": flat.reshape(table.num_rows, len(flat) // max(1, table.num_rows))}
