"""Near-duplicate vectors by PCA-ordered tiled comparison.

Vectors are turned into the axes of a principal component analysis, strongest first. Tiles are boxes along those axes;
only tiles that can hold vectors near enough meet, and a vector goes only to tiles within its reach. Two tiles are compared by
the products of their leading components; what the rest can add is bounded by the product of the norms of the remaining
components, and pairs that cannot reach the threshold stop there.

Equal vectors are one class. A task returns link counts and one edge per linked class, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formspark.llm.graph import components
from formspark.llm.shared import checkpointed

THRESHOLD = 0.95
SAMPLE_ROWS = 20_000
TILE_ROWS = 4096
_SLACK = 1e-6


class Tiling:
    """The axes, and the boxes cut at medians of a sample along the axis of the widest spread."""

    def __init__(self, sample: np.ndarray, total: int, threshold: float = THRESHOLD, tile_rows: int = TILE_ROWS):
        unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
        _values, axes = np.linalg.eigh(unit.T @ unit / len(unit))
        self.axes = np.ascontiguousarray(axes[:, ::-1])
        self.reach = 2 * (1 - threshold) + _SLACK
        self.cuts: list[tuple[int, float, int, int]] = []
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        self.parts: list[int] = []
        wide = min(16, sample.shape[1])
        edge = np.full(wide, np.inf)
        self.root = self._cut((unit @ self.axes)[:, :wide], total / len(unit), tile_rows, -edge, edge)
        self.first = np.concatenate([[0], np.cumsum(self.parts)])

    def _cut(self, rows: np.ndarray, weight: float, most: int, low: np.ndarray, high: np.ndarray) -> int:
        """A box's number as ~leaf, or the number of a cut."""
        spread = rows.std(axis=0) if len(rows) else np.zeros(1)
        axis = int(spread.argmax())
        at = float(np.median(rows[:, axis])) if len(rows) else 0.0
        left = rows[:, axis] < at
        if len(rows) * weight <= most or len(rows) < 16 or not left.any() or left.all():
            self.low.append(low)
            self.high.append(high)
            self.parts.append(max(1, -(-int(len(rows) * weight) // most)))
            return ~(len(self.parts) - 1)
        here = len(self.cuts)
        self.cuts.append((axis, at, 0, 0))
        below, above = high.copy(), low.copy()
        below[axis] = above[axis] = at
        self.cuts[here] = (axis, at, self._cut(rows[left], weight, most, low, below), self._cut(rows[~left], weight, most, above, high))
        return here

    def leaf(self, turned: np.ndarray) -> np.ndarray:
        out = np.zeros(len(turned), dtype=np.int64)
        todo = [(self.root, np.arange(len(turned)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out[rows] = ~node
            else:
                axis, at, left, right = self.cuts[node]
                side = turned[rows, axis] < at
                todo += [(left, rows[side]), (right, rows[~side])]
        return out

    def tile(self, turned: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The tile of each row: its box, and by its id the part of a box that holds more rows than a tile."""
        home = self.leaf(turned)
        spread = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
        return self.first[home] + spread % np.array(self.parts)[home]

    def units(self, turned: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, lower tile, upper tile) for every pair of tiles in which a row has to appear."""
        tile, first = self.tile(turned, ids), self.first
        rows, lower, upper = [], [], []
        for leaf in range(len(self.parts)):
            side = turned[:, :len(self.low[leaf])]
            off = np.maximum(0, np.maximum(self.low[leaf] - side, side - self.high[leaf]))
            near = np.flatnonzero((off * off).sum(axis=1) <= self.reach)
            for other in range(first[leaf], first[leaf + 1]):
                rows.append(near)
                lower.append(np.minimum(tile[near], other))
                upper.append(np.maximum(tile[near], other))
        return np.concatenate(rows), np.concatenate(lower), np.concatenate(upper)


def _merge(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the trees of a and b, smaller index on top."""
    while len(a):
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up
        a, b = parent[a], parent[b]
        differ = a != b
        a, b = np.minimum(a, b)[differ], np.maximum(a, b)[differ]
        np.minimum.at(parent, b, a)


def linked(left: np.ndarray, right: np.ndarray, axes: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of ``left``, rows of ``right``) with cosine at or above ``threshold``, a stretch of ``left`` at a time."""
    a, b = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (left, right))
    ta, tb = a @ axes, b @ axes
    width = axes.shape[1]
    leads = sorted({max(1, width // 4), max(1, width // 2)})
    rest = {k: (np.linalg.norm(ta[:, k:], axis=1), np.linalg.norm(tb[:, k:], axis=1)) for k in leads}
    k = leads[0]
    # Leading components and the norm of the rest: the product is the highest cosine still possible.
    bound_a = np.column_stack([ta[:, :k], rest[k][0]]).astype(np.float32)
    bound_b = np.ascontiguousarray(np.column_stack([tb[:, :k], rest[k][1]]).astype(np.float32).T)
    for start in range(0, len(a), 256):
        maybe = bound_a[start:start + 256] @ bound_b >= np.float32(threshold - 1e-5)
        if maybe.mean() > 0.05:
            i, j = np.nonzero(a[start:start + 256] @ b.T >= threshold)
            yield i + start, j
            continue
        i, j = np.nonzero(maybe)
        i = i + start
        for more in leads[1:]:
            best = np.einsum("ij,ij->i", ta[i, :more], tb[j, :more]) + rest[more][0][i] * rest[more][1][j]
            i, j = i[best >= threshold - _SLACK], j[best >= threshold - _SLACK]
        exact = np.einsum("ij,ij->i", a[i], b[j]) >= threshold
        yield i[exact], j[exact]


def _usable(column: str):
    """Not null, not empty, every component finite, not all zero."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(column, lambda x: x != 0), F.lit(False))


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, sample_rows: int = SAMPLE_ROWS,
                 tile_rows: int = TILE_ROWS) -> DataFrame:
    """Per row ``vec_id``, ``n_links``, ``component_id`` and ``kept``.

    Links are pairs of rows whose cosine in double precision is at least ``threshold``; equal vectors are linked. Vectors
    that are null, empty or zero, or hold null or non-finite components, link with nothing, and vectors of different length
    never link. ``component_id`` is the smallest id reachable. Repeated rows are vectors of their own. Other columns are
    ignored; no rows give no rows. The axes and boxes come from at most ``sample_rows`` vectors; they decide where vectors
    meet, not which are linked. A vector without an id links with nothing.
    """
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding",
                          F.when(F.col("vec_id").isNotNull() & _usable("embedding"), F.col("embedding")).alias("x"))
    classes = checkpointed(rows.filter("x IS NOT NULL").groupBy("x").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")))
    found = None
    for r in classes.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy("d").collect():
        part = _one_width(classes.filter(F.size("x") == r["d"]), r["n"], threshold, sample_rows, tile_rows)
        found = part if found is None else found.unionByName(part)
    if found is None:
        links = classes.select("x", (F.col("n") - 1).alias("n_links"), F.col("rep").alias("root"))
    else:
        found = checkpointed(found)
        roots = components(found.filter("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")))
        counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
        links = classes.join(counts, "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left").select(
            "x", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "rep").alias("root"))
    out = rows.select("vec_id", "x").join(links, "x", "left").withColumn("component_id", F.coalesce("root", "vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), "component_id",
                      F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _one_width(classes: DataFrame, total: int, threshold: float, sample_rows: int, tile_rows: int) -> DataFrame:
    """``rep``, ``links`` (rows in other classes it is linked with) and ``root`` (a class it is connected with)."""
    spark = classes.sparkSession
    sample = classes.orderBy(F.xxhash64("rep"), "rep").limit(sample_rows).select("x").collect()
    tiling = spark.sparkContext.broadcast(Tiling(np.array([r["x"] for r in sample], dtype=np.float64), total, threshold, tile_rows))
    kind = "<f4" if classes.schema["x"].dataType.elementType.simpleString() == "float" else "<f8"

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = tiling.value
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
            x = np.ascontiguousarray(flat.astype(kind).reshape(batch.num_rows, -1))
            unit = x.astype(np.float64)
            unit /= np.linalg.norm(unit, axis=1, keepdims=True)
            ids = batch.column("rep").fill_null(0).to_numpy(zero_copy_only=False)
            turned = unit @ plan.axes[:, :len(plan.low[0])]
            row, lower, upper = plan.units(turned, ids)
            tile = plan.tile(turned, ids)
            packed = pa.array([v.tobytes() for v in x], pa.binary())
            at = pa.array(row)
            for part in range(0, len(row), 20_000):
                take = at.slice(part, 20_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lower[part:part + 20_000]), pa.array(upper[part:part + 20_000]), batch.column("rep").take(take),
                     batch.column("n").take(take), pa.array(tile[row[part:part + 20_000]]), packed.take(take)],
                    names=["lower", "upper", "rep", "n", "tile", "x"])

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        lower = table.column("lower")[0].as_py()
        tile, rep, n = (table.column(c).to_numpy() for c in ("tile", "rep", "n"))
        order = np.lexsort((rep, tile != lower))
        x = np.frombuffer(b"".join(table.column("x").to_pylist()), kind).reshape(len(tile), -1).astype(np.float64)[order]
        tile, rep, n = tile[order], rep[order], n[order]
        mine = int((tile == lower).sum())
        one = table.column("upper")[0].as_py() == lower
        a, b = (slice(0, mine), slice(0, mine)) if one else (slice(0, mine), slice(mine, len(tile)))
        links, parent = np.zeros(len(tile), dtype=np.int64), np.arange(len(tile))
        if len(x[a]) and len(x[b]):
            for i, j in linked(x[a], x[b], tiling.value.axes, threshold):
                j = j + b.start
                keep = i != j
                i, j = i[keep], j[keep]
                np.add.at(links, i, n[j])
                if not one:
                    np.add.at(links, j, n[i])
                _merge(parent, i, j)
        _merge(parent, np.arange(len(parent)), parent.copy())
        least = np.full(len(tile), np.iinfo(np.int64).max)
        np.minimum.at(least, parent, rep)
        hit = links > 0
        return pa.table({"rep": pa.array(rep[hit]), "links": pa.array(links[hit]), "root": pa.array(least[parent][hit])})

    dealt = classes.mapInArrow(deal, "lower bigint, upper bigint, rep bigint, n bigint, tile bigint, x binary")
    return dealt.groupBy("lower", "upper").applyInArrow(compare, "rep bigint, links bigint, root bigint")
