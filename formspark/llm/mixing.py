"""Mixing sources to target weights by Pfair scheduling.

Each source is cut into blocks of equal length. With target weight w of a total T, block j of a source is released at slot
floor(j T / w) and due by slot ceil((j + 1) T / w); the earliest deadline goes first. The order is proportionally fair: at
no slot does a source stand a whole block away from its share. Weights are the exact fractions of the targets, so the
share is the target's own. The order repeats every T slots; where T is long, only the slots until the first source runs out
are worked out, one step a block on the driver, and a block's slot is looked up by its number. Blocks grow with the table once
it holds more than ``MOST_BLOCKS`` of the shortest, so the driver's steps and the broadcast stay within that many and one
a source, about two seconds and 8 MB a million, whatever the number of rows.

When a source runs out, the others go on from there with the weights they have, as a new phase. Every row gets exactly
one place.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 64
MOST_BLOCKS = 1_000_000
PERIOD = 1000
BUCKET_ROWS = 5_000
SEED = 20


def exact_weights(targets: dict) -> dict:
    """The least whole weights in exactly the ratios of the targets."""
    exact = {s: Fraction(w) for s, w in targets.items()}
    scale = math.lcm(*(w.denominator for w in exact.values()))
    whole = {s: int(w * scale) for s, w in exact.items()}
    common = math.gcd(*whole.values())
    return {s: w // common for s, w in whole.items()}


def integer_weights(targets: dict, period: int = PERIOD) -> dict:
    """Whole weights that sum to ``period`` (or to four slots a source, if that is more), none below one."""
    period = max(period, 4 * len(targets))
    total = sum(targets.values())
    exact = {s: targets[s] / total * period for s in targets}
    whole = {s: max(1, int(x)) for s, x in exact.items()}
    order = sorted(targets, key=lambda s: (whole[s] - exact[s], str(s)))
    k = 0
    while sum(whole.values()) != period:
        gap = period - sum(whole.values())
        s = order[k % len(order)] if gap > 0 else order[-1 - k % len(order)]
        whole[s] += 1 if gap > 0 else -1 if whole[s] > 1 else 0
        k += 1
    return whole


def one_period(weights: dict, left: dict) -> tuple[dict, bool]:
    """source -> the slots of its blocks, by earliest deadline first among released blocks, and whether a source ran out.

    Goes on for one period, or until a source has no blocks ``left``.
    """
    total = sum(weights.values())
    order = sorted(weights, key=str)
    waiting = [(0, rank, 0) for rank in range(len(order))]
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int]] = []
    slots: dict = {s: [] for s in order}
    for slot in count():
        if slot == total:
            return slots, False
        while waiting and waiting[0][0] <= slot:
            _release, rank, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * total // weights[order[rank]]), rank, j))
        _deadline, rank, j = heapq.heappop(ready)
        slots[order[rank]].append(slot)
        if j + 1 == left[order[rank]]:
            return slots, True
        if j + 1 < weights[order[rank]]:
            heapq.heappush(waiting, ((j + 1) * total // weights[order[rank]], rank, j + 1))


@dataclass(frozen=True)
class Phase:
    """A stretch of slots in which the same sources are left. ``total`` is 0 where it is shorter than a period."""

    base: int
    total: int
    first: dict
    slots: dict


def phases(blocks: dict, weights: dict) -> list[Phase]:
    """The phases until every source's ``blocks`` are placed."""
    left = {s: n for s, n in blocks.items() if n > 0}
    used = dict.fromkeys(left, 0)
    base, out = 0, []
    while left:
        now = {s: weights[s] for s in left}
        found, ended = one_period(now, left)
        slots = {s: np.array(x, dtype=np.int64) for s, x in found.items() if x}
        total = 0 if ended else sum(now.values())
        out.append(Phase(base, total, {s: used[s] for s in slots}, slots))
        if ended:
            done = {s: len(x) for s, x in found.items()}
            end = sum(done.values())
        else:
            end = min(((n - 1) // now[s]) * total + int(slots[s][(n - 1) % now[s]]) + 1 for s, n in left.items())
            done = {s: (end // total) * now[s] + int(np.searchsorted(slots[s], end % total)) for s in left}
        for s, n in done.items():
            used[s] += n
            left[s] -= n
            if not left[s]:
                del left[s]
        base += end
    return out


class Plan:
    """Turns row numbers within sources into slots and positions."""

    def __init__(self, rows: dict, weights: dict, block_rows: int = BLOCK_ROWS):
        self.block_rows = block_rows
        blocks = {s: -(-n // block_rows) for s, n in rows.items()}
        self.by_source: dict = {s: [] for s in rows}
        for p in phases(blocks, weights):
            for s in p.slots:
                self.by_source[s].append((p.first[s], p.base, p.total, p.slots[s]))
        short = sorted((int(self.slot(s, np.array([blocks[s] - 1]))[0]), block_rows * blocks[s] - n) for s, n in rows.items() if n)
        self.short_at = np.array([at for at, _ in short], dtype=np.int64)
        self.lacking = np.cumsum([0] + [n for _, n in short])

    def slot(self, source, block: np.ndarray) -> np.ndarray:
        out = np.zeros(len(block), dtype=np.int64)
        for first, base, total, slots in self.by_source[source]:
            here = block >= first
            j = block[here] - first
            # Later phases overwrite what lies beyond a phase's end.
            out[here] = base + j // len(slots) * total + slots[j % len(slots)]
        return out

    def position(self, slot: np.ndarray, offset: np.ndarray) -> np.ndarray:
        """Places without holes: the last block of a source may be short."""
        return slot * self.block_rows + offset - self.lacking[np.searchsorted(self.short_at, slot)]


def _key(source: Column):
    """Sources as text; null is a source of its own."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source.cast("string")))


def block_length(rows: int, most: int = MOST_BLOCKS) -> int:
    """The rows of a block for a table of so many rows: the shortest, until that would be more than ``most`` blocks."""
    return max(BLOCK_ROWS, -(-rows // most))


def mixed(docs: DataFrame, targets: dict | None = None, block_rows: int | None = None, period: int | None = None,
          bucket_rows: int = BUCKET_ROWS, seed: int = SEED) -> DataFrame:
    """All rows and columns of ``docs`` plus ``mix_block``, ``mix_slot`` and ``mix_position``.

    ``targets`` gives the weight of each source (null is a source of its own); a source without one gets the least share,
    and the default weights are the square roots of the sources' sizes. Shares are exact unless ``period`` asks for weights
    rounded to a period of so many slots. Blocks have ``block_rows`` rows, ``block_length`` of the table where that is left out.
    Within a source rows go by a hash of id and text, then by id and text; fully equal rows take neighbouring places. ``mix_position`` runs from 0 without holes over all rows.
    Null texts and ids are placed like others; an empty table stays empty. Columns that bear one of the new names are
    replaced; all others are kept, whatever their names.

    Sizes of sources reach the driver, one number each. Rows are numbered inside (source, range of hashes) buckets of
    about ``bucket_rows`` rows, so no group grows with a source; bucket sizes are added up from their counts.
    """
    sizes = {r["k"]: r["n"] for r in docs.groupBy(_key(F.col("source")).alias("k")).agg(F.count("*").alias("n")).collect()}
    wanted = {"n" if s is None else f"s{s}": float(w) for s, w in (targets or {}).items() if w > 0}
    if targets is None:
        wanted = {s: n ** 0.5 for s, n in sizes.items()}
    wanted = {s: wanted.get(s, 1e-12) for s in sizes}
    weights = {} if not wanted else integer_weights(wanted, period) if period else exact_weights(wanted)
    block_rows = block_rows or block_length(sum(sizes.values()))
    plan = docs.sparkSession.sparkContext.broadcast(Plan(sizes, weights, block_rows))
    bits = max(1, int(np.ceil(np.log2(max(2, sum(sizes.values()) / bucket_rows)))))
    names = [c for c in docs.columns if c not in ("mix_block", "mix_slot", "mix_position")]
    # Names of their own, for the documents may have any.
    plain = docs.select(*names).toDF(*[f"c{i}" for i in range(len(names))])
    source, doc_id, text = (F.col(f"c{names.index(n)}") for n in ("source", "doc_id", "text"))
    rows = plain.withColumns({"key": _key(source), "hash": F.xxhash64(F.lit(seed), doc_id, text), "mark": F.xxhash64(text)}) \
        .withColumn("bucket", F.shiftrightunsigned("hash", 64 - bits))
    counts = rows.groupBy("key", "bucket").agg(F.count("*").alias("n"))
    before = counts.select("key", "bucket", F.coalesce(F.sum("n").over(
        Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    numbered = rows.withColumn("row", F.row_number().over(Window.partitionBy("key", "bucket").orderBy("hash", doc_id, "mark")))
    indexed = numbered.join(before, ["key", "bucket"]).withColumn("index", F.col("row") - 1 + F.col("before"))

    @F.pandas_udf("slot bigint, position bigint")
    def place(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for key, index in parts:
            slot = np.zeros(len(index), dtype=np.int64)
            number = index.to_numpy()
            for source, at in key.groupby(key).indices.items():
                slot[at] = plan.value.slot(source, number[at] // plan.value.block_rows)
            yield pd.DataFrame({"slot": slot, "position": plan.value.position(slot, number % plan.value.block_rows)})

    out = indexed.withColumn("place", place("key", "index"))
    return out.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)], F.floor(F.col("index") / block_rows).alias("mix_block"),
                      F.col("place.slot").alias("mix_slot"), F.col("place.position").alias("mix_position"))
