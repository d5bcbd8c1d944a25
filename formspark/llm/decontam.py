"""Benchmark decontamination with suffix arrays over document shards.

Every Arrow batch of documents is a shard. Its words become the numbers that the benchmark's vocabulary gives them, the
positions that can begin a benchmark suffix are sorted by the words that follow (a sparse suffix array), and every suffix
of every benchmark item is looked up in it by binary search. Hits on neighbouring positions of one item join into the
longest verbatim match. Nothing is shuffled: a document meets the whole benchmark where it lies.

The benchmark travels to the tasks in slices of at most ``SLICE_CHARS`` characters on average. One slice is the usual case; a
benchmark of any size becomes a chain of passes over the same rows.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 13
SLICE_CHARS = 6_000_000
SHARD_BYTES = 4_000_000

# A word is a run of digits, letters and bytes beyond ASCII; A-Z count as a-z.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words(raw: bytes | None) -> list[bytes]:
    """The lower-cased words of a UTF-8 text; none for null."""
    return raw.translate(_FOLD).split() if raw else []


class SuffixIndex:
    """The suffixes of a slice of the benchmark, ready to be searched for in shards.

    Each suffix that has a full window is one row: its first ``window`` word numbers, the item, and the word it begins
    at. An item of fewer words is one row of that length.
    """

    def __init__(self, items: list[tuple[int | None, bytes | None]], window: int = WINDOW):
        self.window = window
        self.number: dict[bytes, int] = {}
        rows, lengths, owner, begins = [], [], [], []
        for item, text in items:
            seen = [self.number.setdefault(w, len(self.number) + 1) for w in words(text)]
            size = min(window, len(seen))
            for at in range(len(seen) - size + 1 if size else 0):
                rows.append(seen[at:at + size] + [0] * (window - size))
                lengths.append(size)
                owner.append(item)
                begins.append(at)
        self.owner, self.begins = owner, begins
        self.lengths = np.array(lengths, dtype=np.int64)
        self.least = int(self.lengths.min()) if rows else 0
        grid = np.array(rows, dtype=np.uint32).reshape(-1, window)
        self.low = _packed(grid)
        self.high = _packed(np.where(np.arange(window) < self.lengths[:, None], grid, np.uint32(0xFFFFFFFF)))
        self.sieve = np.zeros(1 << 20, dtype=bool)
        self.sieve[_mixed([grid[:, j] for j in range(self.least)])] = True

    def search(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, row) for every occurrence of a row's words in a shard.

        Documents are parted by a 0, the number of every word outside the benchmark too.
        """
        none = np.zeros(0, dtype=np.int64)
        span = len(numbers) - self.least + 1
        if not self.least or span <= 0:
            return none, none
        maybe = self.sieve[_mixed([numbers[j:j + span] for j in range(self.least)])]
        at = np.flatnonzero(maybe & (numbers[:span] > 0))
        if not len(at):
            return none, none
        padded = np.concatenate([numbers, np.zeros(self.window, dtype=np.uint32)])
        suffixes = _packed(padded[at[:, None] + np.arange(self.window)])
        order = np.argsort(suffixes, kind="stable")
        suffixes = suffixes[order]
        first = np.searchsorted(suffixes, self.low, side="left")
        count = np.searchsorted(suffixes, self.high, side="right") - first
        rows = np.flatnonzero(count)
        count = count[rows]
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return at[order[np.repeat(first[rows], count) + within]], np.repeat(rows, count)


def _packed(grid: np.ndarray) -> np.ndarray:
    """Rows of word numbers as byte strings that compare as the rows do."""
    return np.ascontiguousarray(grid.astype(">u4")).view(f"S{4 * grid.shape[1]}").ravel() if len(grid) else np.zeros(0, dtype="S4")


def _mixed(columns: list[np.ndarray]) -> np.ndarray:
    """A place in the sieve for the leading words of a suffix."""
    total = np.zeros(len(columns[0]) if columns else 0, dtype=np.uint64)
    for column in columns:
        total = (total + column) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
    return (total >> np.uint64(44)).astype(np.int64)


def _shards(texts: list[bytes | None], most: int = SHARD_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``most`` bytes; a longer text is a run of its own."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if i > start and held + len(text or b"") > most:
            yield start, i
            start, held = i, 0
        held += len(text or b"")
    if start < len(texts):
        yield start, len(texts)


def _matches(texts: list[bytes | None], index: SuffixIndex) -> Iterator[tuple[int, int, list]]:
    """Per row: the number of words, and [(first word, words, row of the index)] of every hit."""
    for start, end in _shards(texts):
        parts, sizes = [], []
        for text in texts[start:end]:
            found = words(text)
            parts.append(np.fromiter(map(index.number.get, found, [0] * len(found)), np.uint32, len(found)))
            parts.append(np.zeros(1, dtype=np.uint32))
            sizes.append(len(found))
        begin = np.cumsum([0] + [s + 1 for s in sizes])
        at, rows = index.search(np.concatenate(parts))
        order = np.lexsort((rows, at))
        at, rows = at[order], rows[order]
        cut = np.searchsorted(at, begin)
        for k, size in enumerate(sizes):
            a, z = cut[k], cut[k + 1]
            yield start + k, size, list(zip((at[a:z] - begin[k]).tolist(), index.lengths[rows[a:z]].tolist(), rows[a:z].tolist()))


def benchmark_slices(benchmark: DataFrame, slice_chars: int = SLICE_CHARS) -> list[DataFrame]:
    """The benchmark in parts that each fit a task, by the hash of text and id."""
    total = benchmark.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    parts = max(1, -(-total // slice_chars))
    rows = benchmark.select("item_id", F.col("text").cast("binary").alias("text"))
    if parts == 1:
        return [rows]
    return [rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part) for part in range(parts)]


def _indexes(spark: SparkSession, benchmark: DataFrame, window: int, slice_chars: int) -> list:
    return [
        spark.sparkContext.broadcast((uuid.uuid4().hex, [(r["item_id"], r["text"]) for r in part.toLocalIterator()]))
        for part in benchmark_slices(benchmark, slice_chars)
    ]


def _index_of(shipped, window: int) -> SuffixIndex:
    """The index of a slice, built once in each worker process and known by the name that travels with the slice."""
    name, rows = shipped.value
    key = (name, window)
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = SuffixIndex([(i, bytes(t) if t is not None else None) for i, t in rows], window)
    return _BUILT[key]


_BUILT: dict = {}


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slice_chars: int = SLICE_CHARS,
         text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` plus ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``.

    A word is hit when it lies in any occurrence of ``window`` consecutive words of an item (of all its words where it
    has fewer). A document is contaminated when at least one in twenty of its words is hit. Null and empty texts have no
    words and are clean; an empty benchmark hits nothing; items of equal id count once, with the windows of all their
    rows; an item without an id hits words but is not listed. Repeated documents each get their row. Columns of ``docs``
    that bear one of the new names are replaced.
    """
    spark = docs.sparkSession
    shipped = _indexes(spark, benchmark, window, slice_chars)
    added = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    kept = docs.drop(*added, "__hit", "__items")
    frame = kept.withColumns({"__hit": F.lit(None).cast("binary"), "__items": F.array().cast("array<string>")}) \
        .withColumn("n_words", F.lit(0).cast("bigint"))
    for part in shipped:
        frame = frame.mapInArrow(_marker(part, window, text), frame.schema)
    schema = T.StructType([*kept.schema.fields, *T.StructType.fromDDL(
        "n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean").fields])
    return frame.mapInArrow(_summary, schema)


def _marker(shipped, window: int, text: str):
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index_of(shipped, window)
        for batch in batches:
            texts = batch.column(text).cast(pa.binary()).to_pylist()
            bits, items, sizes = batch.column("__hit").to_pylist(), batch.column("__items").to_pylist(), []
            for row, size, found in _matches(texts, index):
                sizes.append(size)
                if found:
                    hit = np.zeros(size, dtype=bool)
                    if bits[row]:
                        hit |= np.unpackbits(np.frombuffer(bits[row], np.uint8), count=size).astype(bool)
                    for at, length, _row in found:
                        hit[at:at + length] = True
                    bits[row] = np.packbits(hit).tobytes()
                    named = {str(index.owner[r]) for _at, _n, r in found if index.owner[r] is not None}
                    items[row] = sorted(named | set(items[row]))
            yield _with(batch, {"__hit": pa.array(bits, pa.binary()), "__items": pa.array(items, pa.list_(pa.string())),
                                "n_words": pa.array(sizes, pa.int64())})

    return mark


def _summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = batch.column("n_words").to_pylist()
        hit = [int(np.unpackbits(np.frombuffer(b, np.uint8)).sum()) if b else 0 for b in batch.column("__hit").to_pylist()]
        items = batch.column("__items").to_pylist()
        out = {name: batch.column(name) for name in batch.schema.names if name not in ("__hit", "__items", "n_words")}
        out["n_words"] = pa.array(sizes, pa.int64())
        out["n_hit"] = pa.array(hit, pa.int64())
        out["n_items"] = pa.array([len(i) for i in items], pa.int64())
        out["items_sha256"] = pa.array([hashlib.sha256(",".join(i).encode()).hexdigest() for i in items])
        out["contaminated"] = pa.array([h > 0 and 20 * h >= n for h, n in zip(hit, sizes)])
        yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))


def _with(batch: pa.RecordBatch, new: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([new.get(n, batch.column(n)) for n in batch.schema.names], names=batch.schema.names)


def longest_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                    slice_chars: int = SLICE_CHARS) -> DataFrame:
    """The longest verbatim matches and where they lie.

    One row per document row, item and maximal run of shared words: ``doc_id``, ``item_id``, ``doc_word`` and ``item_word``
    (first word, from 0) and ``n_words``. Matches shorter than a window are not reported. Empty input gives no rows.
    """
    out = "doc_id bigint, item_id bigint, doc_word bigint, item_word bigint, n_words bigint"
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary").alias("text"))
    frames = [rows.mapInArrow(_finder(part, window), out) for part in _indexes(docs.sparkSession, benchmark, window, slice_chars)]
    found = frames[0]
    for frame in frames[1:]:
        found = found.unionByName(frame)
    return found


def _finder(shipped, window: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index_of(shipped, window)
        for batch in batches:
            ids, out = batch.column("doc_id").to_pylist(), [[], [], [], [], []]
            for row, _size, found in _matches(batch.column("text").to_pylist(), index):
                lines = sorted((index.owner[r] is None, index.owner[r] or 0, at - index.begins[r], at, n) for at, n, r in found)
                for (_none, _item, shift), run in groupby(lines, key=lambda x: x[:3]):
                    owner, first, last = None if _none else _item, None, None
                    for *_same, at, n in [*run, (0, 0, 0, None, 0)]:
                        if first is not None and (at is None or at > last):
                            for column, value in zip(out, (ids[row], owner, first, first - shift, last - first)):
                                column.append(value)
                            first = None
                        if at is not None:
                            first, last = (at if first is None else first), max(at + n, last or 0)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out],
                                             names=["doc_id", "item_id", "doc_word", "item_word", "n_words"])

    return find


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slice_chars: int = SLICE_CHARS) -> DataFrame:
    """``docs`` without its contaminated rows; columns as they were, whatever their names."""
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    judged = hits(plain, benchmark, window, slice_chars, text=f"c{docs.columns.index('text')}")
    return judged.filter(~F.col("contaminated")).select(*plain.columns).toDF(*docs.columns)
