"""Line deduplication over the whole corpus.

Long line keys are hashed to 128 bits and range-partitioned by (hash, document), so that a line which a third of all
documents hold is spread over many partitions by itself. Each partition is sorted by hash, document and position and
streamed once. A run of one hash that crosses a partition's edge is settled by a summary of two runs per partition. What
comes back per document is a compressed bitmap of the lines it keeps; texts meet the bitmaps at the end.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formspark.llm.shared import checkpointed, hashed_if_small

LEAST_CHARS = 20
LEAST_DOCS = 3
BLANK = b" \t\n\x0b\x0c\r"
_NONE = -(1 << 63)


def line_key(line: bytes) -> bytes:
    """The line without white space at its ends, A-Z lower-cased."""
    return line.strip(BLANK).lower()


def _long(key: bytes, least: int) -> bool:
    return len(key) >= least and (len(key) >= 4 * least or sum(b & 0xC0 != 0x80 for b in key) >= least)


def line_hashes(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``hi``, ``lo`` (hash of the key), ``doc_id`` and ``mark`` (which text), ``pos`` for every line with a long key."""
    out = "hi bigint, lo bigint, doc_id bigint, mark bigint, pos int"

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, owners, positions = [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                for pos, line in enumerate((text or b"").split(b"\n")):
                    key = line_key(line)
                    if _long(key, least_chars):
                        digests.append(xxhash.xxh3_128_digest(key))
                        owners.append(row)
                        positions.append(pos)
            owners = pa.array(owners, pa.int32())
            pairs = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), batch.column("doc_id").take(owners),
                 batch.column("mark").take(owners), pa.array(positions, pa.int32())],
                names=["hi", "lo", "doc_id", "mark", "pos"])

    return docs.select(_id(), _mark(), F.col("text").cast("binary").alias("text")).mapInArrow(emit, out)


def _id():
    return F.col("doc_id").cast("bigint").alias("doc_id")


def _mark():
    """Tells apart the texts of rows that share an id."""
    return F.xxhash64("text").alias("mark")


def _runs(columns: dict[str, np.ndarray]) -> np.ndarray:
    """Where a new hash begins."""
    hi, lo = columns["hi"], columns["lo"]
    return np.flatnonzero(np.r_[True, (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])]) if len(hi) else np.zeros(0, dtype=np.int64)


def _numbers(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    """A batch as arrays; a null document is the smallest number."""
    return {n: (batch.column(n).fill_null(_NONE) if n == "doc_id" else batch.column(n)).to_numpy(zero_copy_only=False)
            for n in batch.schema.names}


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and the last run of the partition: documents in it, and its first and last document.

    Documents ascend inside a run, so a running count needs only the document before.
    """
    first = current = None
    for batch in batches:
        c = _numbers(batch)
        starts = _runs(c)
        for a, z in zip(starts.tolist(), [*starts[1:].tolist(), len(c["hi"])]):
            key, ids = (int(c["hi"][a]), int(c["lo"][a])), c["doc_id"][a:z]
            fresh = int((ids[1:] != ids[:-1]).sum()) + 1
            if current and current[0] == key:
                current[1] += fresh - (current[3] == int(ids[0]))
                current[3] = int(ids[-1])
            else:
                first = first or (current and list(current))
                current = [key, fresh, int(ids[0]), int(ids[-1])]
    if current:
        rows = [first or current] + ([current] if first else [])
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], pa.int64()) if not isinstance(v, list) else pa.array(v, pa.int64()) for v in (
                [part] * len(rows), [r[0][0] for r in rows], [r[0][1] for r in rows], [r[1] for r in rows],
                [r[2] for r in rows], [r[3] for r in rows])],
            names=["part", "hi", "lo", "n", "low", "top"])


def _carries(edges: list) -> dict[int, dict]:
    """part -> {hash: (documents in all partitions, largest document)} for runs that cross an edge."""
    whole: dict = {}
    for e in sorted(edges, key=lambda e: (e["hi"], e["lo"], e["part"])):
        key = (e["hi"], e["lo"])
        n, top, parts = whole.get(key, (0, None, []))
        whole[key] = (n + e["n"] - (top == e["low"]), e["top"], [*parts, e["part"]])
    out: dict = {}
    for key, (n, top, parts) in whole.items():
        if len(parts) > 1:
            for part in parts:
                out.setdefault(part, {})[key] = (n, top)
    return out


def dropped_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``doc_id``, ``mark``, ``pos`` of every line that goes.

    Cuts its lineage with a checkpoint: the two streams over the sorted ranges must see the same partitions.
    """
    spark = docs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    ranged = line_hashes(docs, least_chars).repartitionByRange(parts, "hi", "lo", "doc_id") \
        .sortWithinPartitions("hi", "lo", "doc_id", "pos")
    ranged = checkpointed(ranged)
    edges = ranged.mapInArrow(_edges, "part bigint, hi bigint, lo bigint, n bigint, low bigint, top bigint").collect()
    carried = spark.sparkContext.broadcast(_carries(edges))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = carried.value.get(TaskContext.get().partitionId(), {})
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held).combine_chunks()
            whole = table.to_batches()[0] if table.num_rows else batch
            last = _runs(_numbers(whole))[-1] if whole.num_rows else 0
            key = tuple(whole.slice(last, 1).select(["hi", "lo"]).to_pylist()[0].values()) if whole.num_rows else None
            if key in known:
                yield from _settled(whole, known, least_docs)
                held = []
            else:
                yield from _settled(whole.slice(0, last), known, least_docs)
                held = [whole.slice(last)]
        if held:
            table = pa.Table.from_batches(held).combine_chunks()
            for whole in table.to_batches():
                yield from _settled(whole, known, least_docs)

    return ranged.mapInArrow(stream, "doc_id bigint, mark bigint, pos int")


def _settled(batch: pa.RecordBatch, known: dict, least_docs: int) -> Iterator[pa.RecordBatch]:
    """The lines that go, of whole runs or of runs whose totals are known."""
    if not batch.num_rows:
        return
    c = _numbers(batch)
    starts = _runs(c)
    ends = np.r_[starts[1:], len(c["hi"])]
    fresh = np.r_[True, c["doc_id"][1:] != c["doc_id"][:-1]]
    fresh[starts] = True
    n = np.add.reduceat(fresh.astype(np.int64), starts)
    top = c["doc_id"][ends - 1].copy()
    for i in (0, len(starts) - 1):
        total = known.get((int(c["hi"][starts[i]]), int(c["lo"][starts[i]])))
        if total:
            n[i], top[i] = total
    size = ends - starts
    goes = np.flatnonzero((np.repeat(n, size) >= least_docs) & (c["doc_id"] != np.repeat(top, size)))
    yield batch.take(pa.array(goes)).select(["doc_id", "mark", "pos"])


def keep_bitmaps(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``doc_id``, ``mark``, ``drops`` for documents that lose lines.

    ``drops`` is the zlib-compressed bitmap of lines that go (bit i is line i, most significant first); every line beyond
    its end stays, and a document without a row keeps all lines.
    """
    gone = dropped_lines(docs, least_chars, least_docs).groupBy("doc_id", "mark").agg(F.collect_set("pos").alias("lines"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps = []
            for lines in batch.column("lines").to_pylist():
                bits = np.zeros(max(lines) + 1, dtype=bool)
                bits[lines] = True
                maps.append(zlib.compress(np.packbits(bits).tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("mark"), pa.array(maps, pa.binary())],
                                             names=["doc_id", "mark", "drops"])

    return gone.mapInArrow(pack, "doc_id bigint, mark bigint, drops binary")


def _split(text: bytes | None, drops: bytes | None) -> tuple[list[bytes], np.ndarray]:
    lines = (text or b"").split(b"\n")
    goes = np.zeros(len(lines), dtype=bool)
    if drops:
        bits = np.unpackbits(np.frombuffer(zlib.decompress(drops), np.uint8))[:len(lines)]
        goes[:len(bits)] = bits.astype(bool)
    return lines, goes


def _kept(text: bytes | None, drops: bytes | None) -> tuple[int, int, bytes]:
    if not drops:
        return (text or b"").count(b"\n") + 1, 0, text or b""
    lines, goes = _split(text, drops)
    return len(lines), int(goes.sum()), b"\n".join(line for line, out in zip(lines, goes.tolist()) if not out)


def _with_bitmaps(docs: DataFrame, least_chars: int, least_docs: int) -> DataFrame:
    """The rows of ``docs`` with their columns as ``c0``, ``c1`` and so on, whatever their names, and ``drops``."""
    maps = checkpointed(keep_bitmaps(docs, least_chars, least_docs).toDF("id", "mark", "drops"))
    maps = hashed_if_small(maps, F.length("drops") + 32)
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    doc_id, text = (plain[f"c{docs.columns.index(n)}"] for n in ("doc_id", "text"))
    return plain.join(maps, doc_id.cast("bigint").eqNullSafe(F.col("id")) & (F.xxhash64(text) == F.col("mark")), "left") \
        .drop("id", "mark")


def line_report(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """Per document row ``doc_id``, ``n_lines``, ``n_dropped`` and ``kept_sha256``, the digest of the lines that stay.

    A null or empty text is one empty line. A line that stands several times in one document counts one document. Rows
    that share an id are one document for the counts; each gets its row. A null id counts as one document, smaller than
    any other. Other columns are ignored. No rows give no rows.
    """
    joined = _with_bitmaps(docs.select(_id(), "text"), least_chars, least_docs) \
        .select(F.col("c0").alias("doc_id"), F.col("c1").cast("binary").alias("text"), "drops")

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_kept(t, d) for t, d in zip(batch.column("text").to_pylist(), batch.column("drops").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([f[0] for f in found], pa.int64()),
                 pa.array([f[1] for f in found], pa.int64()),
                 pa.array([hashlib.sha256(f[2]).hexdigest() for f in found], pa.string())],
                names=["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    return joined.mapInArrow(report, "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string")


def without_repeated_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``docs`` with the lines that stay as ``text`` (null stays null) and, where there is one, ``n_chars`` brought up to date."""
    joined = _with_bitmaps(docs, least_chars, least_docs)
    schema = joined.drop("drops").schema
    changed = f"c{docs.columns.index('text')}"

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            drops = batch.column("drops").to_pylist()
            texts = batch.column(changed).cast(pa.binary()).to_pylist()
            new = pa.array([_kept(t, d)[2] if d else t for t, d in zip(texts, drops)], pa.binary()).cast(pa.string())
            names = [n for n in batch.schema.names if n != "drops"]
            yield pa.RecordBatch.from_arrays([new if n == changed else batch.column(n) for n in names], names=names)

    out = joined.mapInArrow(rewrite, schema).toDF(*docs.columns)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return out.select(*docs.columns)
