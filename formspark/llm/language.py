"""Language of texts by a small byte convolutional network.

Bytes get learned vectors; filters of several widths slide over windows of fixed length; each filter's highest answer in a
window goes into a softmax over the languages. A whole text is cut into windows that overlap by a filter's width, so that no
filter misses a place, and its windows' log-probabilities are averaged by their bytes.

The network is trained in numpy on a bounded sample of labelled rows, drawn by hash, as many for each language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
BYTE_DIMS = 8
STEP = WINDOW - max(WIDTHS) + 1
SAMPLE_ROWS = 400
CROPS = 4
EPOCHS = 6
UNKNOWN = "und"
_AT_ONCE = 128


@dataclass
class ByteNet:
    """Weights: a vector per byte, (width x dims, filters) per width, a bias per filter, the softmax layer."""

    languages: list[str]
    table: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def fresh(cls, languages: list[str], seed: int = 7) -> ByteNet:
        draw = np.random.default_rng(seed)
        table = draw.normal(0, 0.5, (256, BYTE_DIMS)).astype(np.float32)
        filters = [draw.normal(0, (2 / (w * BYTE_DIMS)) ** 0.5, (w * BYTE_DIMS, FILTERS)).astype(np.float32) for w in WIDTHS]
        units = FILTERS * len(WIDTHS)
        out = draw.normal(0, units ** -0.5, (units, len(languages))).astype(np.float32)
        return cls(languages, table, filters, np.zeros(units, np.float32), out, np.zeros(len(languages), np.float32))

    def weights(self) -> list[np.ndarray]:
        return [self.table, *self.filters, self.bias, self.out, self.out_bias]

    def pooled(self, windows: np.ndarray, places: bool = False):
        """Each filter's highest answer per window before its bias, and where asked for the place it stands at.

        A place is one of the window's bytes; the filters of all widths see the bytes from there on in one product.
        """
        wide = max(WIDTHS) * BYTE_DIMS
        padded = np.pad(windows, ((0, 0), (0, max(WIDTHS) - 1)))
        vectors = self.table[padded].reshape(len(windows), -1)
        patches = np.lib.stride_tricks.sliding_window_view(vectors, wide, axis=1)[:, ::BYTE_DIMS].reshape(-1, wide)
        kernel = np.zeros((FILTERS * len(WIDTHS), wide), np.float32)
        for n, (width, part) in enumerate(zip(WIDTHS, self.filters, strict=True)):
            kernel[n * FILTERS:(n + 1) * FILTERS, :width * BYTE_DIMS] = part.T
        answers = (kernel @ patches.T).reshape(len(kernel), len(windows), -1)
        if not places:
            return answers.max(axis=2).T, None
        at = answers.argmax(axis=2)
        return np.take_along_axis(answers, at[:, :, None], axis=2)[:, :, 0].T, at.T

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        scores = np.maximum(self.pooled(windows)[0] + self.bias, 0) @ self.out + self.out_bias
        return _log_softmax(scores)

    def gradients(self, windows: np.ndarray, truth: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross-entropy, in the order of ``weights``. Only the places of the maxima pass it on."""
        tops, at = self.pooled(windows, places=True)
        active = np.maximum(tops + self.bias, 0)
        wrong = np.exp(_log_softmax(active @ self.out + self.out_bias))
        wrong[np.arange(len(truth)), truth] -= 1
        wrong /= len(truth)
        back = (wrong @ self.out.T) * (active > 0)
        table, kernels = np.zeros_like(self.table), []
        padded = np.pad(windows, ((0, 0), (0, max(WIDTHS) - 1)))
        rows = np.arange(len(windows))[:, None, None]
        for n, (width, kernel) in enumerate(zip(WIDTHS, self.filters, strict=True)):
            own = slice(n * FILTERS, (n + 1) * FILTERS)
            mine = back[:, own]
            under = padded[rows, at[:, own, None] + np.arange(width)]
            seen = self.table[under].reshape(len(windows), FILTERS, -1)
            kernels.append(np.einsum("bfk,bf->kf", seen, mine))
            shares = (mine[:, :, None] * kernel.T).reshape(-1, BYTE_DIMS)
            np.add.at(table, under.reshape(-1), shares)
        table[0] = 0
        return [table, *kernels, back.sum(axis=0), active.T @ wrong, wrong.sum(axis=0)]


def _log_softmax(scores: np.ndarray) -> np.ndarray:
    scores = scores - scores.max(axis=1, keepdims=True)
    return scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))


def fitted(windows: np.ndarray, truth: np.ndarray, languages: list[str], epochs: int = EPOCHS, batch: int = 64,
           rate: float = 0.006, seed: int = 7) -> ByteNet:
    """Adam steps on the cross-entropy; every language is drawn as often as the most frequent one. Byte 0 is padding."""
    net = ByteNet.fresh(languages, seed)
    net.table[0] = 0
    draw = np.random.default_rng(seed)
    of_each = [np.flatnonzero(truth == k) for k in range(len(languages))]
    most = max(len(x) for x in of_each)
    mean = [np.zeros_like(w) for w in net.weights()]
    square = [np.zeros_like(w) for w in net.weights()]
    step, steps = 0, epochs * -(-most * len(languages) // batch)
    for _epoch in range(epochs):
        order = draw.permutation(np.concatenate([draw.permutation(np.resize(x, most)) for x in of_each]))
        for start in range(0, len(order), batch):
            rows = order[start:start + batch]
            step += 1
            pace = rate * (1 - step / (steps + 1)) * (1 - 0.999 ** step) ** 0.5 / (1 - 0.9 ** step)
            for w, g, m, s in zip(net.weights(), net.gradients(windows[rows], truth[rows]), mean, square, strict=True):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                w -= pace * m / (np.sqrt(s) + 1e-8)
    return net


def windows_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Fixed-length windows of a byte array; what lies beyond a window's end is 0."""
    at = starts[:, None] + np.arange(WINDOW)
    inside = at < ends[:, None]
    return np.where(inside, data[np.minimum(at, max(len(data) - 1, 0))], 0).astype(np.uint8)


def _bytes_and_edges(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an array without nulls, and the edges of its texts in them."""
    texts = texts.cast(pa.large_string())
    _valid, edges, data = texts.buffers()
    edges = np.frombuffer(edges, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), edges


def spoken(net: ByteNet, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The language's number and its probability for every text of an array without nulls or empty texts."""
    data, edges = _bytes_and_edges(texts)
    count = np.maximum(1, -(-(edges[1:] - edges[:-1] - max(WIDTHS) + 1) // STEP))
    owner = np.repeat(np.arange(len(texts)), count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    starts, ends = edges[:-1][owner] + nth * STEP, edges[1:][owner]
    sums = np.zeros((len(texts), len(net.languages)))
    for at in range(0, len(owner), _AT_ONCE):
        part = slice(at, at + _AT_ONCE)
        size = np.minimum(ends[part] - starts[part], WINDOW)
        found = net.log_probabilities(windows_of(data, starts[part], ends[part]))
        np.add.at(sums, owner[part], found * size[:, None])
    sure = np.exp(_log_softmax(sums / (edges[1:] - edges[:-1])[:, None]))
    best = sure.argmax(axis=1)
    return best, sure[np.arange(len(best)), best]


def held_out() -> Column:
    """Rows never learned from: remainder 2 of the id's CRC-32 by 4. A row without an id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _has_letter(column: str) -> Column:
    return F.coalesce(F.col(column).rlike(r"\p{L}"), F.lit(False))


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, crops: int = CROPS, epochs: int = EPOCHS) -> ByteNet | None:
    """A network for the languages of ``docs``; None where no row has both a language and a text with a letter.

    Learns from rows that are not held out, at most ``sample_rows`` for each language, those with the smallest hashes of id
    and text, equal ones once; of each, ``crops`` pieces of a window's length spread over the whole text, and as many shorter
    ones. What reaches the driver grows with the number of languages, never with that of documents.
    """
    rows = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & ~held_out() & _has_letter("text"))
    # The rows of each language say below which hash a little more than the sample lies; no group is ranked or sorted.
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).collect()
    if not counts:
        return None
    limits = docs.sparkSession.createDataFrame(
        [(r["lang"], min((1 << 63) - 1, int(1.25 * (sample_rows + 40) / r["n"] * (1 << 64)) - (1 << 63))) for r in counts],
        "lang string, most bigint")
    kept = rows.withColumn("h", F.xxhash64("doc_id", "text")).join(F.broadcast(limits), "lang").filter("h <= most")
    step = F.greatest(F.lit(0), F.length("text") - WINDOW) / F.lit(max(1, crops - 1))
    pieces = F.transform(F.sequence(F.lit(0), F.lit(crops - 1)),
                         lambda i: F.substring("text", (i * step).cast("int") + 1, F.lit(WINDOW)))
    drawn = kept.select("lang", "h", pieces.alias("pieces")).groupBy("lang", "h").agg(F.min("pieces").alias("pieces")).collect()
    found, held = [], dict.fromkeys((r["lang"] for r in counts), 0)
    for r in sorted(drawn, key=lambda r: (r["lang"], r["h"])):
        held[r["lang"]] += 1
        if held[r["lang"]] <= sample_rows:
            found.append(r)
    if not found:
        return None
    languages = sorted({r["lang"] for r in found})
    parts: list[bytes] = []
    truth: list[int] = []
    draw = np.random.default_rng(5)
    for r in found:
        whole = sorted({p for p in r["pieces"] if p})
        short = []
        for piece in whole:
            length = int(draw.integers(8, 96))
            start = int(draw.integers(0, max(1, len(piece) - length)))
            short.append(piece[start:start + length])
        # A piece without a letter has no language.
        fit = [p.encode()[:WINDOW] for p in whole + short if any(map(str.isalpha, p))]
        parts += fit
        truth += [languages.index(r["lang"])] * len(fit)
    edges = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    data = np.frombuffer(b"".join(parts), np.uint8)
    return fitted(windows_of(data, edges[:-1], edges[1:]), np.array(truth), languages, epochs)


def languages(docs: DataFrame, net: ByteNet | None) -> DataFrame:
    """Per row ``doc_id``, ``held_out``, ``lang_pred`` and ``score``, the probability of that language, over the whole text.

    ``und`` with score 0 where the text is null, empty or without a letter, or where there is no network. Other columns are
    ignored; repeated rows and rows without an id get results of their own; a text of any length is read window by window.
    """
    rows = docs.select("doc_id", held_out().alias("held_out"), F.when(_has_letter("text"), F.col("text")).alias("text"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            names = np.full(batch.num_rows, UNKNOWN, dtype=object)
            scores = np.zeros(batch.num_rows)
            known = np.flatnonzero(np.asarray(texts.is_valid()))
            if net is not None and len(known):
                best, sure = spoken(net, texts.drop_null())
                names[known], scores[known] = np.array(net.languages, dtype=object)[best], np.clip(sure, 0, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores)],
                names=["doc_id", "held_out", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(judge, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
