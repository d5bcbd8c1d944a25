"""Text quality by pairwise ranking.

A Bradley-Terry model gives each text a strength that is linear in its features; the chance that one text is better than
another is the logistic function of the difference of their strengths. It is fitted on pairs of a good and a poor text from
a bounded sample of labelled rows, by Newton steps on the logistic loss of feature differences. The score is the strength
moved so that a quantile of the training strengths falls on the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 20_000
RIVALS = 8
THRESHOLD = 0.3
RIDGE = 1e-2

_BYTES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789",
    "bang": b"!?", "bar": b"|", "symbol": b"#$%&*+/<=>@\\^_`{}~", "stop": b".,;:", "other": b"\"'()[]-", "line": b"\n",
}
_KIND = np.zeros((256, len(_BYTES) + 1))
for _k, _chars in enumerate(_BYTES.values()):
    _KIND[list(_chars), _k] = 1
_KIND[0x80:, len(_BYTES)] = 1
N_FEATURES = 3 * (len(_BYTES) + 1 + 6) + 2


def features(text: bytes | None) -> np.ndarray:
    """What the model sees of a UTF-8 text: shares of kinds of characters, of repeats and of odd words, each in three
    bends, and the length. Null is read as empty, which has zeros throughout."""
    raw = text or b""
    found = raw.split()
    n = len(found)
    if not n:
        return np.zeros(N_FEATURES)
    shares = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _KIND / len(raw)
    sizes = np.fromiter(map(len, found), np.int64, n)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    words = np.array([
        sum(a == b for a, b in zip(found, found[1:])) / n,
        1 - len(set(found)) / n if n > 1 else 0.0,
        1 - len(set(lines)) / len(lines),
        (sizes >= 20).mean(),
        (sizes == 1).mean(),
        min(1.0, sizes.mean() / 40),
    ])
    x = np.concatenate([shares, words])
    return np.concatenate([x, np.sqrt(x), x / (x + 0.03), [np.log1p(n) / 10, 1.0 / (1 + n)]])


@dataclass(frozen=True)
class Ranking:
    """A fitted model: strengths are ``(x - centre) / scale @ weights``; ``cut`` is the strength on the threshold."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    threshold: float = THRESHOLD

    def score(self, x: np.ndarray) -> np.ndarray:
        strength = (x - self.centre) / self.scale @ self.weights - self.cut
        odds = np.log(self.threshold / (1 - self.threshold))
        return 1 / (1 + np.exp(-np.clip(strength + odds, -500, 500)))


def fit_ranking(x: np.ndarray, good: np.ndarray, rivals: int = RIVALS, ridge: float = RIDGE,
                threshold: float = THRESHOLD, seed: int = 7) -> Ranking:
    """Every text meets ``rivals`` texts of the other class. Without both classes every score is a half."""
    width = x.shape[1] if x.ndim == 2 else N_FEATURES
    if not good.any() or good.all():
        return Ranking(np.zeros(width), np.ones(width), np.zeros(width), float(np.log(threshold / (1 - threshold))), threshold)
    centre, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale < 1e-9] = 1.0
    z = (x - centre) / scale
    random = np.random.default_rng(seed)
    win, lose = np.flatnonzero(good), np.flatnonzero(~good)
    winners = np.concatenate([np.repeat(win, rivals), random.choice(win, len(lose) * rivals)])
    losers = np.concatenate([random.choice(lose, len(win) * rivals), np.repeat(lose, rivals)])
    weights = np.zeros(width)
    for _step in range(12):
        slope, bend = ridge * len(winners) * weights, ridge * len(winners) * np.eye(width)
        for a in range(0, len(winners), 20_000):
            d = z[winners[a:a + 20_000]] - z[losers[a:a + 20_000]]
            p = 1 / (1 + np.exp(np.clip(d @ weights, -500, 500)))
            slope = slope - d.T @ p
            bend = bend + (d * (p * (1 - p))[:, None]).T @ d
        move = np.linalg.solve(bend, slope)
        weights = weights - move
        if np.abs(move).max() < 1e-6:
            break
    return Ranking(centre, scale, weights, _cut(z @ weights, good), threshold)


def _cut(strength: np.ndarray, good: np.ndarray, levels: int = 1000) -> float:
    """The quantile that parts the classes with the fewest errors; the middle one of several."""
    marks = np.quantile(strength, np.linspace(0, 1, levels + 1))
    wins, losses = np.sort(strength[good]), np.sort(strength[~good])
    errors = np.searchsorted(wins, marks) + len(losses) - np.searchsorted(losses, marks)
    best = np.flatnonzero(errors == errors.min())
    return float((marks[best[0]] + marks[best[-1]]) / 2)


def held_out():
    """Rows kept from training: crc32 of the id as text, modulo 5, is 0. A null id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Ranking:
    """Fits on at most ``sample_rows`` labelled rows that are not held out, picked by a hash of the id.

    Only those rows' features reach the driver. Null labels are left out.
    """
    picked = labels.filter(~held_out() & F.col("quality").isNotNull()) \
        .select(F.col("doc_id").cast("bigint").alias("doc_id"), (F.col("quality") == 1).alias("good")).distinct() \
        .orderBy(F.xxhash64("doc_id"), "doc_id", "good").limit(sample_rows)
    # At most sample_rows rows of two fields: small by construction.
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text")) \
        .join(F.broadcast(picked), "doc_id").select("good", "text")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t.as_py()).astype(np.float32).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("good"), pa.array(found, pa.binary())], names=["good", "x"])

    measured = rows.mapInArrow(measure, "good boolean, x binary").orderBy(F.xxhash64("x"), "x", "good").limit(2 * sample_rows).collect()
    x = np.array([np.frombuffer(bytes(r["x"]), np.float32) for r in measured], dtype=np.float64).reshape(-1, N_FEATURES)
    return fit_ranking(x, np.array([r["good"] for r in measured], dtype=bool))


def scored(docs: DataFrame, model: Ranking) -> DataFrame:
    """Per row ``doc_id``, ``held_out``, ``score`` and ``predicted`` (1 where the score reaches the threshold).

    Null and empty texts are scored like others; repeated rows each get theirs; other columns are ignored.
    """
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(_scores(batch.column("text"), model))],
                names=["doc_id", "held_out", "score"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"),
                       F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(judge, "doc_id bigint, held_out boolean, score double") \
        .withColumn("predicted", (F.col("score") >= model.threshold).cast("int"))


def _scores(texts: pa.Array, model: Ranking) -> np.ndarray:
    x = np.array([features(t.as_py()) for t in texts]).reshape(-1, N_FEATURES)
    return model.score(x)


def accepted(docs: DataFrame, model: Ranking) -> DataFrame:
    """The rows of ``docs`` that reach the threshold; columns as they were, whatever their names."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = _scores(batch.column("text").cast(pa.binary()), model) >= model.threshold
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(keep, docs.schema)
