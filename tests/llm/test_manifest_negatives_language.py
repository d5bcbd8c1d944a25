"""Merkle manifests, hard negatives and the byte network against plain reckonings."""

from __future__ import annotations

import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from formspark.llm import language, merkle, negatives, queries

SMALL = "/root/testdata/sf0.001"


def ordered(found):
    return sorted((tuple(r) for r in found), key=str)


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_merkle"])
def test_queries_match_their_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SMALL), connect(SMALL), queries.ORACLES[name]) is None


# Manifests -----------------------------------------------------------------------------------------------------------------

DOCS = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels_of(leaves, arity=16):
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest(*last[i:i + arity]) for i in range(0, len(last), arity)])
    return levels


def siblings(levels, at, arity=16):
    for level in levels[:-1]:
        start = at // arity * arity
        run = level[start:start + arity]
        yield run[:at - start], run[at - start + 1:]
        at //= arity


def brute_manifest(rows):
    groups = {}
    for r in rows:
        changed = list(r[:5])
        if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
            changed[4] = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])
        groups.setdefault(r[1], []).append((r[0], digest(*map(field, r[:5])), digest(*map(field, changed))))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, bytes.fromhex(x[1])))
    trees = {g: levels_of([x[1] for x in groups[g]]) for g in names}
    top = levels_of([trees[g][-1][0] for g in names]) if names else []
    for n, g in enumerate(names):
        for i, (doc, leaf, claim) in enumerate(groups[g]):
            path = [*siblings(trees[g], i), *siblings(top, n)]
            for left, right in path:
                claim = digest(*left, claim, *right)
            yield doc, leaf, trees[g][-1][0], top[-1][0], digest(*(x for l, r in path for x in l + r)), claim, claim == top[-1][0]


def manifest_rows():
    """A source of most rows, a null one, an empty name, single ones, repeated and missing ids, nulls, a very long text."""
    draw = random.Random(3)
    rows = []
    for i in range(700):
        source = draw.choice([*["big"] * 6, None, "", "é", "a", f"s{draw.randrange(40)}"])
        text = draw.choice([None, "", "Abc é", "lower", "X" * 300])
        rows.append((draw.choice([i, None, 5]) if i % 50 == 0 else i, source, draw.choice([None, "en"]), draw.choice([None, 3]), text))
    return [*rows, rows[3], rows[3], rows[7], (9000, "big", "en", 1, "Word " * 400_000)]


def test_manifest_matches_brute_force(spark):
    rows = manifest_rows()
    docs = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], DOCS + ", grp string, digest string, lo int").repartition(7)
    assert ordered(merkle.tamper_report(docs).collect()) == ordered(brute_manifest(rows))


@pytest.mark.parametrize("count", [0, 1, 2, 16, 17, 257])
def test_manifest_of_few_rows(spark, count):
    rows = [(i, "one", None, i, f"Text {i}") for i in range(count)]
    got = merkle.tamper_report(spark.createDataFrame(rows, DOCS)).collect()
    assert ordered(got) == ordered(brute_manifest(rows))


def test_changes_break_the_proof_and_order_does_not(spark):
    rows = [(i, f"s{i % 3}", "en", 5, f"t{i}") for i in range(100)]
    docs = spark.createDataFrame(rows, DOCS)
    plain = merkle.tamper_report(docs, claimed=F.lit(None).cast("string"))
    assert plain.filter("NOT verified").count() == 0
    again = merkle.tamper_report(spark.createDataFrame(rows[::-1], DOCS).repartition(5), claimed=F.lit(None).cast("string"))
    assert {r["root"] for r in plain.collect()} == {r["root"] for r in again.collect()}
    one = merkle.row_digest([F.when(F.col("doc_id") == 41, F.lit("u")).otherwise(F.col(c)) if c == "text" else F.col(c)
                             for c in merkle.COLUMNS])
    assert [r["doc_id"] for r in merkle.tamper_report(docs, claimed=one).filter("NOT verified").collect()] == [41]


def test_other_arity_and_columns(spark):
    rows = spark.createDataFrame([(i, "g", f"v{i}") for i in range(30)], "id int, kind string, v string")
    got = merkle.manifest(rows, "kind", "id", ("id", "v"), arity=3)
    leaves = [digest(field(i), field(f"v{i}")) for i in range(30)]
    levels = levels_of(leaves, 3)
    for r in got.collect():
        assert (r["leaf"], r["root"]) == (leaves[r["id"]], levels[-1][0])
        assert [(p["left"].hex(), p["right"].hex()) for p in r["path"]] == \
            [("".join(a), "".join(b)) for a, b in siblings(levels, r["id"], 3)]


# Hard negatives ------------------------------------------------------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<double>, label int"


def brute_negatives(rows):
    fit = []
    for i, x, label in rows:
        if i is None or x is None or label is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        whole = [math.floor(256 * v) for v in x]
        if sum(v * v for v in whole) < 2 ** 55:
            fit.append((i, (label + 1) % 10 if i % 7 == 0 else label, tuple(whole)))
    out = []
    for anchor in sorted({r for r in fit if r[0] % 100 == 0}):
        scored = sorted((-sum(a * b for a, b in zip(anchor[2], r[2])), r[0], r[1]) for r in fit
                        if r[0] != anchor[0] and len(r[2]) == len(anchor[2]))
        for top, positive, _label in [s for s in scored if s[2] == anchor[1]][:5]:
            inside = [s for s in scored if s[2] != anchor[1] and 80 * -top <= 100 * -s[0] <= 100 * -top][:5]
            out += [(anchor[0], positive, n + 1, s[1], -top, -s[0]) for n, s in enumerate(inside)]
    return out


def clustered(count, wide, seed, spread=0.1):
    """Vectors around a few centres, of very different length."""
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(12, wide))
    out = []
    for i in range(count):
        x = centres[draw.integers(12)] + draw.normal(size=wide) * spread
        x *= draw.choice([0.01, 0.3, 1, 1, 1, 4]) / np.linalg.norm(x)
        out.append((i, [float(v) for v in x], int(draw.integers(0, 4))))
    return out


@pytest.mark.parametrize("spread", [0.05, 1.0])
@pytest.mark.parametrize("bucket", [16, 1024])
def test_negatives_match_brute_force(spark, monkeypatch, spread, bucket):
    monkeypatch.setattr(negatives, "BUCKET_ROWS", bucket)
    rows = clustered(900, 12, 4, spread)
    got = negatives.hard_negatives(spark.createDataFrame(rows, VECTORS), block_bytes=20_000)
    assert ordered(got.collect()) == ordered(brute_negatives(rows))


def test_negatives_of_odd_rows(spark):
    """Nulls, repeated rows, ids on two vectors, ties, zero, huge and empty vectors, two lengths, clashing names."""
    draw = random.Random(2)
    rows = clustered(250, 4, 9)
    rows += [(None, [1.0] * 4, 1), (300, None, 1), (400, [1.0, None, 0.0, 0.0], 1), (500, [1.0, math.nan, 0.0, 0.0], 1),
             (600, [math.inf] * 4, 1), (700, [1.0] * 4, None), (800, [1e30] * 4, 1), (900, [0.0] * 4, 2), (901, [0.0] * 4, 2),
             (902, [0.0] * 4, 3), (1000, [], 2), (1001, [], 2), (1002, [], 3), (1100, [1.0, 2.0], 1), (1101, [1.0, 2.0], 1),
             (1103, [1.0, 1.9], 2), (1200, [3e4, 0.0, 0.0, 0.0], 0), (1201, [3e4, 1.0, 0.0, 0.0], 0), (1202, [2.9e4, 1.0, 0.0, 0.0], 5),
             (1300, [-1.0] * 4, 3), (1301, [1.0] * 4, 3), (-100, [1.0, 1.0, 0.5, 1.0], 1)]
    rows += [rows[0], rows[1], rows[1], (100, [0.5] * 4, 1)] + [(2000 + i, [0.5, 0.5, 0.0, 0.0], i % 3) for i in range(60)]
    draw.shuffle(rows)
    frame = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], VECTORS + ", key string, part int, score int")
    assert ordered(negatives.hard_negatives(frame).collect()) == ordered(brute_negatives(rows))
    assert negatives.hard_negatives(frame.limit(0)).count() == 0
    assert negatives.hard_negatives(frame.filter("vec_id % 100 <> 0")).count() == 0


def test_pruning_keeps_every_pair_that_reaches():
    draw = np.random.default_rng(1)
    for wide, spread, prunes in ((8, 0.02, True), (16, 0.05, True), (16, 2.0, False)):
        rows = np.array([r[1] for r in clustered(600, wide, 8, spread)])
        rows = np.floor(256 * rows / np.linalg.norm(rows, axis=1, keepdims=True))
        bucket = negatives.Bucket(np.arange(600), np.zeros(600, int), rows)
        anchors = rows[draw.integers(0, 600, 40)]
        turned, lengths = negatives._directions(anchors)
        exact = anchors @ rows.T
        least = np.sort(exact, axis=1)[:, -8]
        pairs = bucket.candidates(turned, lengths, least)
        assert (pairs is not None) == prunes
        if prunes:
            found = set(zip(*map(np.ndarray.tolist, pairs), strict=True))
            assert {(int(a), int(b)) for a, b in zip(*np.nonzero(exact >= least[:, None]), strict=True)} <= found
            assert len(found) < 40 * 600 / 4


# Languages -----------------------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def net(docs):
    return language.train(docs, sample_rows=100)


def test_held_out_languages_are_known(docs, net):
    got = language.languages(docs, net).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(got) > 200
    assert sum(r["lang"] == r["lang_pred"] for r in got) / len(got) > 0.98
    assert all(0 <= r["score"] <= 1 for r in got)
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) == r["held_out"] for r in got)


def plain_log_probabilities(net, window):
    """The network one place and one filter at a time."""
    window = [*window, *[0] * (language.WINDOW - len(window) + max(language.WIDTHS) - 1)]
    tops = []
    for width, kernel in zip(language.WIDTHS, net.filters, strict=True):
        best = np.full(language.FILTERS, -np.inf)
        for at in range(language.WINDOW):
            best = np.maximum(best, np.concatenate([net.table[b] for b in window[at:at + width]]) @ kernel)
        tops += list(best)
    scores = np.maximum(np.array(tops) + net.bias, 0) @ net.out + net.out_bias
    return scores - np.log(np.exp(scores - scores.max()).sum()) - scores.max()


def plain_language(net, text):
    data = text.encode()
    total, start = 0, 0
    while True:
        part = data[start:start + language.WINDOW]
        total = total + plain_log_probabilities(net, part) * len(part)
        start += language.STEP
        if start + max(language.WIDTHS) - 1 >= len(data):
            break
    sure = np.exp(total / len(data) - (total / len(data)).max())
    return net.languages[int(np.argmax(sure))], float(sure.max() / sure.sum())


def test_texts_match_a_plain_network(spark, net):
    texts = ["The and of", "é", "a", "Une de la " * 60, "x" * 256, "y" * 257, "der die " * 32, "der die " * 32 + "das", "z" * 258,
             "w" * 508, "w" * 511, "nul\0byte", "퟿ und"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in language.languages(frame, net).collect()}
    for i, text in enumerate(texts):
        want = plain_language(net, text)
        assert got[i]["lang_pred"] == want[0]
        assert abs(got[i]["score"] - want[1]) < 1e-3


def test_gradients_are_slopes():
    draw = np.random.default_rng(3)
    net = language.ByteNet.fresh(["a", "b", "c"])
    for name in ("table", "bias", "out", "out_bias"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    net.filters = [f.astype(np.float64) for f in net.filters]
    windows, truth = draw.integers(1, 60, (6, language.WINDOW)).astype(np.uint8), draw.integers(0, 3, 6)
    slopes = net.gradients(windows, truth)

    def loss():
        return -net.log_probabilities(windows)[np.arange(6), truth].mean()

    for weight, slope in zip(net.weights(), slopes, strict=True):
        at = np.unravel_index(int(np.abs(slope).argmax()), slope.shape)
        before = weight[at]
        weight[at] = before + 1e-4
        up = loss()
        weight[at] = before - 1e-4
        down = loss()
        weight[at] = before
        assert abs((up - down) / 2e-4 - slope[at]) < 1e-3 + 0.05 * abs(slope[at])


def test_languages_of_odd_rows(spark, net):
    rows = [(1, None, None), (2, "", "en"), (3, "12 + 34 = ?", "en"), (4, "½ ² _", None), (None, "The and of the", "en"),
            (5, "The thing and of the " * 60_000, None), (5, "The thing and of the " * 60_000, None)]
    frame = spark.createDataFrame([(*r, "x", 0.5) for r in rows], "doc_id bigint, text string, lang string, lang_pred string, h double")
    got = language.languages(frame, net).collect()
    assert len(got) == len(rows)
    unknown = {r["doc_id"] for r in got if r["lang_pred"] == "und"}
    assert unknown == {1, 2, 3, 4}
    assert {r["score"] for r in got if r["lang_pred"] == "und"} == {0.0}
    assert language.languages(frame.limit(0), net).count() == 0
    assert {r["lang_pred"] for r in language.languages(frame, None).collect()} == {"und"}


def test_training_rows(spark):
    """No labels, no letters or only held-out rows: no network. One language is always sure."""
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 4 == 2]
    shape = "doc_id bigint, text string, lang string"
    assert 3 not in held and 4 not in held
    useless = [(held[0], "text", "en"), (3, "77", "en"), (4, "text", None), (4, None, "en")]
    assert language.train(spark.createDataFrame(useless, shape)) is None
    assert language.train(spark.createDataFrame([], shape)) is None
    one = language.train(spark.createDataFrame([(i, f"text {i}", "en") for i in range(20)], shape), epochs=1)
    assert one.languages == ["en"]
    found, sure = language.spoken(one, pa.array(["abc"]))
    assert (found[0], sure[0]) == (0, 1.0)
