"""Merkle manifest of a table: trees with nested-interval labels, one per source and one over the sources.

Every node carries the interval of leaf ranks it covers. A node of level k covers the ranks of one bucket of ``arity**k``, so a
child finds its parent by (source, bucket of the level) and containment of intervals, and its siblings are what is left of the
parent's interval without its own. Ancestors are attached from the top down: each level joins the one above it once, and only
the nodes of the lowest level, a sixteenth of the rows, ever carry digests of others. No text is shuffled.

Ranks come from a range partitioning by (source, id) and one summary row per partition and source, so a source that holds most
rows spreads like any other. Where nothing is said, H is the lowercase hex SHA-256 of its inputs, digests as hex text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formspark.llm.shared import checkpointed

ARITY = 16
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PATH = "array<struct<left:binary,right:binary>>"


def row_digest(columns: Sequence[Column]) -> Column:
    """H of the values, each ``-`` if null, else its length in bytes, a colon and the value, so that no two rows write alike."""
    parts = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-"))
             for c in columns]
    return F.sha2(F.concat(*parts), 256)


def proof_digest(path: Column) -> Column:
    """H of the siblings of a path, level by level from the leaf up, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda p: _hex(F.concat(p["left"], p["right"]))), ""), 256)


def folded(path: Column, leaf: Column) -> Column:
    """The root that follows from a leaf and the siblings of its path."""
    return F.aggregate(path, leaf, lambda h, p: F.sha2(F.concat(_hex(p["left"]), h, _hex(p["right"])), 256))


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``lo`` (rank in ``grp`` by ``order``), ``hi`` and ``n`` (rows of the group) for every row."""
    sorted_rows = rows.repartitionByRange("grp", *order).sortWithinPartitions("grp", *order)
    placed = checkpointed(sorted_rows.withColumn("at", F.monotonically_increasing_id()))
    placed = placed.withColumn("part", F.shiftright("at", 33))
    # One row for each partition and group in it.
    runs = placed.groupBy("grp", "part").agg(F.min("at").alias("first"), F.count("*").alias("held"))
    whole = Window.partitionBy("grp")
    before = F.coalesce(F.sum("held").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select("grp", "part", (before - F.col("first")).alias("shift"), F.sum("held").over(whole).alias("n"))
    return placed.join(runs, ["grp", "part"]).withColumn("lo", F.col("at") + F.col("shift")) \
        .withColumn("hi", F.col("lo") + 1).drop("at", "part", "shift")


def _grown(leaves: DataFrame, arity: int) -> list[DataFrame]:
    """The inner nodes, a frame a level from the lowest: ``grp``, ``n``, ``lo``, ``hi``, ``digest``, ``kids`` by rank."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    levels: list[DataFrame] = []
    nodes, width = leaves, arity
    while width < most * arity:
        kids = F.array_sort(F.collect_list(F.struct("lo", "hi", "digest", "item")))
        parents = nodes.filter(F.col("n") > width // arity) \
            .groupBy("grp", "n", F.expr(f"lo div {width}L").alias("bucket")).agg(kids.alias("kids"))
        text = F.array_join(F.transform("kids", lambda k: _hex(k["digest"])), "")
        levels.append(checkpointed(parents.select(
            "grp", "n", F.element_at("kids", 1)["lo"].alias("lo"), F.element_at("kids", -1)["hi"].alias("hi"),
            F.unhex(F.sha2(text, 256)).alias("digest"), "kids")))
        nodes = levels[-1].select("grp", "n", "lo", "hi", "digest", F.lit(None).alias("item"))
        width *= arity
    return levels


def _tops(leaves: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """The last node of every group: ``grp`` and ``digest``."""
    found = leaves.filter("n = 1").select("grp", "digest")
    for level in levels:
        found = found.unionByName(level.filter("lo = 0 AND hi = n").select("grp", "digest"))
    return found


def _pathed(leaves: DataFrame, levels: list[DataFrame], tops: DataFrame, arity: int) -> DataFrame:
    """Every leaf's ``item`` with its ``path``; ``tops`` has the path of each group's last node and what else to hand down."""
    extra = [c for c in tops.columns if c not in ("grp", "path")]
    above = None
    for depth in range(len(levels), 0, -1):
        width = arity ** depth
        level = levels[depth - 1].select("grp", "n", "lo", "hi", "kids", F.expr(f"lo div {width * arity}L").alias("up"))
        known = level.filter("lo = 0 AND hi = n").join(tops, "grp").select("grp", "lo", "hi", "kids", "path", *extra)
        if above is not None:
            # A child and its parent share the bucket of the parent's level; the parent's interval holds the child's.
            parents = above.select("grp", F.expr(f"lo div {width * arity}L").alias("up"), F.col("lo").alias("from"),
                                   F.col("hi").alias("to"), F.col("kids").alias("run"), F.col("path").alias("rest"), *extra)
            inner = level.filter("NOT (lo = 0 AND hi = n)").join(parents, ["grp", "up"]) \
                .filter("lo >= from AND hi <= to") \
                .select("grp", "lo", "hi", "kids", _longer("run", "lo", "hi", "rest").alias("path"), *extra)
            known = known.unionByName(inner)
        above = known
    alone = leaves.filter("n = 1").join(tops, "grp").select("item", "digest", "path", *extra)
    if above is None:
        return alone
    own = above.select(F.explode("kids").alias("kid"), "kids", F.col("path").alias("rest"), *extra)
    return alone.unionByName(own.select("kid.item", "kid.digest", _longer("kids", "kid.lo", "kid.hi", "rest").alias("path"), *extra))


def _longer(run: str, low: str, high: str, rest: str) -> Column:
    """The path of a node: its parent's interval without its own, then the parent's path."""
    left = F.filter(F.col(run), lambda k: k["hi"] <= F.col(low))
    right = F.filter(F.col(run), lambda k: k["lo"] >= F.col(high))
    sides = F.struct(_joined(left).alias("left"), _joined(right).alias("right"))
    return F.concat(F.array(sides), F.col(rest)).cast(_PATH)


def _joined(nodes: Column) -> Column:
    return F.aggregate(nodes, F.lit(b""), lambda all_, k: F.concat(all_, k["digest"]))


def manifest(rows: DataFrame, group: str = "source", key: str = "doc_id", columns: Sequence[str] = COLUMNS,
             claimed: Column | None = None, arity: int = ARITY) -> DataFrame:
    """Per row ``key``, ``leaf``, ``claim``, ``subroot``, ``root`` (hex) and ``path``, its siblings from the leaf to the root.

    Leaves are the rows' digests over ``columns``; per ``group`` they ascend by ``key`` and every ``arity`` consecutive nodes
    become their H, a last run of fewer likewise, until one is left: the subroot, or the leaf itself where it is alone. The
    subroots, null group first, then by UTF-8 bytes, give the root in the same way. ``claim`` is ``claimed`` (an expression for
    another digest over the input's columns), or the leaf where that is null.

    Nulls in any column are values of their own. Rows with the same key, null keys among them, are ordered by digest, so equal
    rows are leaves of their own and the root doesn't depend on the input's order. Columns not named are ignored, whatever their
    names. No rows give no rows. The driver sees one number a tree (its largest group); the number of levels follows from it.
    """
    named = rows.select(F.col(key).alias("key"),
                        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("grp"),
                        F.unhex(row_digest([F.col(c) for c in columns])).alias("digest"),
                        (F.unhex(claimed) if claimed is not None else F.lit(None).cast("binary")).alias("claim"))
    leaves = _ranked(checkpointed(named), ["key", "digest", "claim"]).withColumn("item", F.struct("key", "claim"))
    levels = _grown(leaves, arity)
    subs = _tops(leaves, levels).select(F.lit("").alias("grp"), F.col("grp").alias("name"), "digest")
    heads = _ranked(subs, ["name"]).withColumn("item", F.col("name"))
    upper = _grown(heads, arity)
    roots = _tops(heads, upper).select("grp", F.col("digest").alias("root"), F.array().cast(_PATH).alias("path"))
    tops = checkpointed(_pathed(heads, upper, roots, arity).select(
        F.col("item").alias("grp"), F.col("digest").alias("subroot"), "root", "path"))
    found = _pathed(leaves, levels, tops, arity)
    return found.select(
        F.col("item.key").alias(key), _hex(F.col("digest")).alias("leaf"),
        _hex(F.coalesce("item.claim", "digest")).alias("claim"), _hex(F.col("subroot")).alias("subroot"),
        _hex(F.col("root")).alias("root"), "path")


def lowered_text(rows_text: str = "text", key: str = "doc_id", columns: Sequence[str] = COLUMNS, every: int = 5) -> Column:
    """Digest of a row whose text lost its capitals, for keys whose CRC-32 ``every`` divides; null for other rows."""
    changed = [F.translate(F.col(c), UPPER, LOWER) if c == rows_text else F.col(c) for c in columns]
    return F.when(F.crc32(F.col(key).cast("string").cast("binary")) % every == 0, row_digest(changed))


def tamper_report(docs: DataFrame, claimed: Column | None = None) -> DataFrame:
    """Per document its digests, and whether the root follows from its claimed leaf and the siblings of the manifest.

    ``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``verified``. ``claimed`` stands for what
    a receiver of the table computes; where it is left out, a fifth of the documents come with lower-cased text.
    """
    found = manifest(docs.select(*COLUMNS), claimed=lowered_text() if claimed is None else claimed)
    found = found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                         folded(F.col("path"), F.col("claim")).alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
