"""Personal data: fixed patterns, and terms that give protected entities away.

Information-theoretic sanitisation: every matched value is a protected entity. A term that keeps turning up next to one
entity tells more about it than its own frequency allows. With counts of documents over the whole corpus, the disclosure
of entity e by term t is PMI(t; e) / IC(e): 0 where they are independent, 1 where t occurs with e alone. Every pair of an
entity and a term beside it is weighed. Terms at or above a threshold are spans of their own in documents that hold the
entity, unless the pair may be chance: Chernoff's bound on the probability of meeting that often among independent ones,
exact where one of them stands in one document, must be below a level of significance.

A term is a run of at least ``LEAST_LETTERS`` letters. Shorter words and numbers are never weighed, so short names and staff
numbers stay in the text.

Everything is DataFrame functions: matches come from ``regexp_extract_all``, their places from the lengths of the pieces
that ``split`` leaves between them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formspark.llm.shared import checkpointed

# The kinds in order, and their patterns. Quantifiers are possessive and starts are anchored to the edge of a
# run (or to the end of the match before) where that finds the same matches; so long runs cost no more than their length.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = tuple(PATTERNS)
TERM = "term"
CONTEXT_WORDS = 5
LEAST_LETTERS = 4
DISCLOSURE = 0.9
SIGNIFICANCE = 0.05
BROADCAST_TERMS = 200_000
_WORDS = r"[^\p{L}]+"
_STEP = 512


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Whether the digits pass the Luhn check: from the right, every second digit counts double, its digits summed."""
    turned = F.split(F.reverse(_digits(value)), "")
    total = F.aggregate(
        F.transform(turned, lambda d, i: F.when(i % 2 == 0, d.try_cast("int")).otherwise(
            d.try_cast("int") * 2 - F.when(d.try_cast("int") > 4, F.lit(9)).otherwise(F.lit(0)))),
        F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0)))
    return total % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    """What a match must satisfy beyond its pattern."""
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (
            F.coalesce(F.substring(F.ltrim(p, F.lit("0")), 1, 3).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return F.when(F.length(_digits(value)).between(14, 19), _luhn(value)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def _spans(text: Column, pattern: str | Column, order: int, kind: str, holds, beside: bool = True) -> Column:
    """Array of (start, order, kind, end, value, before, after) for the matches of a pattern in a text.

    ``before`` and ``after`` are the words beside the match, those of other matches among them; none unless ``beside``.
    """
    found = F.regexp_extract_all(text, F.lit(pattern) if isinstance(pattern, str) else pattern, F.lit(0))
    pieces = F.split(text, pattern, -1)
    runs = F.flatten(F.zip_with(pieces, found, lambda p, m: F.array(p, F.coalesce(m, F.lit("")))))
    words = F.transform(runs, lambda r: F.filter(F.split(r, _WORDS), lambda w: w != ""))
    none = F.array().cast("array<string>")

    def spanned(x: Column) -> Column:
        """From the runs of text, every second one a match, with their ends and the numbers of words up to there."""

        def words_of(at: Column, n: Column) -> Column:
            return F.slice(x["all"], at + 1, n) if beside else none

        def span(m: Column, i: Column) -> Column:
            k = 2 * i
            first = F.greatest(F.lit(0), x["counts"][k] - CONTEXT_WORDS) if beside else F.lit(0)
            return F.struct(
                x["ends"][k].alias("start"), F.lit(order).alias("order"), F.lit(kind).alias("kind"),
                x["ends"][k + 1].alias("end"), m.alias("value"),
                words_of(first, x["counts"][k] - first).alias("before"),
                words_of(x["counts"][k + 1], F.lit(CONTEXT_WORDS)).alias("after"))

        return F.filter(F.transform(found, span), lambda s: holds(s["value"]))

    known = [_running(F.transform(runs, F.length)).alias("ends")]
    if beside:
        known += [_running(F.transform(words, F.size)).alias("counts"), F.flatten(words).alias("all")]
    # As the only element of an array, so that it is reckoned once and not for every match.
    return F.flatten(F.transform(F.array(F.struct(*known)), spanned))


def _running(numbers: Column) -> Column:
    """The sums up to each number of an array, in steps of ``_STEP``.

    An array that grows inside an aggregate is copied at every element; in steps the copies stay short, and the cost of a
    text is near its length.
    """

    def plain(part: Column) -> Column:
        return F.aggregate(
            part, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("ends")),
            lambda a, n: F.struct((a["at"] + n).alias("at"), F.array_append(a["ends"], a["at"] + n).alias("ends")))["ends"]

    def stepped(n: Column) -> Column:
        steps = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(n) - 1) / _STEP).cast("int")))
        return F.transform(steps, lambda k: plain(F.slice(n, k * _STEP + 1, _STEP)))

    def joined(parts: Column) -> Column:
        totals = plain(F.transform(parts, lambda p: F.coalesce(F.get(p, F.size(p) - 1), F.lit(0))))
        # The array is bound once and not worked out again for every part.
        return F.flatten(F.transform(F.array(totals), lambda t: F.flatten(F.transform(parts, lambda p, i: F.transform(
            p, lambda x: x + F.when(i > 0, F.get(t, i - 1)).otherwise(F.lit(0)))))))

    bound = F.flatten(F.transform(F.array(numbers), lambda n: F.transform(F.array(stepped(n)), joined)))
    return F.flatten(bound)


_SPAN = "array<struct<start:int,order:int,kind:string,end:int,value:string,before:array<string>,after:array<string>>>"


def base_spans(text: Column) -> Column:
    """All spans of the fixed kinds in a text, by start, then kind."""
    parts = []
    for order, kind in enumerate(KINDS):
        sign = F.contains(text, F.lit("@")) if kind == "email" else text.rlike(r"\+[0-9]" if kind == "phone" else r"[0-9]")
        parts.append(F.when(sign, _spans(text, PATTERNS[kind], order, kind, lambda v, k=kind: _holds(k, v)))
                     .otherwise(F.array().cast(_SPAN)))
    return F.array_sort(F.concat(*parts))


def _named(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _revealing(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``entity``, ``term`` for terms whose disclosure reaches the threshold."""
    total = docs.count()
    beside = found.select("doc_id", "mark", F.explode("base").alias("s")).select(
        "doc_id", "mark", F.concat_ws(":", "s.kind", "s.value").alias("entity"),
        F.concat("s.before", "s.after").alias("words"))
    near = checkpointed(beside.select(
        "doc_id", "mark", "entity",
        F.explode(F.array_distinct(F.filter("words", lambda w: F.length(w) >= LEAST_LETTERS))).alias("term")).distinct())
    entities = beside.groupBy("entity").agg(F.count_distinct("doc_id", "mark").alias("n_entity"))
    together = near.groupBy("entity", "term").agg(F.count("*").alias("n_both"))

    # A term is in at least as many documents as it stands beside entities in: too common there, too common in all.
    seen = near.select("term", "doc_id", "mark").distinct().groupBy("term").agg(F.count("*").alias("n_near"))
    pairs = checkpointed(together.join(entities, "entity").join(seen, "term").filter(_disclosed("n_near", total)))
    terms = checkpointed(pairs.select("term").distinct())
    said = docs.select(F.explode(F.array_distinct(F.split("text", _WORDS))).alias("term")).filter(F.length("term") >= LEAST_LETTERS)
    # Broadcast only while there are few; beyond that the corpus is counted first and the counts are joined.
    if terms.count() <= BROADCAST_TERMS:
        said, terms = said.join(F.broadcast(terms), "term"), None
    counts = said.groupBy("term").agg(F.count("*").alias("n_term"))
    if terms is not None:
        counts = counts.join(terms, "term")
    return pairs.join(counts, "term").filter(_disclosed("n_term", total)).select("entity", "term")


def _disclosed(n_term: str, total: int) -> Column:
    """Whether a term of so many documents gives the entity away, and not by chance."""
    whole, both, term, entity = F.lit(float(total)), F.col("n_both"), F.least(F.col(n_term), F.lit(total)), F.col("n_entity")
    content = F.log(whole / entity)
    pmi = F.log(both * whole / (term * entity))

    def unlikely(draws: Column, share: Column) -> Column:
        """Minus the log of the bound on ``both`` hits in so many draws."""
        missed = F.when((draws > both) & (share < 1), (draws - both) * F.log(F.try_divide(draws - both, draws * (1 - share)))) \
            .otherwise(F.lit(0.0))
        return both * F.log(both / (draws * share)) + missed

    least = F.greatest(unlikely(term, entity / whole), unlikely(entity, term / whole))
    return (content > 0) & (F.try_divide(pmi, content) >= DISCLOSURE) & (least >= -math.log(SIGNIFICANCE))


def _flagged(holders: DataFrame, reveals: DataFrame) -> DataFrame:
    """``i``, ``m`` and ``words``: the revealing terms that stand in a document with their entity.

    Goes from the documents of the terms: a disclosing term has few beyond those where it stands beside the entity, while an
    entity may be in many documents and have many terms.
    """
    reveals = checkpointed(reveals)
    few = reveals.count() <= BROADCAST_TERMS
    said = holders.select("doc_id", "mark", F.explode(F.array_distinct(F.split("text", _WORDS))).alias("term")) \
        .filter(F.length("term") >= LEAST_LETTERS)
    meant = said.join(F.broadcast(reveals) if few else reveals, "term") \
        .select(F.col("doc_id").alias("i"), F.col("mark").alias("m"), F.col("entity").alias("e"), "term")
    held = holders.select("doc_id", "mark", F.explode("base").alias("s")) \
        .select("doc_id", "mark", F.concat_ws(":", "s.kind", "s.value").alias("entity"))
    both = meant.join(held, F.col("i").eqNullSafe(F.col("doc_id")) & (F.col("m") == F.col("mark")) & (F.col("e") == F.col("entity")),
                      "left_semi")
    return both.groupBy("i", "m").agg(F.collect_set("term").alias("words"))


def personal_data(docs: DataFrame) -> DataFrame:
    """Per row ``doc_id``, ``mark``, ``text``, ``base`` and ``terms``; text only where there are base spans.

    ``base`` and ``terms`` are arrays of spans by start and kind; a span's ``start`` and ``end`` are code points, end exclusive.
    Null and empty texts have none. Repeated rows each get theirs; rows without an id are treated like others. Terms that
    touch a base span are left to it.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("mark"),
                        F.coalesce("text", F.lit("")).alias("text"))
    found = texts.withColumn("base", base_spans(F.col("text")))
    found = checkpointed(found.withColumn("text", F.when(F.size("base") > 0, F.col("text"))))
    holders = found.filter(F.size("base") > 0)
    flagged = _flagged(holders, _revealing(texts, holders))
    joined = found.join(flagged, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("mark") == F.col("m")), "left").drop("i", "m")
    return joined.withColumn("terms", F.when(F.col("words").isNotNull(), _term_spans()).otherwise(F.array().cast(_SPAN))).drop("words")


def _term_spans() -> Column:
    """Whole-word occurrences of a row's ``words`` in its ``text``, clear of base spans."""
    pattern = F.concat(F.lit(r"(?<!\p{L})(?:"), F.array_join(F.sort_array("words", asc=False), "|"), F.lit(r")(?!\p{L})"))
    spans = _spans(F.col("text"), pattern, len(KINDS), TERM, lambda v: F.lit(True), beside=False)
    return F.filter(spans, lambda t: ~F.exists("base", lambda b: (t["start"] < b["end"]) & (b["start"] < t["end"])))


def personal_report(docs: DataFrame) -> DataFrame:
    """Per row ``doc_id``, counts by kind, ``base_sha256``, ``spans`` and ``n_term``; see ``personal_data``."""
    found = personal_data(docs)
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")
    return found.select(
        "doc_id", *(count(k).alias(f"n_{k}") for k in KINDS),
        F.sha2(_named(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _named(F.array_sort(F.concat("base", "terms"))).alias("spans"), F.size("terms").cast("bigint").alias("n_term"))


def sanitised(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``clean_text`` for rows with spans: base values become ``[kind]``, revealing terms are removed."""
    found = personal_data(docs).filter(F.size("base") > 0)
    spans = F.array_sort(F.concat("base", "terms"))
    folded = F.aggregate(
        spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda a, s: F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.when(s["start"] < a["at"], a["out"]).otherwise(F.concat(
                a["out"], F.col("text").substr(a["at"] + 1, s["start"] - a["at"]),
                F.when(s["kind"] == TERM, F.lit("")).otherwise(F.concat(F.lit("["), s["kind"], F.lit("]"))))).alias("out")))
    return found.withColumn("f", folded).select(
        "doc_id", F.concat(F.col("f.out"), F.col("text").substr(F.col("f.at") + 1, F.length("text"))).alias("clean_text"))
