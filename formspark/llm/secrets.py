"""Secret scans with one automaton for all rules."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formspark.llm.automaton import Automaton

SHARD_BYTES = 4_000_000


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds matches; those whose ``value`` group (or whole) is shorter than ``least`` are dropped."""

    kind: str
    pattern: str
    least: int = 0
    value: str | None = None


# The three base rules. The run of hexadecimal digits carries its least length in the pattern, which finds
# the same spans with far fewer of them to look at; others that are too short still use up their text.
BASE = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", 12,
         r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)\Z"""),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    Rule("hex", r"[0-9a-f]{16,}"),
)
# Further public credential formats.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 20),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
_HEAD = re.compile(rb"password|passwd|secret|token|api_?key", re.IGNORECASE)


def _long_enough(rule: Rule, found: bytes) -> bool:
    if not rule.value:
        return len(found) >= rule.least
    value = re.compile(rule.value.encode()).match(found, _HEAD.match(found).end())
    return len(value.group(1)) >= rule.least


class Scanner:
    """The rules compiled; built once in each worker process."""

    _built: dict = {}

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        self.automaton = Automaton([r.pattern for r in rules])

    @classmethod
    def of(cls, rules: tuple[Rule, ...]) -> Scanner:
        if rules not in cls._built:
            cls._built[rules] = cls(rules)
        return cls._built[rules]

    def spans(self, texts: list[bytes | None]) -> list[list[tuple[int, int, int]]]:
        """Per text (start, rule, end) in code points, by start, then rule."""
        out: list[list] = [[] for _ in texts]
        for a, z in _shards(texts):
            part = [t or b"" for t in texts[a:z]]
            at, before = -1, None
            for row, rule, start, end in self.automaton.matches(part):
                if _long_enough(self.rules[rule], part[row][start:end]):
                    if row != at:
                        at, before = row, _code_points(part[row])
                    out[a + row].append((int(before[start]), rule, int(before[end])))
        return [sorted(s) for s in out]


def _code_points(text: bytes) -> np.ndarray:
    """The number of code points before each byte and before the end."""
    begins = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
    return np.concatenate([[0], np.cumsum(begins, dtype=np.int32)])


def _shards(texts: list[bytes | None]) -> Iterator[tuple[int, int]]:
    start, held = 0, 0
    for i, text in enumerate(texts):
        if i > start and held + len(text or b"") > SHARD_BYTES:
            yield start, i
            start, held = i, 0
        held += len(text or b"")
    if start < len(texts):
        yield start, len(texts)


def secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, base: int = len(BASE)) -> DataFrame:
    """Per row ``doc_id``, ``counts`` (a count per rule), ``base_spans`` and ``spans``.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and then by the order of the rules; ``base_spans``
    holds those of the first ``base`` rules. Matches of different rules may overlap. Null and empty texts have none;
    repeated rows each get theirs; other columns are ignored; no rows give no rows.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner.of(rules)
        for batch in batches:
            found = scanner.spans(batch.column("text").to_pylist())
            named = [[f"{rules[k].kind}:{a}:{z}" for a, k, z in s] for s in found]
            plain = [[f"{rules[k].kind}:{a}:{z}" for a, k, z in s if k < base] for s in found]
            counts = [[sum(k == r for _, k, _ in s) for r in range(len(rules))] for s in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.list_(pa.int64())), pa.array(plain, pa.list_(pa.string())),
                 pa.array(named, pa.list_(pa.string()))], names=["doc_id", "counts", "base_spans", "spans"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(scan, "doc_id bigint, counts array<bigint>, base_spans array<string>, spans array<string>")


def secret_report(docs: DataFrame) -> DataFrame:
    """``secrets`` with counts and a digest of the base rules, as columns."""
    found = secrets(docs)
    return found.select(
        "doc_id", *(F.col("counts")[i].alias(f"n_{r.kind}") for i, r in enumerate(BASE)),
        F.sha2(F.array_join("base_spans", ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join("spans", ",").alias("spans"))


def redacted(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``[kind]``; overlapping spans become one, named by the first."""
    schema = docs.schema

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner.of(rules)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            spans = scanner.spans([t.encode() if t is not None else None for t in texts])
            new = []
            for text, found in zip(texts, spans):
                parts, at = [], 0
                for a, k, z in found:
                    if a >= at:
                        parts += [text[at:a], f"[{rules[k].kind}]"]
                    at = max(at, z)
                new.append("".join([*parts, text[at:]]) if found else text)
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.string()) if n == "text" else batch.column(n)
                                              for n in batch.schema.names], names=batch.schema.names)

    return docs.mapInArrow(rewrite, schema)
