"""Main text of web pages by classified text blocks.

A page is cut into flat text blocks at every tag that is not inline. A block is described by its words, the share of
them inside links, the same of the blocks before and after, the region of the page it stands in, and whether a name
around it is one that furniture often has. A decision tree, grown on the small table below, says which blocks are article
text. A page is read once from front to back, in time that grows with its length, however broken its tags are.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A tag ends at the next ">" outside quotes, or where another begins; so no start is read further than the next few.
_REST = r"(?:\"[^\"]*\"|'[^']*'|[^\"'<>])*+>|[^<>]*+>?"
_TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/<>]*)({_REST})|<[!?][^<>]*>?", re.DOTALL)
_NAMED = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.IGNORECASE)
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup "
    "time tt u var wbr img".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Their content is no markup; the others hold markup that is not the page's text.
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_ASIDE = frozenset("noscript template select button svg object".split())
_ASIDE_TAG = re.compile(rf"<(/?)({'|'.join(sorted(_ASIDE))})(?=[\s/>])({_REST})", re.IGNORECASE)
_ARTICLE = re.compile(r"<(/?)(?:article|main)(?=[\s/>])", re.IGNORECASE)
_NOISE_TAGS = frozenset("nav footer aside form dialog menu head".split())
_NOISE_NAMES = frozenset(
    "ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs captcha comment comments consent cookie "
    "cookies discussion disqus footer form header login masthead menu modal nav navbar navigation newsletter notice notices "
    "pagination popup promo promotion related replies reply respond reviews search share sharing sidebar signup social sponsor "
    "sponsored subscribe subscription toolbar widget contentinfo complementary alert alertdialog dialog".split())
# As part of a longer name these still are furniture, those of the second line in a class only; the others may be anything.
_SURE_PARTS = frozenset(
    "advert advertisement adverts advertising breadcrumb breadcrumbs captcha comment comments consent cookie cookies disqus login modal "
    "newsletter pagination popup promo replies reply respond reviews signup sponsor sponsored subscribe subscription".split())
_SURE_IN_CLASS = frozenset("footer nav navbar navigation share sharing sidebar social toolbar widget".split())
_LAYOUT = frozenset("with has no without is".split())
_COMMENTS = re.compile(
    r"\W*(?:\d+\s+)?(?:(?:reader|user)s?\W*\s+)?(?:comments?|kommentare?|commentaires?|comentarios?|leave a (?:comment|reply)|join the (?:discussion|conversation))"
    r"\W*(?:\d+)?\W*", re.IGNORECASE)
_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
         "th": {"td", "th"}, "option": {"option"}}
_HOLDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}


@dataclass
class Block:
    """A flat run of text. ``region`` is 1 inside an article, -1 inside furniture of the page, 0 elsewhere.

    ``named`` is 1 where something around the block has a name that may be furniture's, or an ordinary section's.
    """

    text: str
    words: int
    linked: int
    region: int
    heading: int
    named: int = 0


# Regions of furniture, from the weakest sign: part of a name, a whole name or a tag, and what is not shown at all.
_PART, _WHOLE, _UNSEEN = -1, -2, -3


def _signs(attributes: str, inside: bool) -> tuple[int, bool]:
    """What the names of an element say: the region they mark, if any, and whether they only may mean one.

    A whole name is a sign, and so is a part that hardly means anything else. Of other parts, outside an article the last
    one is a sign too (``page-header``), unless it tells what a wrapper has (``with-sidebar``); the rest are doubtful.
    """
    sign, doubt = 0, False
    for kind, *quoted in _NAMED.findall(attributes):
        in_class = kind.lower() != "id"
        for name in "".join(quoted).lower().split():
            if name in _NOISE_NAMES:
                return _WHOLE, False
            parts = re.split(r"[_-]+", name)
            if _NOISE_NAMES.isdisjoint(parts):
                continue
            layout = not _LAYOUT.isdisjoint(parts)
            sure = not _SURE_PARTS.isdisjoint(parts) or in_class and not _SURE_IN_CLASS.isdisjoint(parts)
            if not layout and (sure or not inside and parts[-1] in _NOISE_NAMES):
                sign = _PART
            else:
                doubt = True
    return sign, doubt and not sign


def _kind(tag: str, attributes: str, around: int, named: int = 0) -> tuple[int, int]:
    """The region a tag opens and whether it is in doubt: its own where it has one, else as around it.

    An article within furniture is a place like others, where the tree decides; within what only bears a part of a name, and
    for the main element, it is the article itself. What is not shown stays so.
    """
    if around == _UNSEEN:
        return around, named
    own = tag in ("article", "main")
    sign = _WHOLE if tag in _NOISE_TAGS or (tag == "header" and around == 0) else 0
    if attributes and ("=" in attributes or "hidden" in attributes):
        if _HIDDEN.search(attributes):
            return _UNSEEN, named
        if tag not in ("html", "body") and (not own or around < 0):
            found, doubt = _signs(attributes, around == 1)
            sign = min(sign, found)
            named = 1 if doubt else named
    if own and sign == 0:
        return (0 if around == _WHOLE and tag == "article" else 1), 0
    return (min(sign, around) if sign or around < 0 else around), named


def _closed(page: str) -> dict[int, int]:
    """Where the elements beside the text end: start of the opening tag -> start of its closing tag."""
    waiting: dict[str, list[int]] = {}
    out: dict[int, int] = {}
    for token in _ASIDE_TAG.finditer(page):
        opened = waiting.setdefault(token.group(2).lower(), [])
        if token.group(1):
            if opened:
                out[opened.pop()] = token.start()
        elif not token.group(0).endswith("/>"):
            opened.append(token.start())
    return out


class _Open:
    """The open elements as (tag, region, named), with the places of each tag among them."""

    def __init__(self) -> None:
        self.elements: list[tuple[str, int, int]] = []
        self.at: dict[str, list[int]] = {}

    def push(self, tag: str, kind: tuple[int, int]) -> None:
        self.at.setdefault(tag, []).append(len(self.elements))
        self.elements.append((tag, *kind))

    def cut(self, size: int) -> None:
        while len(self.elements) > size:
            self.at[self.elements.pop()[0]].pop()

    def last(self, tags) -> int:
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=-1)

    def top(self) -> tuple[str, int, int]:
        return self.elements[-1] if self.elements else ("", 0, 0)


def blocks(page: str | None) -> list[Block]:
    """The text blocks of a page in order; tags may be unclosed, misnested or cut off."""
    out: list[Block] = []
    opened = _Open()
    inline_noise: list[str] = []
    parts: list[str] = []
    words = linked = links = heading = 0
    skip_to = 0
    talk = None  # the size of the stack below which a section of comments, told by its heading, ends

    def close() -> None:
        nonlocal words, linked, links, talk
        text = " ".join("".join(parts).split())
        if text:
            _tag, region, named = opened.top()
            if heading and len(text) < 60 and _COMMENTS.fullmatch(text):
                talk = min(len(opened.elements) - 1, talk if talk is not None else len(opened.elements))
            if talk is not None:
                region = -1
            out.append(Block(text, len(text.split(" ")), min(linked, words), max(-1, region), heading, named))
        parts.clear()
        words = linked = 0
        links = 0

    def say(raw: str) -> None:
        nonlocal words, linked
        if raw and not inline_noise:
            text = html.unescape(raw) if "&" in raw else raw
            n = len(text.split())
            words += n
            linked += n if links else 0
            parts.append(text)

    page = page or ""
    ends = _closed(page)
    articles = [(m.start(), m.group(1)) for m in _ARTICLE.finditer(page)]
    starts = [place for place, _ in articles]
    closers: dict[str, list[int]] = {}

    def end_of(tag: str, after: int) -> int:
        """Where the next closing tag of a kind stands, -1 without one."""
        if tag not in closers:
            closers[tag] = [m.start() for m in re.finditer(rf"</{re.escape(tag)}(?=[\s/>])", page, re.IGNORECASE)]
        k = bisect_left(closers[tag], after)
        return closers[tag][k] if k < len(closers[tag]) else -1

    at = 0
    for token in _TOKEN.finditer(page):
        if token.start() < skip_to:
            continue
        say(page[max(at, skip_to):token.start()])
        at = token.end()
        tag = token.group(2)
        if tag is None:
            continue
        tag, closing = tag.lower(), bool(token.group(1))
        if tag in _RAW:
            end = -1 if closing else end_of(tag, at)
            if end >= 0 or not closing and tag in ("script", "style", "textarea", "xmp"):
                skip_to = at = end if end >= 0 else len(page)
            continue
        holds_article = False
        if tag in _ASIDE:
            if not closing:
                end = ends.get(token.start())
                if end is None:
                    continue
                held = bisect_left(starts, at)
                if held == len(starts) or starts[held] >= end:
                    skip_to = at = end
                elif not articles[held][1]:
                    holds_article = True
            elif opened.at.get(tag):
                holds_article = True
            if not holds_article:
                continue
        if tag in _INLINE:
            if tag == "a":
                links = 0 if closing else 1
            if closing and inline_noise and inline_noise[-1] == tag:
                inline_noise.pop()
            elif not closing and tag not in _VOID and (
                    inline_noise and inline_noise[-1] == tag or _kind(tag, token.group(3), 0)[0] < 0):
                inline_noise.append(tag)
            continue
        if tag == "br":
            parts.append(" ")
            continue
        inline_noise.clear()
        close()
        if closing:
            if opened.at.get(tag):
                opened.cut(opened.at[tag][-1])
        elif tag not in _VOID:
            if opened.top()[0] == "p":
                opened.cut(len(opened.elements) - 1)
            if tag in _SAME:
                same = opened.last(_SAME[tag])
                if same > opened.last(_HOLDS.get(tag, ())):
                    opened.cut(same)
            _name, around, named = opened.top()
            opened.push(tag, (min(_WHOLE, around), named) if holds_article else _kind(tag, token.group(3), around, named))
        if talk is not None and len(opened.elements) < talk:
            talk = None
        heading = int(opened.top()[0] in ("h1", "h2", "h3", "h4", "h5", "h6"))
    if at < len(page):
        say(page[max(at, skip_to):])
    close()
    return out


FEATURES = ("region", "words", "linked", "words_before", "linked_before", "words_after", "linked_after", "heading", "named")
# The labelled table: a row for each block seen, its features as above, and 1 for article text.
LABELLED = """
 1  40 0.00  12 0.00  35 0.00 0 0 1
 1   3 0.00  60 0.00   8 0.00 0 0 1
 1   1 0.00   2 0.00   2 0.00 0 0 1
 1  10 0.00  14 0.00  10 0.00 1 0 1
 1  10 0.00  10 0.00  50 0.00 0 0 1
 1   4 0.00   6 1.00   9 0.00 1 0 1
 1   9 0.00   4 0.00  12 0.05 0 0 1
 1 180 0.02  60 0.00   4 0.00 0 0 1
 1  60 0.10   5 0.00  40 0.00 0 0 1
 1  12 0.25  30 0.00  22 0.00 0 0 1
 1   8 0.40  40 0.00  31 0.00 0 0 1
 1   5 0.00  80 0.00   0 0.00 0 0 1
 1   2 0.00   0 0.00   0 0.00 1 0 1
 1   6 0.50  25 0.00  25 0.00 0 0 1
 1   3 1.00  20 0.00   4 1.00 0 0 0
 1   4 1.00   3 1.00   5 1.00 0 0 0
 1   2 1.00   4 1.00   0 0.00 0 0 0
 1   6 1.00  90 0.00   3 1.00 0 0 0
-1   6 1.00   0 0.00   5 1.00 0 0 0
-1   1 1.00   1 1.00   1 1.00 0 0 0
-1  12 0.00   1 1.00   9 0.00 0 0 0
-1   9 0.00  40 0.00   0 0.00 0 0 0
-1  60 0.00  50 0.00  30 0.00 0 0 0
-1  25 0.10  33 0.00  12 0.00 0 0 0
-1   3 0.00   8 0.00   2 0.00 1 0 0
-1 120 0.00  20 0.00  45 0.00 0 0 0
-1   2 0.00   0 0.00  70 0.00 1 0 0
-1  30 0.50   4 1.00   6 1.00 0 0 0
 0  45 0.00  30 0.00  50 0.00 0 0 1
 0  22 0.05   9 0.00  41 0.00 0 0 1
 0  90 0.02   2 1.00  12 0.00 0 0 1
 0  31 0.20  28 0.00   3 1.00 0 0 1
 0  17 0.00  60 0.00   0 0.00 0 0 1
 0   8 0.00  44 0.00  52 0.00 0 0 1
 0   5 0.00  35 0.00  26 0.10 0 0 1
 0  11 0.00  70 0.00  18 0.00 0 0 1
 0   7 0.00   2 1.00  38 0.00 1 0 1
 0   4 0.00   6 0.00  55 0.00 1 0 1
 0   9 0.00  30 0.00  33 0.00 1 0 1
 1  25 0.00  30 0.00   2 1.00 0 0 1
 1   4 0.00  50 0.00   3 1.00 0 0 1
 1  12 0.10   2 1.00   1 1.00 0 0 1
 1  70 0.05   6 1.00   5 1.00 0 0 1
 1   7 0.00   1 1.00  20 0.00 1 0 1
 1   2 0.00  11 0.00   4 0.90 0 0 1
 1  33 0.00  27 0.00   1 1.00 0 0 1
 1   9 0.00   0 0.00   2 1.00 0 0 1
 1  15 0.30   8 0.80   6 0.75 0 0 1
 1   1 0.00  16 0.00   6 0.60 0 0 1
 1  44 0.00   3 0.00  12 0.80 0 0 1
 1   6 0.00   2 0.00   1 0.00 0 0 1
 1   5 0.00   0 0.00   0 0.00 0 0 1
-1   3 0.00   4 0.00   5 0.00 0 0 0
-1  16 0.00  90 0.00  80 0.00 0 0 0
-1   7 0.00   7 0.00  60 0.00 0 0 0
-1  40 0.00  12 0.00   0 0.00 0 0 0
-1   8 0.00  10 0.00  11 0.00 0 0 0
-1  20 0.00   0 0.00  25 0.00 0 0 0
-1  75 0.02  66 0.00  58 0.00 0 0 0
-1   5 0.00  45 0.00  40 0.00 1 0 0
-1  11 0.20  14 0.00   9 0.00 0 0 0
-1   2 0.00   2 0.00   2 0.00 0 0 0
-1  50 0.00   1 1.00   3 1.00 0 0 0
 0  25 0.00   0 0.00   0 0.00 0 0 1
 0  60 0.00   0 0.00   0 0.00 0 0 1
 0  36 0.00   3 1.00   2 1.00 0 0 1
 0  50 0.10   8 0.90   5 1.00 0 0 1
 0  28 0.00   4 1.00   6 0.00 0 0 1
 0   6 1.00   4 1.00   5 1.00 0 0 0
 0   1 1.00   0 0.00   1 1.00 0 0 0
 0   3 1.00  50 0.00   2 1.00 0 0 0
 0  14 0.90   3 1.00   4 1.00 0 0 0
 0  24 0.80   6 1.00   8 0.70 0 0 0
 0  40 0.75  10 0.90   9 1.00 0 0 0
 0   3 0.00   2 1.00   2 1.00 0 0 0
 0   5 0.00   1 1.00   3 0.00 0 0 0
 0   8 0.00   3 0.00   2 0.00 0 0 0
 0   6 0.50   5 0.00   4 1.00 0 0 0
 0   4 0.00   7 1.00   3 1.00 1 0 0
 0   9 0.00   4 1.00   5 0.00 0 0 0
 0   2 0.00   3 0.00   1 1.00 0 0 0
 1   3 0.00   0 0.00  40 0.00 1 1 1
 1   7 0.00   4 1.00   5 0.60 1 1 1
 1   2 0.00  60 0.00  45 0.00 1 1 1
 1  45 0.00   2 0.00  50 0.00 0 1 1
 1  14 0.05  50 0.00   6 0.00 0 1 1
 1   9 0.00   3 0.00  12 0.00 0 1 1
 1  80 0.20   6 0.00   0 0.00 0 1 1
 1  20 0.30  70 0.10   9 0.00 0 1 1
 1   4 1.00   2 0.00   5 1.00 0 1 0
 1   6 1.00   5 1.00   0 0.00 0 1 0
 1   5 0.55   4 1.00   7 0.80 0 1 0
 1  12 0.80  60 0.00   8 1.00 0 1 0
 1   8 0.60   3 0.00   4 1.00 0 1 0
 0  50 0.00   0 0.00  40 0.00 0 1 1
 0  90 0.05  40 0.00  30 0.00 0 1 1
 0  30 0.10  60 0.00  55 0.00 0 1 1
 0  16 0.00  80 0.00  70 0.00 0 1 1
 0   6 0.00   0 0.00  50 0.00 1 1 1
 0   5 1.00   4 1.00   6 1.00 0 1 0
 0   3 0.00   2 1.00   4 1.00 0 1 0
 0  10 0.70   5 1.00   3 1.00 0 1 0
 0   4 0.00   0 0.00   3 1.00 0 1 0
"""


def labelled_table(text: str = LABELLED) -> tuple[np.ndarray, np.ndarray]:
    rows = np.array([line.split() for line in text.split("\n") if line.strip()], dtype=np.float64)
    return rows[:, :-1], rows[:, -1].astype(int)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 8):
    """A tree as ``(feature, threshold, below, above)``, or the class of a leaf; splits by least Gini impurity."""
    share = y.mean()
    if depth == 0 or share in (0.0, 1.0):
        return int(share >= 0.5)
    best = None
    for k in range(x.shape[1]):
        values = np.unique(x[:, k])
        for at in (values[1:] + values[:-1]) / 2:
            low = y[x[:, k] < at]
            high = y[x[:, k] >= at]
            impure = len(low) * low.mean() * (1 - low.mean()) + len(high) * high.mean() * (1 - high.mean())
            if best is None or impure < best[0] - 1e-12:
                best = (impure, k, float(at))
    if best is None:
        return int(share >= 0.5)
    _impure, k, at = best
    low = x[:, k] < at
    return k, at, grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1)


def decide(tree, row) -> int:
    while not isinstance(tree, int):
        k, at, below, above = tree
        tree = below if row[k] < at else above
    return tree


def main_text(page: str | None, tree) -> str:
    """The article's blocks joined by one space; empty without any."""
    found = blocks(page)
    ends = [(0, 0.0), *((b.words, b.linked / b.words if b.words else 0.0) for b in found), (0, 0.0)]
    return " ".join(
        b.text for k, b in enumerate(found)
        if decide(tree, (b.region, *ends[k + 1], *ends[k], *ends[k + 2], b.heading, b.named)))


def extracted(pages: DataFrame, labelled: str = LABELLED) -> DataFrame:
    """Per row ``page_id``, ``url``, ``text`` (empty if none) and ``n_chars``, its code points.

    Null and empty pages have empty text; repeated rows each get theirs; other columns are ignored; no rows give no rows.
    """
    tree = grow(*labelled_table(labelled))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py(), tree) for h in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return rows.mapInArrow(extract, "page_id bigint, url string, text string, n_chars bigint")
