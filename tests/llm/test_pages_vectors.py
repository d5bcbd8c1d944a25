"""URL filters, page text, personal data, vectors, components and the pipeline against plain reckonings."""

from __future__ import annotations

import contextlib
import hashlib
import io
import itertools
import math
import random
import re
import time
from collections import defaultdict

import numpy as np
import pytest
import regex as letters
from compare import connect, differences
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from formspark.llm import embed_dedup, graph, html_blocks, pii, queries, quality, urls

SMALL = "/root/testdata/sf0.001"


def plan_of(frame) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        frame.explain("formatted")
    return out.getvalue()


def ordered(found):
    return sorted((tuple(r) for r in found), key=str)


# URLs ----------------------------------------------------------------------------------------------------------------------

def brute_url(url, rules=urls.RULES):
    rest = url.split("://", 1)[1] if url is not None and "://" in url else ""
    host = re.sub("[A-Z]", lambda m: m[0].lower(), re.match(r"[^/?#]*", rest)[0])
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    fits = [(len(h + p), len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


URLS = [
    None, "", "no scheme", "://", "http://", "http://com/en/", "http://EXAMPLE.com/en/7?x#y", "http://www.example.com/en/71",
    "http://notexample.com/en/7", "https://a.b.example.net/de/8", "https://a.b.example.net/de/9", "http://x.net", "http://x.org/es/?q",
    "http://x.org?/es/", "http://x.org#/es/", "a://b://c/en/", "http://.com/en/", "http://com./en/", "http://example.com:80/en/7",
    "http://x.com/en/\n7", "http://" + "a." * 5000 + "com/en/" + "p/" * 5000, "http://x.org/ES/", "http://é.org/es/ü",
]


def test_urls_match_brute_force(spark):
    found = [(i, u, "x", "y", "z") for i, u in enumerate([*URLS, *URLS[:8]])]
    pages = spark.createDataFrame(found, "page_id bigint, url string, host string, rule string, head string")
    got = urls.judged(pages).collect()
    assert ordered(got) == ordered((i, *brute_url(u)) for i, u, *_ in found)
    assert urls.judged(pages.limit(0)).count() == 0
    assert urls.judged(pages, rules=()).filter("verdict <> 'allow' OR rule IS NOT NULL").count() == 0


def test_url_verdicts_are_those_of_the_contract(spark):
    """Written out from the contract, not taken from the module's own rules."""
    want = {
        "http://x.com/en/1": ("com/en/", "block"), "http://example.com/en/71": ("example.com/en/7", "allow"),
        "http://x.net/de/1": ("net/de/", "allow"), "http://a.example.net/de/9": ("net/de/", "allow"),
        "http://a.example.net/de/8": ("example.net/de/8", "block"), "http://x.org/es/": ("org/es/", "block"), "http://x.org/de/": (None, "allow"),
    }
    pages = spark.createDataFrame(list(enumerate(want)), "page_id bigint, url string")
    got = {tuple(r) for r in urls.judged(pages).select("page_id", "rule", "verdict").collect()}
    assert got == {(i, *v) for i, v in enumerate(want.values())}


def test_native_operators_run_no_python(spark):
    for name in ("op6_url_filter", "op7_pii"):
        plan = plan_of(queries.QUERIES[name](spark, SMALL))
        assert not re.search("Python|Pandas|MapInArrow|ArrowEval", plan)


# Pages ---------------------------------------------------------------------------------------------------------------------

PAGES = {
    "<html><head><title>T</title><style>p{}</style></head><body><nav><a href=x>Home</a></nav><article><h1>Title</h1><p>A&amp;B  c<br>d"
    "<p>Last</article><footer>foot</footer>": "Title A&B c d Last",
    None: "", "": "", "<": "<" * 0, "<script>var a = '</p>'": "", "<article>no end": "no end",
    "<body><header><h1>Site</h1></header><main><h1>Head</h1><p>one &lt; two</p><div class='comments'><p>I think so too, and I write it down "
    "here.</p></div><aside>side</aside><form><p>Your mail</p></form></main>": "Head one < two",
    "<article><p>x &#233;&eacute;&#x1F600;</p><script>document.write('<p>no</p>')</script><p>y</p></article>": "x éé😀 y",
    "<article><div class=\"ad\">Buy</div><p>" + "word " * 20000 + "</p></article>": " ".join(["word"] * 20000),
    "<article><p>a <span class=\"sponsored\">buy this</span>b</p><!-- <p>no</p> --></article>": "a b",
    "<div id=cookie-notice>We use cookies on this site to make it better for all of you who come here.</div><p>"
    + "text " * 30 + "</p>": " ".join(["text"] * 30),
}


def test_page_texts(spark):
    found = [(i, f"u{i}", p, "x", 3) for i, p in enumerate(PAGES)]
    pages = spark.createDataFrame([*found, found[0]], "page_id bigint, url string, html string, text string, n_chars int")
    got = html_blocks.extracted(pages).collect()
    want = list(PAGES.values())
    assert len(got) == len(found) + 1
    for r in got:
        assert (r["text"], r["n_chars"]) == (want[r["page_id"]], len(want[r["page_id"]]))
    assert html_blocks.extracted(pages.limit(0)).count() == 0


WHOLE = {
    "<svg class=i /><article><svg/><p>one two</p><svg><path d=x /><text>label</text></svg><p>three</p></article><svg></svg>": "one two three",
    "<article><button>Go<p>one two</p><select><p>three</p><object data=x><p>four</p></article><footer>x</footer>": "Go one two three four",
    "<article><p>one</p><button><div>Buy</div></button><object><p>none</p></object><p>two</p></article>": "one two",
    "<article><p>a <button>A</p><p>b</p></article><form><button>B</button></form>": "a A b",
    "<body><div class='page with-sidebar'><article><p>one two</p></article><p>side</p></div>": "one two",
    "<div class='header-fixed'><main><p>one two</p><div class=ad>Buy</div></main></div>": "one two",
    "<div class=sidebar><article><p>" + "word " * 60 + "</p></article><p>side</p></div>": " ".join(["word"] * 60),
    "<div hidden class=sidebar><article><p>" + "word " * 60 + "</p></article></div>": "",
    "<div class=comments><article class=comment><p>" + "word " * 60 + "</p></article></div>": "",
    "<object><article><p>" + "word " * 60 + "</p></article>none</object><main><p>two</p></main>": " ".join(["word"] * 60) + " two",
    "<article><p>one</p><script>var x = '<p>no</p>'</script><p>two</p><style>p{}": "one two",
}


def test_pages_lose_no_article_to_what_stands_beside(spark):
    pages = spark.createDataFrame([(i, "u", p) for i, p in enumerate(WHOLE)], "page_id bigint, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_blocks.extracted(pages).collect()}
    assert [got[i] for i in range(len(WHOLE))] == list(WHOLE.values())


def text_of(page):
    return html_blocks.main_text(page, html_blocks.grow(*html_blocks.labelled_table()))


def body(n):
    return " ".join(["word"] * n)


NAMED = {
    f'<article><header class="entry-header"><h1>The Title</h1></header><p>{body(30)}</p></article>': f"The Title {body(30)}",
    f'<article><p>{body(30)}</p><section class="related-work" id="related-work"><h2>Related work</h2><p>{body(12)}</p></section></article>':
        f"{body(30)} Related work {body(12)}",
    f'<article><p>{body(30)}</p><section id="market-share"><p>{body(9)}</p></section></article>': f"{body(30)} {body(9)}",
    f'<article><p>{body(30)}</p><div class="related-posts"><ul><li><a href=x>one two</a><li><a href=y>four</a></ul></div></article>': body(30),
    f'<article><p>{body(30)}</p><div class="user-reviews"><p>{body(25)}</p></div></article>': body(30),
    f'<article><p>{body(30)}</p><div class="comment-list"><p>{body(25)}</p></div></article>': body(30),
    f'<article><p>{body(30)}</p><div class="x1"><h3>3 Comments</h3><p>{body(25)}</p></div><p>last one here</p></article>': f"{body(30)} last one here",
    f'<article><p>{body(30)}</p><div><h4>Leave a reply</h4></div><h2>Comments on the law</h2><p>{body(9)}</p></article>':
        f"{body(30)} Comments on the law {body(9)}",
    f'<div class="wrap with-sidebar"><div class="content has-menu"><p>{body(50)}</p></div></div>': body(50),
    f'<div class="page-header"><p>{body(50)}</p></div><div class=c><p>{body(40)}</p></div>': body(40),
    f'<article><p>a <3 b</p><p title="x > y < z">{body(9)}</p><p class="c>{body(4)}</p><p>end of it</p></article>': f"a <3 b {body(9)} {body(4)} end of it",
}


def test_names_that_may_be_an_articles_own():
    for page, want in NAMED.items():
        assert text_of(page) == want, page


LONG = {
    "tags without end": "<a " * 333_000, "tags ended in quotes": "<a " * 333_000 + "'>'", "nested": "<div>" * 200_000,
    "stray ends": "<div>" * 50_000 + "</p>" * 200_000, "ends of others": "<p>" * 6_000 + "</div>" * 160_000, "quotes": "<a \"" * 250_000,
    "both quotes": "<a '\"" * 200_000, "frames": "<iframe>" * 125_000, "scripts": "<script>" * 125_000, "icons": "<svg>" * 200_000,
    "objects": "<object>" * 50_000 + "<article>x</article>" + "</object>" * 50_000, "items": "<ul>" + "<div>" * 50_000 + "<li></li>" * 100_000,
    "cells": "<div>" * 50_000 + "<td></td>" * 100_000, "comments": "<!--" * 250_000, "bangs": "<!" * 500_000, "less": "<" * 1_000_000,
    "references": "&amp;" * 200_000, "inline": "<b class=ad>" * 80_000, "paragraphs": "<p>x" * 250_000, "a long name": '<div class="' + "a-" * 500_000 + '">',
}


@pytest.mark.parametrize("kind", LONG)
def test_long_pages_take_linear_time(kind):
    """A megabyte takes a second or so; what grows with the square would take minutes."""
    began = time.process_time()
    text_of(LONG[kind])
    assert time.process_time() - began < 12


def test_pages_of_the_tables(spark):
    """On pages with one article, its words and nothing else."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    texts = {r["page_id"]: r["text"] for r in html_blocks.extracted(pages).collect()}
    import html

    for r in pages.collect():
        inside = re.search(r"<article>(.*?)</article>", r["html"], re.DOTALL)[1]
        assert texts[r["page_id"]] == " ".join(html.unescape(re.sub(r"<[^>]+>", " ", inside)).split())


def test_the_tree_learns_its_table():
    x, y = html_blocks.labelled_table()
    tree = html_blocks.grow(x, y)
    assert all(html_blocks.decide(tree, row) == label for row, label in zip(x, y))


# Personal data ---------------------------------------------------------------------------------------------------------------

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def brute_personal(text):
    out = []
    for k, (kind, rule) in enumerate(BASE.items()):
        for m in re.finditer(rule, text or "", re.ASCII):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return [s for *_, s in sorted(out)]


def test_personal_data_matches_brute_force(spark):
    random.seed(6)
    parts = ["a@b.c", "x.y_z", "@", ".", "ex.com", "-", " ", "é", "日", "\n", "+1", "(", ")", "555", "1.2.3.4", "255", "256.", "0001", "4111 1111 1111 1111",
             "4444-4444", "4468566586596931", "9", "+", "word", "_", "%", "+1 (168) 555-5254"]
    found = [(i, "".join(random.choice(parts) for _ in range(random.randint(0, 25))), "x") for i in range(1500)]
    found += [(3000, None, "x"), (3001, "", "x"), (3002, "1" * 100000, "x"), (3003, "a" * 50000 + " a.b" * 5000, "x"), (None, "a@b.c", "x"), found[0],
              (3004, "x@" + "a." * 20000 + "b", "x"), (3005, "1.2.3.4 " * 400, "x")]
    docs = spark.createDataFrame(found, "doc_id bigint, text string, mark string").repartition(6)
    got = pii.personal_report(docs).collect()
    assert len(got) == len(found)
    want = {i: brute_personal(t) for i, t, _ in found}
    for r in got:
        spans = want[r["doc_id"]]
        assert r["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in BASE] == [sum(s.startswith(k) for s in spans) for k in BASE]
        assert [s for s in r["spans"].split(",") if s and not s.startswith("term")] == spans
    assert pii.personal_report(docs.limit(0)).count() == 0


def test_revealing_terms_become_spans(spark):
    """A name that stands beside one address only, in several contexts, gives it away; common words do not."""
    found = [(i, f"note{chr(97 + i)} from Quibbleton at q.b@mail.example said hello{chr(97 + i)} again", "x") for i in range(6)]
    found += [(100 + i, f"again from said and at with plain words {i}", "x") for i in range(60)]
    docs = spark.createDataFrame(found, "doc_id bigint, text string, mark string")
    out = {r["doc_id"]: r for r in pii.personal_report(docs).collect()}
    for i in range(6):
        at = found[i][1].index("Quibbleton")
        assert f"term:{at}:{at + 10}" in out[i]["spans"].split(",") and out[i]["n_term"] == 1
    assert all(out[100 + i]["spans"] == "" for i in range(60))
    clean = {r["doc_id"]: r["clean_text"] for r in pii.sanitised(docs).collect()}
    assert set(clean) == set(range(6))
    assert clean[0] == "notea from  at [email] said helloa again"


def test_terms_beside_an_entity_of_one_context_are_weighed(spark):
    """An entity of one document has terms too; a rare word beside an entity of many documents may be chance."""
    found = [(0, "report from Quibbleton Zarvox at q.b@mail.example about invoices", "x"), (1, "call me with +1 555 555 5555 soon", "x")]
    found += [(100 + i, f"plain report from about with call soon invoices at 10.0.0.1 rare{chr(97 + i % 26) * (1 + i // 26)}", "x") for i in range(60)]
    docs = spark.createDataFrame(found, "doc_id bigint, text string, mark string")
    out = {r["doc_id"]: r for r in pii.personal_report(docs).collect()}
    spans = [s for s in out[0]["spans"].split(",") if s.startswith("term")]
    assert spans == ["term:12:22", "term:23:29"]
    assert all(r["n_term"] == 0 for i, r in out.items() if i)
    alone = {r["doc_id"]: r for r in pii.personal_report(docs.limit(1)).collect()}
    assert alone[0]["n_term"] == 0


def test_words_beside_an_entity(spark):
    """Five whole words to each side, however few or long they are, those of earlier matches among them."""
    long = "w" * 300
    texts = ["Jane Doe jane@x.org", "Jane Doe <jane@x.org>, John Roe <john@x.org>", f"one two {long} three four five a@b.c six", "a@b.c", "é 1a@b.c",
             "one two three four five six a@b.c seven eight nine ten eleven twelve"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").select(pii.base_spans(F.col("text")).alias("b"))
    got = [[(s["before"], s["after"]) for s in r["b"]] for r in frame.collect()]
    assert got == [
        [(["Jane", "Doe"], [])],
        [(["Jane", "Doe"], ["John", "Roe", "john", "x", "org"]), (["jane", "x", "org", "John", "Roe"], [])],
        [(["two", long, "three", "four", "five"], ["six"])], [([], [])], [(["é"], [])],
        [(["two", "three", "four", "five", "six"], ["seven", "eight", "nine", "ten", "eleven"])]]


def brute_terms(texts):
    """Per text its term spans: every pair of an entity and a word beside it weighed by counts of documents over all texts."""
    words = lambda t: [w for w in letters.split(r"[^\p{L}]+", t) if len(w) >= 4]
    every = lambda t: [w for w in letters.split(r"[^\p{L}]+", t) if w]
    spans = [[(k, int(a), int(z)) for k, a, z in (x.split(":") for x in brute_personal(t))] for t in texts]
    holds, near, said = defaultdict(set), defaultdict(set), defaultdict(set)
    for i, text in enumerate(texts):
        for word in words(text):
            said[word].add(i)
        for kind, a, z in spans[i]:
            entity = (kind, text[a:z])
            holds[entity].add(i)
            for word in every(text[:a])[-5:] + every(text[z:])[:5]:
                if len(word) >= 4:
                    near[entity, word].add(i)
    total = len(texts)

    def unlikely(both, draws, share):
        missed = (draws - both) * math.log((draws - both) / (draws * (1 - share))) if draws > both and share < 1 else 0.0
        return both * math.log(both / (draws * share)) + missed

    given = defaultdict(set)
    for (entity, word), docs in near.items():
        both, term, held = len(docs), len(said[word]), len(holds[entity])
        content = math.log(total / held)
        pmi = math.log(both * total / (term * held))
        least = max(unlikely(both, term, held / total), unlikely(both, held, term / total))
        if content > 0 and pmi / content >= 0.9 and least >= -math.log(0.05):
            given[entity].add(word)
    out = []
    for text, base in zip(texts, spans):
        told = {w for kind, a, z in base for w in given[kind, text[a:z]]}
        found = [(m.start(), m.end()) for m in letters.finditer(r"\p{L}+", text) if m[0] in told]
        out.append([f"term:{a}:{z}" for a, z in found if not any(a < bz and ba < z for _k, ba, bz in base)])
    return out


def test_terms_match_brute_force(spark):
    random.seed(11)
    plain = ["report", "about", "from", "with", "call", "soon", "plain", "words", "the", "of", "é"]
    people = [(f"Name{chr(97 + k)}é", f"Town{chr(97 + k)}", random.choice([f"n{k}@mail.example", f"10.0.{k}.1", f"+1 555 555 55{k:02d}"])) for k in range(20)]
    texts = []
    for _ in range(400):
        parts = random.choices(plain, k=random.randint(0, 9))
        for name, town, value in random.sample(people, random.choice([0, 0, 1, 1, 2])):
            parts += random.choices([name, town, value, "and", *plain[:3]], weights=[4, 2, 5, 1, 1, 1, 1], k=5)
        texts.append(" ".join(parts))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    got = {r["doc_id"]: [s for s in r["spans"].split(",") if s.startswith("term")] for r in pii.personal_report(docs).collect()}
    want = brute_terms(texts)
    assert sum(map(len, want)) > 100
    assert [got[i] for i in range(len(texts))] == want


def test_running_sums(spark):
    random.seed(1)
    rows = [([random.randrange(9) for _ in range(n)],) for n in (0, 1, 2, 511, 512, 513, 1024, 1025, 5000)]
    for r in spark.createDataFrame(rows, "a array<int>").select("a", pii._running(F.col("a")).alias("s")).collect():
        assert r.s == list(itertools.accumulate(r.a))


def test_a_text_of_very_many_numbers(spark):
    """Every number is a match to be looked at; a hundred thousand once took minutes."""
    docs = spark.createDataFrame([(1, "12, " * 100_000 + "a@b.co")], "doc_id bigint, text string")
    began = time.time()
    row = pii.personal_report(docs).first()
    assert row["n_email"] == 1 and row["spans"] == "email:400000:400006"
    assert time.time() - began < 90


# Vectors -----------------------------------------------------------------------------------------------------------------------

def brute_vectors(found, threshold=0.95):
    good = [k for k, (i, v) in enumerate(found) if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = {k: np.array(found[k][1], dtype=np.float32).astype(np.float64) for k in good}
    unit = {k: v / np.linalg.norm(v) for k, v in unit.items()}
    near, parent = defaultdict(set), {k: k for k in range(len(found))}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in good:
        for b in good:
            if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold:
                near[a].add(b)
                near[b].add(a)
                parent[root(b)] = root(a)
    least = {}
    for k, (i, _) in enumerate(found):
        least[root(k)] = min([least.get(root(k)), i], key=lambda x: (x is None, x))
    return [(i, len(near[k]), least[root(k)], i is None or i == least[root(k)]) for k, (i, _) in enumerate(found)]


def vectors(n=300, d=16):
    random = np.random.default_rng(5)
    centres = random.normal(size=(20, d))
    out = [(int(i), (centres[i % 20] + random.normal(size=d) * random.choice([0.02, 0.25, 0.6])).tolist()) for i in range(n)]
    out += [(1000 + i, out[3][1]) for i in range(40)]
    out += [(2000, None), (2001, []), (2002, [0.0] * d), (2003, [float("nan")] * d), (2004, [None, *[1.0] * (d - 1)]), (2005, [float("inf")] * d),
            (2006, [1.0, 2.0]), (2007, [1.0, 2.0]), out[5], (None, out[5][1]), (2008, (-np.array(out[3][1])).tolist())]
    return out


@pytest.mark.parametrize("tile_rows", [4096, 20])
def test_vectors_match_brute_force(spark, tile_rows):
    found = vectors()
    frame = spark.createDataFrame([(i, v, 0, "r") for i, v in found], "vec_id bigint, embedding array<float>, n_links int, root string").repartition(4)
    assert ordered(embed_dedup.near_vectors(frame, tile_rows=tile_rows).collect()) == ordered(brute_vectors(found))
    assert embed_dedup.near_vectors(frame.limit(0)).count() == 0
    few = frame.filter("vec_id = 2000 OR vec_id = 3")
    assert ordered(embed_dedup.near_vectors(few).collect()) == [(2000, 0, 2000, True), (3, 0, 3, True)]


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 200)] + [(300, 300), (5, 4), (5, 4), (-7, -9), (None, 1), (2, None)]
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 200)}, 300: 300, -7: -9, -9: -9}
    assert got == want
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# Queries and pipeline ------------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_match_sql(spark, name):
    assert differences(driver.queries()[name](spark, SMALL), connect(SMALL), driver.oracle_sql()[name]) is None


def test_every_operator_is_registered():
    names = [n for n in driver.queries() if n.startswith("op")]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14)) and "pipeline" in driver.queries()


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    kept = [docs]
    for _name, stage in corpus_pipeline.STAGES:
        kept.append(stage(spark, kept[-1], SMALL).cache())
        assert kept[-1].columns[:len(columns)] == columns
    from formspark.llm import decontam, lines, simhash

    ids = [sorted(r["doc_id"] for r in k.select("doc_id").collect()) for k in kept]
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    good = quality.scored(docs, quality.train(docs, labels)).filter("predicted = 1")
    assert ids[1] == sorted(r["doc_id"] for r in good.collect())
    assert ids[2] == ids[1]
    dropped = {r["doc_id"]: r["kept_sha256"] for r in lines.line_report(kept[1]).collect()}
    assert dropped == {r["doc_id"]: hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in kept[2].collect()}
    assert ids[3] == sorted(r["component_id"] for r in simhash.near_duplicates(kept[2]).select("component_id").distinct().collect())
    clean = decontam.hits(kept[3], spark.read.parquet(f"{SMALL}/benchmark.parquet")).filter("NOT contaminated")
    assert ids[4] == sorted(r["doc_id"] for r in clean.collect())
    assert ids[5] == ids[4]
    whole = corpus_pipeline.run(spark, SMALL)
    assert ordered(whole.collect()) == ordered(kept[5].collect())
    assert sorted(r["mix_position"] for r in whole.collect()) == list(range(len(ids[5])))


def test_pipeline_of_no_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        assert docs.count() == 0


def test_pipeline_of_awkward_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = docs.limit(3).unionByName(docs.limit(3)).unionByName(docs.limit(2).withColumns({c: F.lit(None).cast(t) for c, t in docs.dtypes}))
    for _name, stage in corpus_pipeline.STAGES:
        odd = stage(spark, odd, SMALL).cache()
        odd.count()
