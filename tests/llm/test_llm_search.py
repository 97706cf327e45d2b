"""Hard-negative mining, HTML extraction and lexical search on hard cases, against brute force."""

import html as html_lib
import math
import random
import re
from collections import Counter
from html.parser import HTMLParser

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from tidemark.llm import hard_negatives as H
from tidemark.llm import html_extraction as X
from tidemark.llm import lexical_search as L
from tidemark.llm import registry

# ------------------------------------------------------------- hard negatives


def vectors():
    rnd = random.Random(7)
    rows = [(k, [rnd.gauss(0, 0.3) for _ in range(6)], k % 3) for k in range(300)]
    rows += [(k, list(rows[k % 40][1]), k % 3) for k in range(300, 380)]  # ties
    rows += [(20, list(rows[20][1]), 2), (20, list(rows[20][1]), 2), (21, [9.0], 0), (400, [], 1), (401, [0.5, 0.5], 1), (405, [0.0] * 6, 0),
             (402, [1e9, -1e9] + [0.0] * 4, 2), (None, [1.0] * 6, 1), (403, None, 1), (404, [1.0] * 6, None), (406, [float("nan")] + [1.0] * 5, 1),
             (407, [float("inf")] + [1.0] * 5, 1), (408, [None] + [1.0] * 5, 1)]
    return [(i, v, c, 1, 2, "x", k) for k, (i, v, c) in enumerate(rows)]


VECTORS = "`ve.c id` bigint, vector array<double>, label int, shard int, id int, `is_anchor` string, `a.b` int"


def mined(rows, k=5, n=10, low=30, high=90):
    live = {}
    for i, v, c, *_ in rows:
        if i is None or v is None or c is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = [int(max(-H.BOUND, min(H.BOUND, math.floor(256 * x)))) for x in v]
        live[i] = min(live.get(i, (c, whole)), (c, whole))
    out = set()
    for a, (label, anchor) in live.items():
        if a % 20:
            continue
        ranked = sorted((-sum(x * y for x, y in zip(anchor, v)), i, c) for i, (c, v) in live.items() if i != a)
        for s, p, _ in [x for x in ranked if x[2] == label][:k]:
            fit = [x for x in ranked if x[2] != label and low * -s <= 100 * -x[0] <= high * -s][:n]
            out |= {(a, p, r + 1, i, -s, -t) for r, (t, i, _) in enumerate(fit)}
    return out


@pytest.mark.parametrize("shard_rows,slice_anchors", [(1 << 16, 20_000), (40, 5)])
def test_hard_negatives(spark, monkeypatch, shard_rows, slice_anchors):
    monkeypatch.setattr(H, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(H, "SLICE_ANCHORS", slice_anchors)
    df = spark.createDataFrame(vectors(), VECTORS).repartition(3)
    got = [tuple(r) for r in H.hard_negatives(df, F.col("`ve.c id`") % 20 == 0, "ve.c id", "vector").collect()]
    assert len(got) == len(set(got)) and set(got) == mined(vectors())


def test_hard_negatives_of_nothing(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert H.hard_negatives(empty, F.lit(True), "ve.c id", "vector").count() == 0
    none = spark.createDataFrame(vectors(), VECTORS)
    assert H.hard_negatives(none, F.lit(None).cast("boolean"), "ve.c id", "vector").count() == 0


def test_search_ends_before_all_rows_are_read():
    import numpy as np
    rng = np.random.default_rng(3)
    vectors = rng.integers(0, 40, (5000, 3))
    vectors[:30] = 500 + rng.integers(0, 40, (30, 3))
    lists = H.SortedLists(np.arange(5000), np.zeros(5000, np.int64), vectors)
    read = 0
    reads = lists.reads

    def counted(anchor):
        nonlocal read
        for new, scores, threshold in reads(anchor):
            read += len(new)
            yield new, scores, threshold
    lists.reads = counted
    [(rows, scores)] = H.first_rows(lists, np.array([3, 2, 1]), np.ones(5000, bool), [(-np.inf, np.inf)], 5)
    want = sorted(((-int(v @ [3, 2, 1]), k) for k, v in enumerate(vectors)))[:5]
    assert [(-s, r) for r, s in zip(rows.tolist(), scores.tolist())] == want and read < 500


# ---------------------------------------------------------------- HTML extraction

LONG = "The man and the woman of the house were in the garden with a dog, and it was one of the best days that they had."
NOISE = "zzkrp vlorx mnnt qwep lkjsd vvbnt opwq rtyzz ghfl zxcvb nmkl poiuy trewq asdfg hjkl zxcv bnmq wert yuio"


class Text(HTMLParser):
    """Brute force for pages with one article: all text inside it."""

    def __init__(self):
        super().__init__()
        self.on, self.out = 0, []

    def handle_starttag(self, tag, attrs):
        self.on += tag == "article"
        self.out.append(" " if tag not in ("b", "a", "i", "em") else "")

    def handle_endtag(self, tag):
        self.on -= tag == "article"
        self.out.append(" " if tag not in ("b", "a", "i", "em") else "")

    def handle_data(self, data):
        self.out.append(data if self.on else "")


def test_articles_come_out_whole(spark):
    got = registry.QUERIES["op12_html_extraction"](spark, SF001).collect()
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF001}/pages.parquet").collect()}
    assert len(got) == len(pages)
    for r in got:
        parser = Text()
        parser.feed(pages[r.page_id].html)
        parser.close()
        assert r.text == " ".join("".join(parser.out).split()) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


@pytest.mark.parametrize("page,want", [
    (None, ""), ("", ""), ("   \n", ""), ("<script>var a = '<p>" + LONG + "</p>'", ""), ("<!-- " + LONG, ""), ("<style>x</style><p>" + LONG, LONG),
    (f"<p>{LONG}<br>{LONG}</p>", LONG + " " + LONG),
    (f"<div><h2>Head</h2><p>{LONG}</p><p>Yes.</p><p>{LONG}</div>", f"Head {LONG} Yes. {LONG}"),
    (f"<ul><li><a href=/a>One</a></li></ul><p>Short</p><p><a href=/b>Two</a></p><p>{LONG}</p>", LONG),  # short text among links goes with them
    (f"<p>{NOISE}</p><p>{LONG}</p>", LONG), (f"<article><p>{NOISE}</p><p>{LONG}</p></article>", f"{NOISE} {LONG}"),
    (f"<nav><ul><li>{LONG}</ul><article><h1>T</h1><p>{LONG}</p></article><p>{LONG}</p>", f"T {LONG}"),
    (f"<main><article><header><h1>T</h1></header><p>{LONG}<aside>{LONG}</aside><p>ok<form><p>{LONG}</form></article></main>", f"T {LONG} ok"),
    (f"<article><p>{LONG}<section id=comments><p>{LONG}</section></article>", LONG),
    (f"<article><p>{LONG}<div class='cookieNotice x'><p>{LONG}</div><div class=adder>more</div></article>", f"{LONG} more"),
    (f"<article><p>a &lt;b&gt; &amp;amp; &eacute;&#x41;&nbsp; <b>w</b>ord 1 < 2 {LONG}</p></article>", f"a <b> &amp; éA word 1 < 2 {LONG}"),
    (f"<article><p title='a > b'>{LONG}<p><a href='x'>{LONG}</a><p>{LONG} <a href=y>more</a></article>", f"{LONG} {LONG} more"),
    (f"<body class='home sidebar'><div role=navigation>{LONG}</div><div>{LONG}</div></body>", LONG),
    (f"<article><p><b>{LONG}<p>Next <a href=x>open<p>{LONG}</article><footer>x</footer>", f"{LONG} Next open {LONG}")])
def test_block_rules(page, want):
    assert X.main_text(page) == want


def test_extraction_keeps_rows_and_columns(spark):
    schema = "page_id bigint, `ht.ml` string, main int, `a.b` string, text string"
    rows = [(1, f"<p>{LONG}", 1, "x", "y"), (1, f"<p>{LONG}", 1, "x", "y"), (None, None, None, None, None), (2, "<p>" + f"{LONG}<p>" * 20000, 2, "x", "y")]
    got = X.extract(spark.createDataFrame(rows, schema), "ht.ml")
    assert got.columns == ["page_id", "ht.ml", "main", "a.b", "text", "main_"]
    found = [(r.page_id, r["main_"].n_chars, r["a.b"]) for r in got.collect()]
    assert sorted(found, key=str) == sorted([(1, len(LONG), "x")] * 2 + [(None, 0, None), (2, 20000 * (len(LONG) + 1) - 1, "x")], key=str)
    assert X.extract(spark.createDataFrame([], schema), "ht.ml").count() == 0


# ------------------------------------------------------------------ lexical search

def texts():
    rnd = random.Random(11)
    vocabulary = [f"w{k}" for k in range(60)] + ["Été", "été", "ABC", "abc", "日本"]
    rows = [(k, " ".join(rnd.choices(vocabulary, k=rnd.randint(1, 80)))) for k in range(400)]
    rows += [(3, rows[3][1]), (3, rows[3][1]), (None, rows[5][1]), (None, rows[5][1]), (401, None), (402, ""), (403, " .,; "), (404, "w1 " * 30000 + "w2"),
             (405, "x" * 3_000_000), *((500 + k, "w1 w2 w3") for k in range(70))]
    return [(i, t, 1, "w") for i, t in rows]


ITEMS = [(1, "w1 w2, w2 W3!"), (1, "w4"), (2, None), (3, ""), (4, "unheard of"), (None, "ABC été"), (5, " ".join(f"w{k}" for k in range(60))), (6, "日本 w59")]


def ranked(docs, items, k):
    def terms(t):
        return [x.translate({c: c + 32 for c in range(65, 91)}) for x in re.findall(L.TERMS, t or "")]
    counts = [(i, Counter(terms(t))) for i, t, *_ in docs]
    counts = [(i, c) for i, c in counts if c]
    n, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    out = Counter()
    for item, want in wanted.items():
        scored = []
        for i, c in counts:
            m = 50 + 50 * sum(c.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in want if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out.update((item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k]))
    return out


@pytest.mark.parametrize("shard_docs,slice_items", [(8192, 2000), (20, 2)])
def test_lexical_search(spark, monkeypatch, shard_docs, slice_items):
    monkeypatch.setattr(L, "SHARD_DOCS", shard_docs)
    monkeypatch.setattr(L, "SLICE_ITEMS", slice_items)
    docs = spark.createDataFrame(texts(), "`doc.id` bigint, text string, term int, item_id string").repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id int, `te.xt` string")
    got = Counter(tuple(r) for r in L.lexical_search(docs, items, "doc.id", "text", "item_id", "te.xt").collect())
    assert got == ranked(texts(), ITEMS, L.TOP)


def test_lexical_search_of_nothing(spark):
    docs, items = spark.createDataFrame(texts(), "doc_id bigint, text string, x int, y string"), spark.createDataFrame(ITEMS, "item_id int, text string")
    assert L.lexical_search(docs.limit(0), items).count() == 0 and L.lexical_search(docs, items.limit(0)).count() == 0


def test_terms_of_long_texts_are_not_cut(monkeypatch):
    text = ("Ab é,c 日本x" * 500 + " y" * 999).encode()
    whole = L.term_counts(text)
    for piece in (1, 2, 3, 7, 64):
        monkeypatch.setattr(L, "PIECE", piece)
        assert L.term_counts(text) == whole
    assert html_lib.unescape("&amp;") == "&" and L.term_counts(None) == {}


def test_best_positions_end_the_search_early():
    import numpy as np
    rng = np.random.default_rng(5)
    n, terms = 20000, 3
    doc, term = np.tile(np.arange(n), terms), np.repeat(np.arange(terms), n)
    impact = rng.integers(1, 100, n * terms)
    impact[doc < 60] += 1000
    lists = L.ImpactLists(doc, term, impact, n, terms)
    docs, scores = lists.search(np.arange(terms), np.array([3, 2, 1]), 50)
    best = sorted(((-int(s), int(d)) for d, s in zip(docs, scores)))[:50]
    every = impact.reshape(terms, n).T @ [3, 2, 1]
    assert best == sorted((-int(s), d) for d, s in enumerate(every))[:50] and len(docs) < 2000
