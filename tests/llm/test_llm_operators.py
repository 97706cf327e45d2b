"""Every operator on a small table of hard cases against brute force, and on empty tables."""

import collections
import hashlib
import math
import re

import pytest
from conftest import SF001

import corpus_pipeline
from tidemark.llm import components as C
from tidemark.llm import decontamination as D
from tidemark.llm import license_scan, lm_scoring, mixing, ngram_join, quality_rules, registry, secret_scan, sharding, substring_dedup, url_filters

SCHEMA = "doc_id bigint, text string, source string, digest string, mix string, n_words int, `a.b` int"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sentence(seed, n=60):
    return " ".join(hashlib.md5(f"{seed}-{k}".encode()).hexdigest()[:3 + k % 5] for k in range(n))


BASE = sentence("base", 80)
PASSAGE = sentence("passage", 55)


def changed(text, k):
    w = text.split()
    w[k] = "changed"
    return " ".join(w)


def rows():
    texts = [None, "", " \n\t", "one", "one", BASE, BASE, changed(BASE, 40), changed(BASE, 41), changed(changed(BASE, 20), 60),
             sentence("p1", 30) + " " + PASSAGE + " " + sentence("p2", 30), sentence("p3", 40) + " " + PASSAGE, "same line here\n" * 60, sentence("long", 30000),
             sentence("c", 100), "a b c # é " * 30, "x" * 5000, sentence("d", 70) + "\nReleased under the MIT License.", sentence("e", 70) + ' token = "' + "9f" * 20 + '"']
    out = [(k, t, ["s1", "s2", None][k % 3]) for k, t in enumerate(texts)]
    out += [(None, sentence("f", 70), "s1"), (None, BASE, "s2"), (14, sentence("c", 100), "s1"), (14, sentence("c", 100), "s1"), (14, sentence("g", 60), "s3"), (99, "one", "")]
    return [(i, t, s, "d", "m", k, 1) for k, (i, t, s) in enumerate(out)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).coalesce(2)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def sets_of(text):
    w = words(text)
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def test_quality_rules(docs, empty):
    got = quality_rules.repetition(docs).collect()
    assert len(got) == len(rows())
    for r in got:
        m, w = r.repetition, words(r.text)
        lines = (r.text or "").split("\n")
        assert m.n_words == len(w) and m.word_chars == sum(map(len, w)) and m.n_symbols == sum(c in "#*$%&|<>" for c in r.text or "")
        assert m.n_dup_lines == sum(x in lines[:k] and bool(words(x)) for k, x in enumerate(lines))
        for size, value in ((3, m.n_repeat_words), (quality_rules.MIN_REPEAT_WORDS, m.covered_words)):
            grams = [tuple(w[k:k + size]) for k in range(len(w) - size + 1)]
            times = collections.Counter(grams)
            assert value == len({p for k, g in enumerate(grams) if times[g] > 1 for p in range(k, k + size)})
        assert sum(s.words for s in m.spans) == m.covered_words
    kept = {r.n_words for r in quality_rules.quality_filter(docs).collect()}  # n_words numbers the rows here
    assert {5, 6, 7, 10, 13, 14} <= kept and not kept & {0, 1, 2, 3, 12, 15, 16}
    assert quality_rules.quality_filter(docs).columns == docs.columns
    assert quality_rules.quality_filter(empty).count() == 0


def test_repetition_limits_reject_what_the_base_rules_keep(spark):
    pasted = " ".join([sentence("q1", 60), sentence("p", 45), sentence("q2", 60), sentence("p", 45), sentence("q3", 60)])
    periodic = " ".join([sentence("q4", 40), *["again"] * 29, sentence("q5", 40)])  # a repeat that overlaps itself: 28 of 109 words long, 29 covered
    little = " ".join([sentence("q6", 70), sentence("p", 25), sentence("q7", 70), sentence("p", 25)])
    texts = spark.createDataFrame([(1, pasted), (2, periodic), (3, little)], "doc_id int, text string")
    measured = quality_rules.repetition(texts)
    got = {r.doc_id: r for r in measured.select("doc_id", "repetition", *(c.alias(n) for c, n in zip(quality_rules.verdict(measured["repetition"]), ("base", "kept"), strict=True))).collect()}
    assert not any(r.base for r in got.values()) and [got[k].kept for k in (1, 2, 3)] == [False, False, True]
    share = {k: (r.repetition.covered_words / r.repetition.n_words, r.repetition.longest_repeat / r.repetition.n_words) for k, r in got.items()}
    assert share[1][0] > quality_rules.MAX_COVERED and share[1][1] <= quality_rules.MAX_LONGEST  # by the covered part alone
    assert share[2][0] <= quality_rules.MAX_COVERED and share[2][1] > quality_rules.MAX_LONGEST  # by the longest repeat alone
    assert [r.doc_id for r in quality_rules.quality_filter(texts).collect()] == [3]


def test_ngram_join(docs, empty):
    data = rows()
    sets = [sets_of(r[1]) for r in data]
    near = [[bool(a and b) and len(a & b) >= 0.8 * len(a | b) for b in sets] for a in sets]
    group = list(range(len(data)))
    for _ in data:
        group = [min([group[k], *(group[j] for j in range(len(data)) if near[k][j])]) for k in range(len(data))]
    least = {g: min((data[k][0] for k in range(len(data)) if group[k] == g and data[k][0] is not None), default=None) for g in group}
    want = collections.Counter((r[0], least[group[k]] if sets[k] else r[0], len(sets[k]), max(1, sum(s == sets[k] for s in sets)) if sets[k] else 1, sum(near[k]) - near[k][k]) for k, r in enumerate(data))
    assert collections.Counter(map(tuple, ngram_join.near_duplicates(docs).collect())) == want
    one = ngram_join.one_of_each(docs)
    assert one.columns == docs.columns
    kept = [r.n_words for r in one.collect()]
    assert collections.Counter(group[k] for k in kept if sets[k]) == collections.Counter({g for k, g in enumerate(group) if sets[k]})
    assert sorted(k for k in kept if not sets[k]) == [k for k in range(len(data)) if not sets[k]]
    assert ngram_join.near_duplicates(empty).count() == 0 and ngram_join.one_of_each(empty).count() == 0


def test_tiles_split_a_group(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "TILE", 4)
    w = sentence("tile", 200).split()
    data = [(k, " ".join([*w[:k * 3], f"new{k}", *w[k * 3 + 1:]])) for k in range(40)]
    sets = [sets_of(t) for _, t in data]
    got = {r.doc_id: r.n_links for r in ngram_join.near_duplicates(spark.createDataFrame(data, "doc_id int, text string")).collect()}
    assert got == {k: sum(len(a & b) >= 0.8 * len(a | b) for b in sets) - 1 for k, a in enumerate(sets)}


def test_prefix_is_shortened_until_the_recall():
    k = ngram_join.prefix_length()
    assert 1 - (1 - 0.8 ** k) ** ngram_join.TREES >= ngram_join.RECALL > 1 - (1 - 0.8 ** (k + 1)) ** ngram_join.TREES


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (4, 5), (5, 6), (9, 8), (8, 8), (None, 3), (7, None), (1, 2)]
    got = {r.node: r.root for r in C.components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1, 8: 8, 9: 8}
    assert C.components(spark.createDataFrame([], "a int, b int")).count() == 0


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_decontamination(spark, docs, empty):
    items = [(1, PASSAGE[:200]), (2, "one"), (3, None), (4, "..."), (None, "same line here"), (10, PASSAGE[:200].upper()), (1, PASSAGE[:200]), (5, sentence("nowhere", 20))]
    tests = spark.createDataFrame(items, "item_id bigint, text string")
    for size in (D.SLICE_WORDS, 1):  # one slice, and one slice an item
        got = {r.n_words: r.contamination for r in _matched(docs, tests, size).collect()}
        for k, r in enumerate(rows()):
            w = alnum(r[1])
            hit, found = set(), set()
            for item, text in items:
                t = alnum(text)
                n = min(13, len(t))
                windows = {tuple(t[s:s + n]) for s in range(len(t) - n + 1)} if n else set()
                at = [s for s in range(len(w) - n + 1) if n and tuple(w[s:s + n]) in windows]
                hit |= {p for s in at for p in range(s, s + n)}
                if at and item is not None:
                    found.add(str(item))
            assert (got[k].n_words, got[k].n_hit, got[k]["items"]) == (len(w), len(hit), sorted(found))
            assert set(got[k]["items"]) <= set(got[k].near_items)
    kept = {r.n_words for r in D.decontaminate(docs, tests).collect()}
    assert not kept & {3, 4, 10, 11, 12} and {0, 1, 5, 13, 14} <= kept
    assert D.decontaminate(docs, tests.limit(0)).count() == len(rows()) and D.decontaminate(empty, tests).count() == 0


def _matched(docs, tests, size):
    old, D.SLICE_WORDS = D.SLICE_WORDS, size
    try:
        context = docs.sparkSession.sparkContext
        slices = [context.broadcast(s) for s in D.test_slices(tests, slice_words=size)]
        assert len(slices) == (1 if size > 1 else len([1 for _ in tests.collect()]))
        from tidemark.llm.frames import python_map, schema_with
        return python_map(docs, D._matched(slices, "text", "contamination"), schema_with(docs, "contamination", D._TYPE))
    finally:
        D.SLICE_WORDS = old


def test_lm_scoring(docs, empty):
    data = [[re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words(r[1])] for r in rows()]
    own = [collections.Counter(tuple(w[k:k + n]) for n in (1, 2, 3) for k in range(len(w) - n + 1)) for w in data]
    corpus = sum(own, collections.Counter())
    total = sum(map(len, data))
    want = collections.Counter()
    for r, w, mine in zip(rows(), data, own, strict=True):
        score = 0.0
        for k in range(len(w)):
            for n in range(min(3, k + 1), 0, -1):
                c = corpus[tuple(w[k - n + 1:k + 1])] - mine[tuple(w[k - n + 1:k + 1])]
                if n == 1:
                    score += math.log(max(c, 1) / (total - len(w)))
                elif c > 0:
                    before = tuple(w[k - n + 1:k])
                    score += math.log(c / (corpus[before] - mine[before]))
                    break
                else:
                    score += math.log(0.4)
        want[r[0], len(w), round(score, 6) if w else None] += 1
    got = lm_scoring.stupid_backoff(docs).collect()
    assert collections.Counter((r[0], r[1], None if r[2] is None else round(r[2], 6)) for r in got) == want
    assert lm_scoring.stupid_backoff(empty).count() == 0
    assert lm_scoring.stupid_backoff(docs.limit(0).unionByName(docs.filter("doc_id = 5"))).first().log_score is None


def test_lm_scoring_of_equal_blocks(docs):
    twice = docs.unionByName(docs)  # each partition is read twice: blocks of one name
    got = collections.Counter(map(tuple, lm_scoring.stupid_backoff(twice).collect()))
    assert set(got.values()) <= {2, 4, 6} and sum(got.values()) == 2 * len(rows())


def test_mixing(docs, empty):
    got = mixing.mix(docs, into="mixed").collect()
    assert len(got) == len(rows())
    sizes, taken = collections.Counter(), collections.Counter()
    for r in got:
        assert r.mixed.size == len(words(r.text)) and 0 <= r.mixed.copies <= 3
        sizes[r.source] += r.mixed.size
        taken[r.source] += r.mixed.size * r.mixed.copies
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    capped, target = set(), {}
    while True:
        rest = sum(sizes.values()) - sum(3 * sizes[s] for s in capped)
        level = rest / sum(weight[s] for s in order if s not in capped) if len(capped) < len(order) else 0
        target = {s: 3 * sizes[s] if s in capped else level * weight[s] for s in order}
        over = {s for s in order if target[s] > 3 * sizes[s]} - capped
        if not over:
            break
        capped |= over
    for r in got:
        assert r.mixed.source_size == sizes[r.source] and r.mixed.target == pytest.approx(target[r.source])
    emitted = collections.Counter(r.n_words for r in mixing.mixture(docs).collect())
    assert emitted == collections.Counter({r.n_words: r.mixed.copies for r in got if r.mixed.copies})
    again = mixing.mix(docs.repartition(5), into="mixed").collect()
    key = lambda rs: collections.Counter((r.doc_id, r.text, r.source, r.mixed) for r in rs)
    assert key(got) == key(again)
    assert mixing.mix(empty).count() == 0 and mixing.mixture(empty).columns == empty.columns


def test_mixing_comes_near_the_targets(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = mixing.mix(docs).collect()
    largest, taken = collections.Counter(), collections.Counter()
    for r in got:
        largest[r.source] = max(largest[r.source], r.mix.size)
        taken[r.source] += r.mix.size * r.mix.copies
    for r in got:
        assert abs(taken[r.source] - r.mix.target) <= 3 * largest[r.source]


def test_lookup_table():
    names = sharding.shard_names(7)
    table = sharding.lookup_table(names, 101)
    place, taken = [0] * 7, [None] * 101  # turns by hand
    permutation = [[(sharding._number(n + ":offset") + j * (sharding._number(n + ":skip") % 100 + 1)) % 101 for j in range(101)] for n in names]
    for turn in range(101):
        k = turn % 7
        while taken[permutation[k][place[k]]] is not None:
            place[k] += 1
        taken[permutation[k][place[k]]] = k
    assert table == taken
    owned = collections.Counter(table)
    assert max(owned.values()) - min(owned.values()) <= 1
    fewer = sharding.lookup_table(names[:-1], 101)
    moved = sum(a != b for a, b in zip(table, fewer, strict=True) if a != 6)
    assert moved < 40  # most slots of the shards that stay don't move
    with pytest.raises(ValueError):
        sharding.lookup_table(names, 100)


def test_sharding(docs, empty, tmp_path):
    names = sharding.shard_names(7)
    got = sharding.sharded(docs.withColumnRenamed("mix", "shard"), names, 101).collect()
    table = sharding.lookup_table(names, 101)
    assert len(got) == len(rows())
    for r in got:
        key = str(r.doc_id) if r.doc_id is not None else "text:" + hashlib.md5(r.text.encode()).hexdigest()
        assert r.slot == int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % 101 and r.shard_ == names[table[r.slot]]
    assert sharding.sharded(empty, names, 101).count() == 0
    sharding.write_shards(docs, str(tmp_path / "out"), names, 101, files=2)
    assert docs.sparkSession.read.parquet(str(tmp_path / "out")).count() == len(rows())


def test_url_rules(spark):
    urls = [None, "", "no scheme", "http://example.com/en/1", "http://WWW.Example.com/en/1", "https://a.b.example.com/EN/1", "http://example.com", "http://x.net/es/", "http://net/fr/a?b#c",
            "http://notexample.com/en/", "http://example.com?x=/en/", "ftp://a://b.com/z", "http://spam-farm.example.org/en/1", "http://x.org/spam-farmer", "http://cheap-pills.org/", "http://casino.org/a",
            "http://x.org/casino", "http://é.com/", "http://example.community/en/"]
    urls += ["http://x.org/" + "a" * 100_000, "http://x.net/es/", "http://x.net/es/"]
    pages = spark.createDataFrame([(k, u, "c") for k, u in enumerate(urls)], "page_id int, url string, filter string")
    got = {r.page_id: r["filter_"] for r in url_filters.url_verdicts(pages).collect()}
    fixed = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}
    for k, u in enumerate(urls):
        host, path = url_filters.parts_of(u)
        fits = [r for r in fixed if ("." + host).endswith("." + r.partition("/")[0]) and path.startswith("/" + r.partition("/")[2])]
        best = max(fits, key=len, default=None)
        assert (got[k].host, got[k].path, got[k].rule) == (host, path, best)
        if best:
            assert got[k].verdict == fixed[best]
    assert [got[k].verdict for k in (12, 13, 14, 15, 16)] == ["block", "allow", "block", "block", "allow"]
    assert got[11].host == "a:" and got[8].path == "/fr/a"
    assert url_filters.url_verdicts(pages.limit(0)).count() == 0
    with pytest.raises(ValueError):
        url_filters.rule_index([url_filters.Rule("x", "block", ".*", ())], {})


def test_url_index_asks_only_candidates(spark, monkeypatch):
    rules = [url_filters.Rule(f"r{k}", "block", rf"/t{k}(?![a-z0-9])", (f"t{k}", "page")) for k in range(50)]
    pages = spark.createDataFrame([(k, f"http://h.org/page/t{k}") for k in range(60)], "page_id int, url string")
    monkeypatch.setattr(url_filters, "MAX_RULES", 20)  # three indexes
    got = {r.page_id: r["filter"] for r in url_filters.url_verdicts(pages, rules).collect()}
    assert [got[k].verdict for k in range(60)] == ["block"] * 50 + ["allow"] * 10
    assert max(got[k].n_candidates for k in range(60)) == 1


def test_substring_dedup_counts_against_brute_force(spark):
    """All four counts, from the chunk runs of each text alone, without Spark's aggregates and joins."""
    import numpy as np
    shared, other = sentence("shared", 60), sentence("other", 40)
    texts = {1: sentence("q1", 30) + " " + shared, 2: shared + " " + sentence("q2", 25), 3: other + " " + sentence("q3", 20) + " " + other, 4: sentence("q4", 50), 5: shared + " " + other, 6: None, 7: "short"}
    runs, first, total = {}, {}, collections.Counter()
    for i, t in texts.items():
        raw = (t or "").encode()
        data = np.frombuffer(raw, np.uint8)
        starts = [m.start() for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)]
        _, _, a, b = next(substring_dedup.chunk_runs(data, np.array([0, len(data)])), (0, [], np.array([]), np.array([])))
        runs[i] = [(raw[x:y], x, {k for k, s in enumerate(starts) if x <= s < y}) for x, y in zip(a.tolist(), b.tolist())]
        for content, x, _ in runs[i]:
            total[content] += 1
            first.setdefault(content, (i, x)) if content not in first else None
    # the first occurrence is that of the smallest (doc_id, place)
    for i in sorted(runs):
        for content, x, _ in runs[i]:
            first[content] = min(first[content], (i, x))
    got = {r.doc_id: r for r in substring_dedup.repeated_passages(spark.createDataFrame(list(texts.items()), "doc_id int, text string")).collect()}
    assert set(got) == set(texts)
    for i, r in got.items():
        again = [(x, w) for content, x, w in runs[i] if total[content] > 1]
        later = [w for content, x, w in runs[i] if total[content] > 1 and first[content] != (i, x)]
        covered = sorted(set().union(*(w for _, w in again)))
        assert (r.n_repeated_runs, r.repeated_words, r.later_words) == (len(again), len(covered), len(set().union(*later)))
        parts, reach = [], -1
        for x, w in again:
            if w:
                parts = [*parts[:-1], parts[-1] | w] if parts and min(w) <= reach + 0 else [*parts, set(w)]
                reach = max(reach, max(w) + 1)
        assert r.longest_repeat == max(map(len, parts), default=0) and r.has_passage == (r.longest_repeat >= substring_dedup.PASSAGE_WORDS)


def test_substring_dedup(docs, empty):
    got = substring_dedup.repeated_passages(docs).collect()
    data = rows()
    assert len(got) == len(data)
    found = collections.Counter((r.doc_id, r.has_passage) for r in got)
    assert found[10, True] == found[11, True] == 1 and found[5, True] == found[6, True] == 1 and found[14, True] == 3
    assert found[13, False] == 1 and found[0, False] == 1 and found[12, True] == 1
    cut = {r.n_words: r.text for r in substring_dedup.without_repeats(docs).collect()}
    assert len(cut) == len(data) and cut[0] is None and cut[13] == data[13][1] and cut[10] == data[10][1]
    assert len(cut[11]) < len(data[11][1]) - 150 and data[11][1].startswith(cut[11][:200])
    assert len(cut[6]) < 100 and cut[5] == data[5][1]
    assert substring_dedup.repeated_passages(empty).count() == 0 and substring_dedup.without_repeats(empty).columns == empty.columns


def test_substring_dedup_without_ids(spark):
    head = sentence("header", 60)
    texts = [head + " " + sentence(f"tail{k}", 60) for k in range(3)]
    data = spark.createDataFrame([(None, t, k) for k, t in enumerate([*texts, BASE, BASE, BASE])] + [(7, sentence("own", 60), 6), (8, texts[0][:300], 7), (8, texts[0][:300] + PASSAGE, 8)], "doc_id bigint, text string, row int").coalesce(2)
    some = data.filter("row < 7")
    cut = {r.row: r.text for r in substring_dedup.without_repeats(some).collect()}
    original = {r.row: r.text for r in some.collect()}
    # the shared header stays in one of three texts, of three equal texts one stays whole
    assert sum(cut[k] == original[k] for k in (0, 1, 2)) == 1 and sum(cut[k] == BASE for k in (3, 4, 5)) == 1 and cut[6] == original[6]
    assert all(len(cut[k]) < 120 for k in (3, 4, 5) if cut[k] != BASE)
    later = sorted(r.later_words for r in substring_dedup.repeated_passages(some.filter("row > 2")).collect())
    assert later[:2] == [0, 0] and later[2] == later[3] > 60
    # two texts of one id are told apart as well
    same = {r.row: r.text for r in substring_dedup.without_repeats(data.filter("row > 6")).collect()}
    assert sum(same[k] == r for k, r in ((7, texts[0][:300]), (8, texts[0][:300] + PASSAGE))) == 1
    assert substring_dedup._tag(b"a") != substring_dedup._tag(b"b") and max(abs(substring_dedup._tag(b"%d" % k)) for k in range(20)) > 1 << 40


def test_chunks_resist_insertions():
    import numpy as np

    def chunk_set(text):
        data = np.frombuffer(text.encode(), np.uint8)
        _, cuts, _, _ = next(iter(substring_dedup.chunk_runs(data, np.array([0, len(data)]))))
        assert cuts[-1] == len(data) and all(b - a <= substring_dedup.MAX_CHUNK for a, b in zip([0, *cuts], cuts, strict=False))
        return {text.encode()[a:b] for a, b in zip([0, *cuts], cuts, strict=False)}

    text = sentence("chunks", 2000)
    a, b = chunk_set(text), chunk_set(text[:5000] + "inserted" + text[5000:])
    assert len(a ^ b) <= 12
    brute = [0] * 40
    table = np.random.Generator(np.random.PCG64(11)).integers(0, 1 << 32, 256, np.uint32)
    h = 0
    for k, c in enumerate(text.encode()[:40]):
        h = ((h << 2) + int(table[c])) & 0xFFFFFFFF
        brute[k] = h
    assert substring_dedup.gear(np.frombuffer(text.encode()[:40], np.uint8)).tolist() == brute


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet")


def test_license_scan(spark, corpus, docs, empty):
    model, least = license_scan.fit(license_scan.labelled(corpus))
    held = license_scan.labelled(corpus).filter("held_out")
    judged = license_scan._judged(model, license_scan.featured(held, "body")).collect()
    right = sum(r.guess == r.label for r in judged)
    assert len(judged) > 40 and right >= 0.9 * len(judged)
    lines = [(1, "Licensed under the Apache License, Version 2.0.", "Apache-2.0"), (2, "released under the MIT license", "MIT"), (3, "Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
             (4, "Licensed under the Example Documentation License.", "unknown"), (5, sentence("x", 20), None), (6, None, None), (7, "\n \n", None),
             (8, "This work is licensed under the GNU General Public License, version 3.", "GPL-3.0")]
    got = {r.doc_id: r.licence for r in license_scan.scan(spark.createDataFrame(lines, "doc_id int, text string, licence string"), model, least).collect()}
    assert got == {k: v for k, _, v in lines if v}
    assert [r.paragraph for r in license_scan.scan(docs, model, least).collect()] == [1]
    assert license_scan.scan(empty, model, least).count() == 0
    license_scan.fit(license_scan.labelled(empty))


def test_wrapped_notices_keep_their_family(spark, corpus):
    import textwrap
    model, least = license_scan.fit(license_scan.labelled(corpus))
    notices = {k: max(v, key=len) for k, v in license_scan.TEMPLATES.items() if k in ("MIT", "GPL-3.0", "BSD")}
    rows = [(k, sentence("z", 30) + ".\n\n" + "\n".join(textwrap.wrap(v, width)) + "\n\n" + sentence("zz", 30)) for k, v in notices.items() for width in (72, 80)]
    rows += [(None, None), (None, ""), ("equal", "\n".join(textwrap.wrap(notices["MIT"], 72)))] + [("equal", "\n".join(textwrap.wrap(notices["MIT"], 72)))]
    found = license_scan.scan(spark.createDataFrame(rows, "doc_id string, text string"), model, least).collect()
    named = [(r.doc_id, r.licence) for r in found if r.licence != "unknown"]
    assert {x for x in named if x[0] != "equal"} == {(k, k) for k in notices} and named.count(("equal", "MIT")) % 2 == 0 and ("equal", "MIT") in named


def test_license_scan_without_licence_words(spark, corpus):
    lines = ["All rights reserved.", "GPLv3 or later", "CC0 1.0", "Some rights are reserved by the authors.", "All rights reserved by the publisher",  # the last two are wordings that the fit never saw
             "He reserved two rooms.", "mit", "one", sentence("y", 20)]
    data = spark.createDataFrame(list(enumerate(lines)), "doc_id int, text string")
    drawn = license_scan.labelled(corpus)
    assert not drawn.filter("label = 0 AND body ILIKE '%rights reserved%'").count()
    model, least = license_scan.fit(drawn)
    assert {r.doc_id: r.licence for r in license_scan.scan(data, model, least).collect()} == dict.fromkeys(range(5), "unknown")
    said = corpus.filter("text LIKE '%All rights reserved.%'").count()
    assert said and license_scan.scan(corpus, model, least).filter("body = 'All rights reserved.'").count() >= said


def test_secret_scan(spark, corpus, docs, empty):
    drawn = secret_scan.sample(corpus)
    words_ = secret_scan.dictionary_of(drawn)
    findings = secret_scan.planted_findings(drawn).withColumn("held", (__import__("pyspark").sql.functions.xxhash64("candidate") % 4 == 0)).persist()
    model = secret_scan.fit(findings.filter("NOT held"), words_)
    tested = model.transform(secret_scan.featured(findings.filter("held"), words_)).select("label", "prediction").collect()
    assert len(tested) > 100 and sum(r.label == r.prediction for r in tested) >= 0.97 * len(tested)
    assert sum(r.prediction for r in tested if r.label) >= 0.95 * sum(r.label for r in tested)
    texts = [(1, 'the key is token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" of'), (2, "then password=10be3b9c09a8828af3 and"), (3, "see ththeringthenerand of the"), (4, None), (5, ""),
             (6, "call 4785380592391139 for"), (7, "ththerinand@mail2.example.com")]
    texts += [(10, "password=Tr0ub4dor&3"), (11, 'set api_key: "a8F3k9Qz" there'), (12, 'pwd = "c0rrect!horse#battery9"'), (13, 'title="Introduction" and'), (14, "note: something else"),
              (15, "password: required"), (16, "x" * 100_000 + " password=Tr0ub4dor&3."), (2, "then password=10be3b9c09a8828af3 and"), (None, "password=Tr0ub4dor&3")]
    hits = secret_scan.scan(spark.createDataFrame(texts, "doc_id int, text string"), model, words_).collect()
    found = {r.doc_id for r in hits}
    assert found >= {1, 2, 10, 11, 12, 16, None} and not found & {3, 4, 5, 7, 13, 14, 15}
    assert [r.candidate for r in hits if r.doc_id in (10, 16, None)] == ["Tr0ub4dor&3"] * 3 and sum(r.doc_id == 2 for r in hits) == 2  # equal rows alike
    assert 18 in {r.doc_id for r in secret_scan.scan(docs, model, words_).collect()}
    assert secret_scan.scan(empty, model, words_).count() == 0
    nothing = secret_scan.sample(empty)
    assert secret_scan.dictionary_of(nothing) and secret_scan.planted_findings(nothing).count() == 0


def test_pipeline_stages(spark, docs, empty):
    now, counts = docs, []
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, SF001)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert now.columns == docs.columns
        counts.append(now.count())
    assert counts[0] > counts[1] >= counts[2] > 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF001).count() == 0


def test_pipeline_equals_its_steps(spark):
    """run() against the contract's rules, applied one after the other in plain Python."""
    data = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    ok = {r.doc_id for r in registry.QUERIES["op4_quality_rules"](spark, SF001).filter("kept").collect()}
    texts = {i: t for i, t in data if i in ok}
    sets = {i: sets_of(t) for i, t in texts.items()}
    group = {i: i for i in sets}
    ids = sorted(sets)
    for _ in range(4):
        for k, a in enumerate(ids):
            for b in ids[:k]:
                if group[a] != group[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                    low, high = sorted((group[a], group[b]))
                    group = {i: low if g == high else g for i, g in group.items()}
    bad = {r.doc_id for r in registry.QUERIES["op8_benchmark_decontamination"](spark, SF001).filter("contaminated").collect()}
    left = spark.read.parquet(f"{SF001}/documents.parquet").filter(__import__("pyspark").sql.functions.col("doc_id").isin(sorted(set(group.values()) - bad)))
    want = collections.Counter({r.doc_id: r.mix.copies for r in mixing.mix(left).collect() if r.mix.copies})
    got = corpus_pipeline.run(spark, SF001).collect()
    assert collections.Counter(r.doc_id for r in got) == want
    table, names = sharding.lookup_table(sharding.shard_names()), sharding.shard_names()
    assert all(r.shard == names[table[r.slot]] for r in got)
