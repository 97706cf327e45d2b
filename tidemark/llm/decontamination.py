"""Benchmark decontamination with a document-sharded positional inverted index (operator 8).

Every task indexes its share of the training texts: for each term of the test set, the
sorted list of places where it stands (other terms can't match and aren't stored).  A test window
is looked up from its rarest term: the list of that term, moved back by the term's
offset, is intersected with the moved lists of the next rarer terms until all agree.  What is left are exact
phrase matches.  A proximity match needs the window's longest words (``NEAR_TERMS`` distinct ones by bytes, then
by spelling, in any order) within ``NEAR_SLOP`` words of the first of them.

The test set is the query set: it is read in slices of ``SLICE_WORDS`` words,
each broadcast (so every broadcast has that bound) and run against all rows.

Cases: null and empty texts have no words and no hits; null or wordless items have no windows; rows of equal item_id are one
item; an item with null id makes hits but isn't listed or counted; texts are taken whole; further columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.frames import named, python_map, schema_with, spare
from tidemark.llm.words import ALNUM, Words, chunks, covered, per_row, words_of

WINDOW = 13
NEAR_TERMS, NEAR_SLOP = 4, 2 * WINDOW
#: Words of the test set in one broadcast slice (8 bytes each, and 13 term numbers for a window).
SLICE_WORDS = 250_000
#: Candidate places looked at in one go.
_AT_ONCE = 2_000_000
_NO_TERM = np.iinfo(np.int64).max


def test_slices(tests: DataFrame, window: int = WINDOW, slice_words: int = SLICE_WORDS) -> Iterator[dict]:
    """The windows of a test set (item_id, text) in slices of bounded size, read one after the other."""
    rows: list[tuple] = []
    size = 0
    for item, text in tests.select("item_id", "text").toLocalIterator():
        rows.append((item, text))
        size += len(text or "") // 4 + 1
        if size >= slice_words:
            yield _slice(rows, window)
            rows, size = [], 0
    if rows:
        yield _slice(rows, window)


def _slice(rows: list[tuple], window: int) -> dict:
    column = pa.array([t for _, t in rows], pa.string())
    items = [None if i is None else str(i) for i, _ in rows]
    terms, lengths, owner, near, term_list = [], [], [], [], []
    for row, _, data, offsets in chunks(column):
        w = words_of(data, offsets, ALNUM)
        term_list.append(w.hash)
        raw = ALNUM.lower[data].tobytes()
        spelled = [(a - b, raw[a:b], h) for a, b, h in zip(w.start.tolist(), w.end.tolist(), w.hash.tolist(), strict=True)]
        for k in range(w.n):
            a, b = w.first[k], w.first[k + 1]
            n = min(window, b - a)
            for s in range(a, b - n + 1) if n else ():
                own = np.full(window, -1, np.int64)
                own[:n] = np.arange(s, s + n)
                terms.append(w.hash[s:s + n])
                lengths.append(n)
                owner.append(row + k)
                near.append([h for _, _, h in sorted(set(spelled[s:s + n]))[:NEAR_TERMS]])
    vocabulary = np.unique(np.concatenate(term_list)) if term_list else np.empty(0, np.uint64)
    matrix = np.full((len(terms), window), -1, np.int32)
    close = np.full((len(terms), NEAR_TERMS), -1, np.int32)
    for k, t in enumerate(terms):
        matrix[k, : len(t)] = np.searchsorted(vocabulary, t)
        close[k, : len(near[k])] = np.searchsorted(vocabulary, np.array(near[k], np.uint64))
    return {"items": items, "vocabulary": vocabulary, "terms": matrix, "near": close,
            "length": np.array(lengths, np.int64), "owner": np.array(owner, np.int64)}


class Postings:
    """Places of the vocabulary's terms in a chunk, by term and place."""

    def __init__(self, words: Words, vocabulary: np.ndarray):
        n = len(words.hash)
        at = np.searchsorted(vocabulary, words.hash)
        place = np.flatnonzero(vocabulary[np.minimum(at, len(vocabulary) - 1)] == words.hash) if len(vocabulary) else at[:0]
        term = at[place]
        order = np.argsort(term, kind="stable")
        self.place, self.width = place[order], n + 1
        self.keys = term[order] * self.width + self.place
        self.count = np.bincount(term, minlength=len(vocabulary))
        self.first = np.concatenate([[0], np.cumsum(self.count)])

    def has(self, term: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Whether a term's list holds a place."""
        key = term.astype(np.int64) * self.width + place
        at = np.searchsorted(self.keys, key)
        return self.keys[np.minimum(at, len(self.keys) - 1)] == key if len(self.keys) else np.zeros(len(key), bool)

    def lists(self, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists of several terms after another: which query each entry is for, and its place."""
        n = self.count[term]
        query = np.repeat(np.arange(len(term)), n)
        at = np.arange(len(query)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[term], n)
        return query, self.place[at]


def _batches(cost: np.ndarray) -> Iterator[slice]:
    ends, lo = np.cumsum(cost), 0
    while lo < len(cost):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + _AT_ONCE, "right")))
        yield slice(lo, hi)
        lo = hi


def phrases(words: Words, tests: dict) -> tuple[np.ndarray, np.ndarray]:
    """(window, first place) of all exact occurrences."""
    index = Postings(words, tests["vocabulary"])
    terms = tests["terms"]
    rarity = np.where(terms >= 0, index.count[np.maximum(terms, 0)], _NO_TERM) if len(terms) else terms
    possible = np.flatnonzero(rarity.min(axis=1) > 0) if len(terms) else np.empty(0, np.int64)
    order = np.argsort(rarity[possible], axis=1, kind="stable")
    found = []
    cost = rarity[possible].min(axis=1) if len(possible) else possible
    for part in _batches(cost):
        window, by = possible[part], order[part]
        query, place = index.lists(terms[window, by[:, 0]])
        start = place - by[query, 0]
        length = tests["length"][window[query]]
        ok = (start >= 0) & (start + length <= len(words.hash))
        query, start, length = query[ok], start[ok], length[ok]
        ok = words.doc[start] == words.doc[start + length - 1]
        query, start = query[ok], start[ok]
        for k in range(1, terms.shape[1]):
            offset = by[query, k]
            term = terms[window[query], offset]
            ok = term < 0
            real = np.flatnonzero(~ok)
            ok[real] = index.has(term[real], start[real] + offset[real])
            query, start = query[ok], start[ok]
        found.append((window[query], start))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([w for w, _ in found]), np.concatenate([s for _, s in found])


def proximity(words: Words, tests: dict) -> tuple[np.ndarray, np.ndarray]:
    """(window, row) of all proximity matches."""
    index = Postings(words, tests["vocabulary"])
    near = tests["near"]
    count = np.where(near >= 0, index.count[np.maximum(near, 0)], 1) if len(near) else near
    possible = np.flatnonzero((count.min(axis=1) > 0) & (near[:, 0] >= 0)) if len(near) else np.empty(0, np.int64)
    found = []
    for part in _batches(count[possible, 0] if len(possible) else possible):
        window = possible[part]
        query, place = index.lists(near[window, 0])
        row = words.doc[place]
        low = np.maximum(place - NEAR_SLOP, words.first[row])
        high = np.minimum(place + NEAR_SLOP, words.first[row + 1] - 1)
        for k in range(1, near.shape[1]):
            term = near[window[query], k].astype(np.int64)
            at = np.searchsorted(index.keys, term * index.width + low)
            ok = (term < 0) | (index.keys[np.minimum(at, len(index.keys) - 1)] <= term * index.width + high) & (at < len(index.keys))
            query, row, low, high = query[ok], row[ok], low[ok], high[ok]
        found.append((window[query], row))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([w for w, _ in found]), np.concatenate([r for _, r in found])


def match(words: Words, slices: list) -> dict[str, list | np.ndarray]:
    """Per text of the chunk: words, hit words, matched items, items in proximity."""
    hit = np.zeros(len(words.hash), bool)
    exact: list[set] = [set() for _ in range(words.n)]
    close: list[set] = [set() for _ in range(words.n)]
    for tests in slices:
        window, start = phrases(words, tests)
        hit |= covered(len(words.hash), start, tests["length"][window])
        for into, row, which in ((exact, words.doc[start], window), (close, *proximity(words, tests)[::-1])):
            pairs = np.unique(np.stack([row, tests["owner"][which]]), axis=1)
            for r, o in pairs.T.tolist():
                if tests["items"][o] is not None:
                    into[r].add(tests["items"][o])
    return {"n_words": np.diff(words.first), "n_hit": per_row(hit, words.first), "items": exact, "near": close}


_TYPE = "struct<n_words:bigint,n_hit:bigint,items:array<string>,near_items:array<string>>"


def _matched(slices, text: str, into: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = [s.value for s in slices]
        for batch in batches:
            for row, end, data, offsets in chunks(batch.column(batch.schema.get_field_index(text))):
                m = match(words_of(data, offsets, ALNUM), tests)
                lists = [pa.array([sorted(x) for x in m[k]], pa.list_(pa.string())) for k in ("items", "near")]
                found = pa.StructArray.from_arrays(
                    [pa.array(m["n_words"].astype(np.int64)), pa.array(m["n_hit"].astype(np.int64)), *lists], ["n_words", "n_hit", "items", "near_items"])
                part = batch.slice(row, end - row)
                yield pa.RecordBatch.from_arrays([*part.columns, found], names=[*part.schema.names, into])
    return run


def contamination(docs: DataFrame, tests: DataFrame, text: str = "text", into: str = "contamination", window: int = WINDOW) -> DataFrame:
    """``docs`` with a struct column ``into`` (``spare`` of it, if there is one): words, words inside exact matches, items matched exactly and in proximity."""
    into = spare(docs, into)
    context = docs.sparkSession.sparkContext
    slices = [context.broadcast(s) for s in test_slices(tests, window)]
    return python_map(docs, _matched(slices, text, into), schema_with(docs, into, _TYPE))


def contaminated(m):
    """The contract's rule: any hit, and hits in at least a twentieth of the words."""
    return (m["n_hit"] > 0) & (20 * m["n_hit"] >= m["n_words"])


def decontaminate(docs: DataFrame, tests: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that aren't contaminated, columns as given."""
    into = spare(docs, "_contamination")
    return contamination(docs, tests, text, into).filter(~contaminated(F.col(into))).select(*map(named, docs.columns))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    m = F.col("contamination")
    found = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("text")
    return found.select(
        "doc_id", m["n_words"].alias("n_words"), m["n_hit"].alias("n_hit"),
        F.size(m["items"]).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(m["items"], ","), 256).alias("items_sha256"),
        contaminated(m).alias("contaminated"), F.size(m["near_items"]).cast("bigint").alias("n_near_items"))


#: Windows of words joined with spaces; a word never holds one.
OP8_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
wi AS (SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS g
       FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM wi),
dg AS (SELECT r, s, n, array_to_string(w[s:s + n - 1], ' ') AS g
       FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT r, s, dg.n, item_id FROM dg JOIN wi ON dg.n = wi.n AND dg.g = wi.g),
places AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM hits) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM hits WHERE item_id IS NOT NULL) GROUP BY r),
nt AS (SELECT DISTINCT item_id, list_transform(list_sort(list_transform(list_distinct(w[s:s + n - 1]),
         lambda x: {'l': -strlen(x), 'x': x}))[1:4], lambda y: y.x) AS t
       FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS s FROM b
             WHERE len(w) > 0 AND item_id IS NOT NULL)),
nv AS (SELECT DISTINCT unnest(t) AS x FROM nt),
dw AS (SELECT r, p, x FROM (SELECT r, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS x FROM d) SEMI JOIN nv USING (x)),
pl AS (SELECT r, x, list(p) AS ps FROM dw GROUP BY r, x),
nc AS (SELECT dw.r, dw.p, item_id, t FROM nt JOIN dw ON dw.x = t[1]),
nh AS (SELECT nc.r, item_id FROM nc LEFT JOIN pl p2 ON p2.r = nc.r AND p2.x = t[2]
         LEFT JOIN pl p3 ON p3.r = nc.r AND p3.x = t[3] LEFT JOIN pl p4 ON p4.r = nc.r AND p4.x = t[4]
       WHERE (len(t) < 2 OR len(list_filter(p2.ps, lambda q: abs(q - p) <= 26)) > 0)
         AND (len(t) < 3 OR len(list_filter(p3.ps, lambda q: abs(q - p) <= 26)) > 0)
         AND (len(t) < 4 OR len(list_filter(p4.ps, lambda q: abs(q - p) <= 26)) > 0)),
near AS (SELECT r, count(DISTINCT item_id) AS n_near_items FROM nh GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated,
       CAST(coalesce(n_near_items, 0) AS BIGINT) AS n_near_items
FROM d LEFT JOIN places USING (r) LEFT JOIN items USING (r) LEFT JOIN near USING (r)
"""
