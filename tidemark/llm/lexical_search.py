"""Ranked lexical search: the best documents for each query item, by an integer form of BM25.

A document's terms are the maximal runs of ``TERMS`` in its whole text, A-Z lower-cased.  With N documents that hold a
term, L terms in all of them and n in one, its m is ``100 - 50 + (50 * n * N) div L``; a term in df documents weighs
``w = floor(1000 * ln((2N + 2) / (2 df + 1)))``; a document scores the sum of ``w * ((10**9 * tf) div (1000 * tf + 20 * m))``
over an item's distinct terms.

Method: the Best Position Algorithm.  Each term has an impact list: its documents by falling impact.  Lists are read
side by side (sorted access); every document met for the first time is scored in full by direct accesses, which also
mark its place in each other list as seen.  The best position of a list is the end of its unbroken run of seen places -
at or beyond the last place read in order, so what the best positions' impacts would score together bounds every unseen
document more tightly than last-read places do.  The search ends once that bound lies strictly below the k-th score.

On Spark: one pass counts terms per document, whole texts, a few megabytes of Python objects at a time; counts of terms that
items use are stored as a table (a join with the items' terms, so other terms go no further).  Document
frequencies are an aggregate of it.  Documents are dealt into shards, items into slices; a (shard, slice) cell is one group of
a cogroup, holds ``SHARD_DOCS`` documents and ``SLICE_ITEMS`` items at most on average, builds its impact lists and sends
its first k documents per item, which one window ranks.  A frequent term is split over all shards.  The driver gets N, L and two counts.

Defined results: a null or empty text has no terms and is no document for N.  Equal rows are documents of their own and
all come out; null doc_ids too, after the others of their score.  Rows of the items that share an item_id are one item
with the terms of all (null is an item_id like any other).  An item without terms, or whose terms no document holds,
gives no rows, and so do empty tables.  Further columns play no part.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.llm.frames import named, python_map, stored

#: Fixed by the contract.
TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 50
#: Documents of a shard at most (on average), and the least number worth a shard of its own while there are few.
SHARD_DOCS, LEAST_DOCS, FEW_SHARDS = 8_192, 256, 64
#: Items that a cell holds at most (on average).
SLICE_ITEMS = 2_000
#: Sorted accesses per list in the first round; each round doubles the depth.
FIRST_DEPTH = 64
#: Characters of a text counted at once, and terms that one output batch holds.
PIECE, BATCH_TERMS = 1 << 20, 1 << 18

#: Over UTF-8, whose bytes of other characters are all 0x80 or more.
_TERM = re.compile(TERMS.encode())
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def term_counts(text: bytes | None) -> Counter:
    """How often each term occurs in the whole text (UTF-8); long texts are cut between terms."""
    counts: Counter = Counter()
    text, at = (text or b"").translate(_LOWER), 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            open_term = _TERM.match(text, end)  # what stands at the cut belongs to the term before it
            end = open_term.end() if open_term else end
        counts.update(_TERM.findall(text, at, end))
        at = end
    return counts


def _counted(text: str):
    """Per document its number of terms, and its distinct terms with their counts; a first entry with the term '' holds the number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows, terms, tfs, lengths):
            ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            pairs = pa.StructArray.from_arrays([pa.array(terms, pa.binary()).cast(pa.string()), pa.array(tfs, pa.int64())], ["term", "tf"])
            at = pa.array(rows)
            return pa.RecordBatch.from_arrays([keep.take(at), row.take(at), pa.array([sum(tfs[a + 1:b]) for a, b in zip(ends, ends[1:])], pa.int64()),
                                               pa.ListArray.from_arrays(ends, pairs)], names=["doc_id", "row", "n", "pairs"])
        for batch in batches:
            keep, row = batch.column(0), batch.column(1)
            rows, terms, tfs, lengths = [], [], [], []
            for k, value in enumerate(batch.column(batch.schema.get_field_index(text)).cast(pa.binary())):
                counts = term_counts(value.as_py())
                if not counts:
                    continue
                rows.append(k)
                lengths.append(len(counts) + 1)
                terms += [b"", *counts]
                tfs += [0, *counts.values()]
                if len(terms) >= BATCH_TERMS:
                    yield batch_of(rows, terms, tfs, lengths)
                    rows, terms, tfs, lengths = [], [], [], []
            if rows:
                yield batch_of(rows, terms, tfs, lengths)
    return run


class ImpactLists:
    """The documents of a cell: impact lists by term, and each document's entries for direct access."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_docs: int, n_terms: int):
        order = np.lexsort((doc, -impact, term))
        self.list_doc, self.list_impact = doc[order], impact[order]
        self.start = np.searchsorted(term[order], np.arange(n_terms + 1))
        place = np.empty(len(doc), np.int64)
        place[order] = np.arange(len(doc)) - self.start[term[order]]
        by_doc = np.argsort(doc, kind="stable")
        self.term, self.impact, self.place = term[by_doc], impact[by_doc], place[by_doc]
        self.first = np.searchsorted(doc[by_doc], np.arange(n_docs + 1))
        self.slot = np.full(n_terms, -1, np.int64)

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores among which are the ``k`` best of all (with every tie of the k-th), found by best positions."""
        size = self.start[terms + 1] - self.start[terms]
        offset = np.concatenate([[0], np.cumsum(size)])
        seen = np.zeros(offset[-1] + 1, bool)  # by list and place; one more that stays unseen
        best = np.zeros(len(terms), np.int64)  # best positions: places before them are all seen
        met = np.zeros(len(self.first) - 1, bool)
        self.slot[terms] = np.arange(len(terms))
        docs, scores = [], []
        lo, hi = 0, FIRST_DEPTH
        while True:
            read = [self.list_doc[s + lo:s + min(hi, n)] for s, n in zip(self.start[terms], size) if lo < n]
            new = np.unique(np.concatenate(read)) if read else np.empty(0, np.int64)
            new = new[~met[new]]
            met[new] = True
            # direct accesses: all entries of the new documents
            count = self.first[new + 1] - self.first[new]
            ends = np.cumsum(count)
            at = np.repeat(self.first[new] - (ends - count), count) + np.arange(count.sum())
            slot = self.slot[self.term[at]]
            mine = slot >= 0
            seen[offset[slot[mine]] + self.place[at[mine]]] = True
            sums = np.concatenate([[0], np.cumsum(np.where(mine, weights[slot] * self.impact[at], 0))])
            docs.append(new)
            scores.append(sums[ends] - sums[ends - count])
            bound = 0
            for i, n in enumerate(size):
                run = seen[offset[i] + best[i]:offset[i] + n]
                step = int(run.argmin()) if len(run) else 0
                best[i] = best[i] + step if len(run) and not run[step] else n
                if best[i] < n:
                    bound += int(weights[i] * self.list_impact[self.start[terms[i]] + best[i] - 1])
            every = np.concatenate(scores)
            if (best == size).all():
                break
            if len(every) >= k and bound < np.partition(every, -k)[-k]:
                break
            lo, hi = hi, 2 * hi
        self.slot[terms] = -1
        return np.concatenate(docs), every


def _codes(column: pa.ChunkedArray) -> tuple[np.ndarray, list]:
    coded = column.combine_chunks().dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.unify_dictionaries().combine_chunks()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()


def _searched(k: int, schema: pa.Schema):
    def run(postings: pa.Table, items: pa.Table) -> pa.Table:
        if not len(postings) or not len(items):
            return schema.empty_table()
        term, names = _codes(postings["term"])
        number = {t: i for i, t in enumerate(names)}
        key, row = postings["doc_id"], postings["row"].to_numpy()
        ids, values = _codes(key.fill_null(0)) if key.type != pa.string() else _codes(key.fill_null(""))
        null = key.is_null().to_numpy()
        # a document is (doc_id, hash of its text); equal rows give each entry several times
        order = np.lexsort((term, row, ids, null))
        columns = np.stack([null[order], ids[order], row[order], term[order]])
        fresh = np.append(True, (columns[:, 1:] != columns[:, :-1]).any(axis=0))
        start = np.append(True, (columns[:3, 1:] != columns[:3, :-1]).any(axis=0))
        doc = (np.cumsum(start) - 1)[fresh]
        entry = np.flatnonzero(fresh)
        copies = np.diff(np.append(entry, len(order)))[np.searchsorted(doc, np.arange(doc[-1] + 1))]
        head = order[np.flatnonzero(start)]
        impact = postings["impact"].to_numpy()[order][entry]
        lists = ImpactLists(doc, term[order][entry], impact, len(head), len(names))
        # ascending doc_id, null last
        value = [None if null[h] else values[ids[h]] for h in head]
        rank = np.empty(len(head), np.int64)
        rank[sorted(range(len(head)), key=lambda d: (value[d] is None, value[d] if value[d] is not None else 0, row[head[d]]))] = np.arange(len(head))
        wanted: dict = {}
        for item, t, w in zip(*(items[c].to_pylist() for c in ("item_id", "term", "w"))):
            if w and t in number:
                wanted.setdefault(item, []).append((number[t], w))
        out = [[], [], []]
        for item, pairs in wanted.items():
            terms, weights = (np.array(x, np.int64) for x in zip(*pairs))
            found, scores = lists.search(terms, weights, k)
            top = np.lexsort((rank[found], -scores))[:k]
            for d, s in zip(found[top].tolist(), scores[top].tolist()):
                if s > 0:
                    times = min(int(copies[d]), k)
                    out[0] += [item] * times
                    out[1] += [value[d]] * times
                    out[2] += [s] * times
        return pa.table([pa.array(v, f.type) for v, f in zip(out, schema)], schema=schema)
    return run


def _terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    lower = F.translate(named(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = F.array_distinct(F.regexp_extract_all(lower, F.lit(TERMS), F.lit(0)))
    return items.select(named(item_id).alias("item_id"), F.explode(terms).alias("term")).distinct()


def _deal(total: int, least: int, most: int, few: int) -> int:
    return max(1, min(-(-total // least), few), -(-total // most))


def lexical_search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                   item_text: str = "text", k: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` best documents with a score above 0, ties by ascending doc_id."""
    wanted = _terms(items, item_id, item_text)
    given = docs.select(named(doc_id).alias("doc_id"), F.xxhash64(named(text)).alias("row"), named(text).alias("text"))
    doc_type = given.schema["doc_id"].dataType.simpleString()
    counted = python_map(given, _counted("text"), f"doc_id {doc_type}, row bigint, n bigint, pairs array<struct<term:string,tf:bigint>>")
    used = wanted.select("term").distinct().unionByName(docs.sparkSession.range(1).select(F.lit("").alias("term")))
    postings = counted.select("doc_id", "row", "n", F.explode("pairs").alias("p")).select("doc_id", "row", "n", "p.term", "p.tf")
    postings = stored(postings.join(used, "term", "left_semi"))
    n_docs, n_terms = postings.filter("term = ''").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    n_items = wanted.select("item_id").distinct().count()
    shards, slices = _deal(n_docs, LEAST_DOCS, SHARD_DOCS, FEW_SHARDS), _deal(n_items, SLICE_ITEMS, SLICE_ITEMS, 1)

    postings = postings.filter("term <> ''")
    weight = F.floor(1000 * F.log(F.lit(2 * n_docs + 2) / (2 * F.col("df") + 1))).cast("bigint")
    weights = postings.groupBy("term").agg(F.count("*").alias("df")).select("term", weight.alias("w"))
    sliced = wanted.withColumn("slice", F.pmod(F.xxhash64("item_id"), F.lit(slices)).cast("int")).join(weights, "term")
    m = f"(50 + (50 * n * {n_docs}L) div {max(n_terms, 1)}L)"
    impact = F.expr(f"(1000000000L * tf) div (1000 * tf + 20 * {m})")
    cells = postings.join(sliced.select("slice", "term").distinct(), "term").select(
        F.pmod(F.xxhash64("doc_id", "row"), F.lit(shards)).cast("int").alias("shard"), "slice", "doc_id", "row", "term", impact.alias("impact"))
    queries = sliced.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), *(F.col(c).alias(c) for c in ("slice", "item_id", "term", "w")))
    item_type = wanted.schema["item_id"].dataType.simpleString()
    schema = f"item_id {item_type}, doc_id {doc_type}, score bigint"
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    found = cells.groupBy("shard", "slice").cogroup(queries.groupBy("shard", "slice")).applyInArrow(_searched(k, arrow), schema)
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
       'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
b AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
       'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
total AS (SELECT count(*) AS nd, CAST(sum(len(t)) AS BIGINT) AS l FROM d WHERE len(t) > 0),
p AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(t) AS n, unnest(t) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * nd + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, total GROUP BY term, nd),
s AS (SELECT b.item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nd) // l)))) AS BIGINT) AS score
      FROM b JOIN p USING (term) JOIN w USING (term), total GROUP BY b.item_id, r, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 50
"""
