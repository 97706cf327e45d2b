"""Stupid-backoff scores of documents (operator 3).

The model of a document is the corpus without it: every count is the corpus count less the document's own, so
no text vouches for itself.  Words are ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased.  With c for these counts,
the word w3 after w1 w2 scores c(w1 w2 w3) / c(w1 w2) if the trigram is known, else
``ALPHA`` * c(w2 w3) / c(w2) if the bigram is, else ``ALPHA``**2 * max(c(w3), 1) / N; the first words of a
text start at the order they have.  N is the number of words of the other documents.

Plan, two shuffles of packed rows:

1. Every task explodes its texts, a block at a time, into n-grams and combines them: the block's distinct n-gram hashes
   of each order with their counts, sorted and cut by hash range into one row for each part of the count table (``part_of``).
2. One task a part adds up the blocks' counts (the n-gram count table, partitioned by hash) and joins them back to
   the blocks' n-grams: each row returns as an array of corpus counts in the order it came.
3. One task a block brings these together with the block's texts (as word numbers), looks its n-grams up and sums the scores per document.

A block is named by a digest of its rows.  The texts are read once for 1 and once for 3; should a source not return the
same rows in the same order, a block lacks its counts and the job fails rather than score wrongly (checkpoint such a source first).

The number of parts grows with the bytes of text (``PART_BYTES``), the size of a block is fixed (``BLOCK_BYTES``), so no task
holds more at a larger input; a frequent n-gram is one entry a block.

Cases: a null, empty or wordless text has 0 words and null scores; so has every text if there are no other words; equal rows are
separate documents that know each other; doc_id is taken as a bigint, null or not; texts are taken whole (a text over ``BLOCK_BYTES`` is a block); an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.frames import named, python_map
from tidemark.llm.words import SPACED_LOWER, chain, chunks, words_of

ORDER, ALPHA = 3, 0.4
BLOCK_BYTES, PART_BYTES = 8 << 20, 8 << 20
#: Bits of an n-gram's hash: of 1e13 distinct n-grams, one in 7,000 unseen ones would meet another's count.
HASH_BITS = 56
_U = np.uint64


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Part of the count table that a hash belongs to; equal hash ranges, ascending."""
    return ((hashes >> _U(HASH_BITS - 32)) * _U(parts) >> _U(32)).astype(np.int64)


def _pack(array: np.ndarray) -> bytes:
    """Integers, byte planes apart, compressed."""
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(array.reshape(-1, 1).view(np.uint8).T).tobytes())


def _unpack(raw: bytes, kind) -> np.ndarray:
    import zstandard

    width = np.dtype(kind).itemsize
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return np.ascontiguousarray(flat.reshape(width, -1).T).view(kind).ravel()


def ngrams(word: np.ndarray, doc: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place of the last word) of every n-gram of this order that stays in its text; orders never share hashes."""
    n = len(word) - order + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h = np.full(n, order, np.uint64)
    for k in range(order):
        h = chain(h, word[k:k + n])
    at = np.flatnonzero(doc[:n] == doc[order - 1:])
    return h[at] >> _U(64 - HASH_BITS), at + order - 1


def _blocks(batches: Iterator[pa.RecordBatch]):
    """(name, doc_ids, words) of each block of the texts in the second column."""
    for batch in batches:
        ids = batch.column(0)
        for row0, row1, data, offsets in chunks(batch.column(1), BLOCK_BYTES):
            own = ids.slice(row0, row1 - row0)
            name = hashlib.blake2b(data, digest_size=16)
            name.update(offsets.tobytes() + "\n".join(map(str, own.to_pylist())).encode())
            yield name.digest(), own, words_of(data, offsets, SPACED_LOWER)


def _exploded(parts: int):
    """Texts -> (block, part, grade, hashes, counts): a block's distinct n-grams in each part of the count table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, w in _blocks(batches):
            for order in range(1, ORDER + 1):
                distinct, count = np.unique(ngrams(w.hash, w.doc, order)[0], return_counts=True)
                cut = np.searchsorted(part_of(distinct, parts), np.arange(parts + 1))
                out = [(p, _pack(np.diff(distinct[cut[p]:cut[p + 1]], prepend=_U(0))), _pack(count[cut[p]:cut[p + 1]].astype(np.uint32)))
                       for p in np.flatnonzero(np.diff(cut)).tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * len(out), pa.binary()), pa.array([r[0] for r in out], pa.int64()), pa.array([order] * len(out), pa.int32()),
                     pa.array([r[1] for r in out], pa.binary()), pa.array([r[2] for r in out], pa.binary())],
                    names=["block", "part", "grade", "hashes", "counts"])
    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Complete runs of equal (part, grade): blocks' n-grams -> (block, part, grade, corpus counts in the same order)."""
    for (part, grade), rows in _grouped(batches, ("part", "grade"), ("block", "hashes", "counts")):
        hashes = [np.cumsum(_unpack(h, np.uint64), dtype=np.uint64) for _, h, _ in rows]
        values, at = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.zeros(len(values), np.uint64)
        np.add.at(total, at, np.concatenate([_unpack(c, np.uint32) for _, _, c in rows]).astype(np.uint64))
        found, ends = total[at], np.cumsum([0, *map(len, hashes)])
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.binary()), pa.array([part] * len(rows), pa.int64()), pa.array([grade] * len(rows), pa.int32()),
             pa.array([_pack(found[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())],
            names=["block", "part", "grade", "counts"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts -> one row a block: its distinct words, its texts as numbers of these, their lengths and doc_ids."""
    for block, own, w in _blocks(batches):
        values, number = np.unique(w.hash, return_inverse=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array([block], pa.binary()), pa.array([_pack(np.diff(values, prepend=_U(0)) if len(values) else values)], pa.binary()), pa.array([_pack(number.astype(np.uint32))], pa.binary()),
             pa.array([_pack(np.diff(w.first).astype(np.uint64))], pa.binary()), pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own)],
            names=["block", "vocabulary", "words", "sizes", "ids"])


def _grouped(batches: Iterator[pa.RecordBatch], by: tuple[str, ...], columns: tuple[str, ...]):
    """(key, rows) of runs of equal ``by`` in sorted batches."""
    key, held = None, []
    for batch in batches:
        at = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (*by, *columns)]
        for r in zip(*at, strict=True):
            if held and r[:len(by)] != key:
                yield key, held
                held = []
            key = r[:len(by)]
            held.append(r[len(by):])
    if held:
        yield key, held


def document_scores(word: np.ndarray, size: np.ndarray, corpus: dict[int, np.ndarray], total: int) -> list[float | None]:
    """Log scores of a block's texts.  corpus: by order, the corpus counts of the block's distinct n-grams by ascending hash."""
    doc = np.repeat(np.arange(len(size)), size)
    counts = {}
    for order in range(1, ORDER + 1):
        h, at = ngrams(word, doc, order)
        values, gram = np.unique(h, return_inverse=True)
        if len(values) != len(corpus[order]):
            raise RuntimeError("the source returned other rows when it was read again; checkpoint it first")
        _, pair, mine = np.unique(doc[at] * np.int64(len(values) + 1) + gram, return_inverse=True, return_counts=True)
        c = np.full(len(word), -1, np.int64)  # -1: no n-gram of this order ends here
        c[at] = corpus[order].astype(np.int64)[gram] - mine[pair]
        counts[order] = c
    with np.errstate(divide="ignore", invalid="ignore"):
        score = np.log(np.maximum(counts[1], 1) / (total - size[doc]))
        for order in range(2, ORDER + 1):
            c = counts[order]
            before = np.concatenate([[0], counts[order - 1][:-1]])[: len(c)]  # of the n-gram without its last word
            score = np.where(c > 0, np.log(c / before), np.where(c == 0, score + np.log(ALPHA), score))
    sums = np.bincount(doc, score, len(size)) if len(doc) else np.zeros(len(size))
    return [s if n and total > n else None for s, n in zip(sums.tolist(), size.tolist(), strict=True)]


def _scored(total: int):
    """Complete runs of equal block -> (doc_id, n_words, log_score) of its texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _grouped(batches, ("block",), ("part", "grade", "counts", "vocabulary", "words", "sizes", "ids")):
            texts = [r for r in rows if r[0] is None]
            known = {(r[1], r[0]): r[2] for r in rows if r[0] is not None}  # rows of equal blocks are equal
            corpus = {k: np.concatenate([np.empty(0, np.uint64), *(_unpack(known[key], np.uint64) for key in sorted(known) if key[0] == k)]) for k in range(1, ORDER + 1)}
            if not texts:
                raise RuntimeError("the source returned other rows when it was read again; checkpoint it first")
            for _, _, _, vocabulary, words, sizes, ids in texts:  # more than one if blocks are equal row by row
                word = np.cumsum(_unpack(vocabulary, np.uint64), dtype=np.uint64)[_unpack(words, np.uint32)]
                size = _unpack(sizes, np.uint64).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(size, pa.int64()), pa.array(document_scores(word, size, corpus, total), pa.float64())],
                    names=["doc_id", "n_words", "log_score"])
    return run


def stupid_backoff(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, log_score): one row per row of ``docs`` (doc_id as bigint); the sum of the natural logarithms of its words' scores."""
    own = docs.select(named(doc_id).cast("bigint").alias("doc_id"), named(text).alias("text"))
    size, total = own.agg(F.sum(F.octet_length("text")), F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()
    parts, blocks = max(1, -(-(size or 0) // PART_BYTES)), max(1, -(-(size or 0) // BLOCK_BYTES))
    grams = python_map(own, _exploded(parts), "block binary, part bigint, grade int, hashes binary, counts binary")
    grams = grams.repartition(parts, "part", "grade").sortWithinPartitions("part", "grade", "block")
    counted = python_map(grams, _counted, "block binary, part bigint, grade int, counts binary")
    texts = python_map(own, _texts, "block binary, vocabulary binary, words binary, sizes binary, ids array<bigint>")
    met = counted.unionByName(texts, allowMissingColumns=True).repartition(blocks, "block").sortWithinPartitions("block")
    return python_map(met, _scored(total or 0), "doc_id bigint, n_words bigint, log_score double").withColumnRenamed("doc_id", doc_id)


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = stupid_backoff(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return scored.select("doc_id", "n_words", F.round(F.col("log_score") / F.col("n_words"), 6).alias("mean_log_score"))


#: Words joined with spaces; a word never holds one.
OP3_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
p AS (SELECT r, i, w[i] AS g1, CASE WHEN i > 1 THEN w[i - 1] || ' ' || w[i] END AS g2,
        CASE WHEN i > 2 THEN w[i - 2] || ' ' || w[i - 1] || ' ' || w[i] END AS g3
      FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
g AS (SELECT r, i, g1 AS x FROM p UNION ALL SELECT r, i, g2 FROM p WHERE g2 IS NOT NULL UNION ALL SELECT r, i, g3 FROM p WHERE g3 IS NOT NULL),
k AS (SELECT r, x, sum(n) OVER (PARTITION BY x) - n AS c FROM (SELECT r, x, count(*) AS n FROM g GROUP BY r, x)),
total AS (SELECT sum(len(w)) AS n FROM d),
c AS (SELECT p.r, p.i, k1.c AS c1, k2.c AS c2, k3.c AS c3 FROM p JOIN k AS k1 ON k1.r = p.r AND k1.x = g1
      LEFT JOIN k AS k2 ON k2.r = p.r AND k2.x = g2 LEFT JOIN k AS k3 ON k3.r = p.r AND k3.x = g3),
s AS (SELECT c.r, CASE
        WHEN c3 > 0 THEN ln(c3 / lag(c2) OVER o)
        WHEN c2 > 0 THEN ln(c2 / lag(c1) OVER o) + CASE WHEN c3 IS NULL THEN 0 ELSE ln(0.4) END
        ELSE ln(greatest(c1, 1) / (n - len(w))) + CASE WHEN c2 IS NULL THEN 0 ELSE ln(0.4) END + CASE WHEN c3 IS NULL THEN 0 ELSE ln(0.4) END END AS v
      FROM c JOIN d ON d.r = c.r, total WHERE n > len(w) WINDOW o AS (PARTITION BY c.r ORDER BY c.i))
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, round(t.v / nullif(len(w), 0), 6) AS mean_log_score
FROM d LEFT JOIN (SELECT r, sum(v) AS v FROM s GROUP BY r) AS t ON t.r = d.r
"""
