"""N-gram Jaccard self-join with a MinHash LSH forest (operator 7).

A text is the set of its five-word shingles (words ``[^\\x20\\x09-\\x0D]+``; a text of fewer words is one
shingle).  Texts of equal sets are copies and form one class; everything after works on classes, named
by a 128-bit digest of the set.

Forest: every tree labels a class with ``DEPTH`` MinHash values.  Sorted by label, classes that share
a prefix stand together.  Matching begins at the whole label and the prefix is shortened level by level until a pair at the
threshold is met in some tree with probability ``RECALL`` (``prefix_length``).  The prefix groups of that
level hold those of all longer prefixes.  Group members are tied to the group's
smallest member (one row each, no pairs), and connected into candidate clusters.

Verification is exact: the shingle sets of a candidate cluster are laid out in tiles of ``TILE`` classes, and
every two tiles meet in one task, which intersects the sets and adds up each class's links.  So pairs are counted
where they meet and never written; a large cluster is many tiles.  Only a spanning
forest of the true links leaves a task; its components are the near-duplicate groups.

Cases: a null, empty or wordless text has no shingles, links to nothing and is a group of its own
(``class_id`` is its doc_id); equal rows are copies of each other; a null doc_id takes part, and a group of only such
rows has a null id; texts are taken whole; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.frames import checkpointed, named, python_map, schema_with, spare
from tidemark.llm.words import SPACED, Words, chain, chunks, words_of

SHINGLE, THRESHOLD = 5, 0.8
TREES, DEPTH, RECALL = 24, 8, 0.9999
#: Classes on one side of a tile of the verification.
TILE = 256
_U = np.uint64


def prefix_length(trees: int = TREES, depth: int = DEPTH, threshold: float = THRESHOLD, recall: float = RECALL) -> int:
    """Shorten the prefix from the whole label until pairs at the threshold are met with the wanted probability."""
    while depth > 1 and 1 - (1 - threshold ** depth) ** trees < recall:
        depth -= 1
    return depth


def shingle_sets(words: Words, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(first, shingles): the distinct shingles of each row, sorted, at first[row] to first[row + 1]."""
    grams, at = words.grams(n)
    row = words.doc[at]
    count = np.diff(words.first)
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):  # the whole text is the one shingle
        whole = []
        for r in short.tolist():
            h = np.zeros(1, np.uint64)
            for w in words.hash[words.first[r]: words.first[r + 1]]:
                h = chain(h, w)
            whole.append(chain(h, _U(count[r])))
        grams, row = np.concatenate([grams, *whole]), np.concatenate([row, short])
    order = np.lexsort((grams, row))
    grams, row = grams[order], row[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (row[1:] != row[:-1])
    grams, row = grams[new], row[new]
    return np.searchsorted(row, np.arange(words.n + 1)), grams


def _coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.Generator(np.random.PCG64(7))
    return draw.integers(0, 1 << 32, n, np.uint32) | np.uint32(1), draw.integers(0, 1 << 32, n, np.uint32)


def labels(first: np.ndarray, grams: np.ndarray, rows: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """Prefix hash of each given (non-empty) row in each tree: rows x trees."""
    out = np.zeros((len(rows), trees), np.uint64)
    a, b = _coefficients(trees * DEPTH)
    for lo in range(0, len(rows), 2048):
        part = rows[lo:lo + 2048]
        size = first[part + 1] - first[part]
        starts = np.cumsum(size) - size
        at = np.arange(size.sum()) + np.repeat(first[part] - starts, size)
        low, high = grams[at].astype(np.uint32), (grams[at] >> _U(32)).astype(np.uint32)
        for t in range(trees):
            h = np.full(len(part), t, np.uint64)
            for k in range(t * DEPTH, t * DEPTH + depth):
                h = chain(h, np.minimum.reduceat((low if k & 1 else high) * a[k] + b[k], starts).astype(np.uint64))
            out[lo:lo + len(part), t] = h
    return out


def _digest_list(first: np.ndarray, raw: bytes) -> list[bytes | None]:
    """A digest of each row's shingle set; none for an empty one."""
    return [hashlib.blake2b(raw[8 * a:8 * b], digest_size=16).digest() if b > a else None for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]


def _sets(text: str, with_labels: int, with_set: bool):
    """Texts -> digest and size of each row's shingle set; with the labels of each row, or with the sets themselves (once a task)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[bytes] = set()
        for batch in batches:
            column = batch.schema.get_field_index(text)
            for row, end, data, offsets in chunks(batch.column(column)):
                first, grams = shingle_sets(words_of(data, offsets, SPACED))
                size = np.diff(first)
                raw = grams.tobytes()
                digests = _digest_list(first, raw)
                part = batch.slice(row, end - row)
                more = {"digest": pa.array(digests, pa.binary()), "n_shingles": pa.array(size.astype(np.int64))}
                if with_labels:
                    full = np.flatnonzero(size)
                    flat = labels(first, grams, full, TREES, with_labels).view(np.int64).ravel()
                    ends = np.concatenate([[0], np.cumsum(np.where(size > 0, TREES, 0))]).astype(np.int32)
                    more["labels"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                if with_set:
                    more["shingles"] = pa.array([raw[8 * a:8 * b] for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)], pa.binary())
                keep = [k for k in range(part.num_columns) if k != column]
                out = pa.RecordBatch.from_arrays([*(part.column(k) for k in keep), *more.values()], names=[*(part.schema.names[k] for k in keep), *more])
                if with_set:  # a task sends a set that many texts share once
                    new = [d is not None and d not in sent and not sent.add(d) for d in digests]
                    out = out.filter(pa.array(new, pa.bool_()))
                yield out
    return run


_LINKS = "cluster binary, digest binary, other binary, links bigint"


def _parts(rows: np.ndarray, size: np.ndarray, most: int = 1 << 20) -> list[np.ndarray]:
    """``rows`` in order, in parts of about ``most`` shingles."""
    return np.split(rows, np.flatnonzero(np.diff(np.cumsum(size[rows]) // most)) + 1)


def _marked(mark: np.ndarray, ids: np.ndarray, first: np.ndarray, size: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """How many shingles of each row are marked."""
    n = size[rows]
    starts = np.cumsum(n) - n
    return np.add.reduceat(mark[ids[np.arange(n.sum()) + np.repeat(first[rows] - starts, n)]], starts, dtype=np.int64)


def _verify(threshold: float):
    """Complete runs of equal (cluster, i, j) in sorted input -> links of each class, and a spanning forest of links."""

    def tile(rows: list[tuple]) -> list[tuple]:
        cluster, i, j = rows[0][:3]
        side = np.array([r[3] for r in rows])
        copies = np.array([r[5] for r in rows], np.int64)
        sets = [np.frombuffer(r[6], np.uint64) for r in rows]
        size = np.array([len(s) for s in sets])
        values, ids = np.unique(np.concatenate(sets), return_inverse=True)
        first = np.concatenate([[0], np.cumsum(size)])
        mark = np.zeros(len(values), np.uint8)
        root = list(range(len(rows)))
        links = np.zeros(len(rows), np.int64)
        forest = []

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        by_size = np.argsort(size, kind="stable")
        ranked = size[by_size]
        for at, x in enumerate(by_size.tolist()):
            # partners after x in order of size: not smaller, and not so large that the ratio alone rules them out
            most = np.searchsorted(ranked, size[x] / threshold, "right")
            to = by_size[at + 1:most]
            if i != j:
                to = to[side[to] != side[x]]
            if not len(to):
                continue
            mark[ids[first[x]:first[x + 1]]] = 1
            shared = np.concatenate([_marked(mark, ids, first, size, part) for part in _parts(to, size)])
            mark[ids[first[x]:first[x + 1]]] = 0
            near = to[shared >= threshold * (size[x] + size[to] - shared) - 1e-9]
            links[x] += copies[near].sum()
            links[near] += copies[x]
            for y in near.tolist():
                p, q = find(x), find(y)
                if p != q:
                    root[p] = q
                    forest.append((cluster, rows[x][4], rows[y][4], 0))
        return forest + [(cluster, r[4], None, int(k)) for r, k in zip(rows, links, strict=True) if k]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def out(found):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), (pa.binary(),) * 3 + (pa.int64(),), strict=True)],
                                              names=["cluster", "digest", "other", "links"])

        for batch in batches:
            found: list[tuple] = []
            for r in zip(*(batch.column(k).to_pylist() for k in range(7)), strict=True):
                if held and held[0][:3] != r[:3]:
                    found += tile(held)
                    held = []
                held.append(r)
            if found:
                yield out(found)
        if held and (found := tile(held)):
            yield out(found)
    return run


def linked_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """((doc_id, digest, n_shingles) of every row, (digest, class_id, chosen, n_copies, n_links) of every shingle set).

    chosen: this set holds the document that its group keeps, the one of the smallest doc_id (null last), then digest."""
    depth = prefix_length(threshold=threshold)
    own = docs.select(named(doc_id).alias("doc_id"), named(text).alias("text"))
    ids = own.schema["doc_id"].dataType.simpleString()
    signed = python_map(own, _sets("text", depth, False), f"doc_id {ids}, digest binary, n_shingles bigint, labels array<bigint>")
    signed = checkpointed(signed.select("doc_id", "digest", "n_shingles", "labels"))
    classes = signed.filter("digest IS NOT NULL").groupBy("digest").agg(
        F.count("*").alias("n_copies"), F.min("doc_id").alias("least_id"), F.first("labels").alias("labels"))
    classes = checkpointed(classes)
    # forest: tie the members of each prefix group to its smallest
    member = classes.select("digest", F.posexplode("labels").alias("tree", "label"))
    heads = member.groupBy("tree", "label").agg(F.min("digest").alias("head"), F.count("*").alias("n")).filter("n > 1").drop("n")
    ties = member.join(heads, ["tree", "label"]).filter("digest <> head").select(F.col("digest").alias("a"), F.col("head").alias("b"))
    clusters = components(ties)
    clusters = clusters.join(classes.select(F.col("digest").alias("node"), "n_copies"), "node")
    clusters = checkpointed(clusters.select("node", "root", "n_copies"))
    # exact verification in tiles
    sizes = clusters.groupBy("root").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    placed = clusters.join(sizes, "root").withColumn("tile", F.expr("CAST(pmod(xxhash64(node), tiles) AS INT)"))
    sets = python_map(own, _sets("text", 0, True), f"doc_id {ids}, digest binary, n_shingles bigint, shingles binary")
    sets = sets.select(F.col("digest").alias("node"), "shingles").join(clusters.select("node"), "node", "left_semi")
    sets = sets.groupBy("node").agg(F.first("shingles").alias("shingles"))
    placed = placed.join(sets, "node").withColumn("to", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    tiles = placed.select(
        F.col("root").alias("cluster"), F.least("tile", "to").alias("i"), F.greatest("tile", "to").alias("j"),
        F.col("tile").alias("side"), F.col("node").alias("digest"), "n_copies", "shingles")
    tiles = tiles.repartition(F.col("cluster"), F.col("i"), F.col("j")).sortWithinPartitions("cluster", "i", "j", "digest")
    verified = checkpointed(python_map(tiles, _verify(threshold), _LINKS))
    links = verified.filter("other IS NULL").groupBy("digest").agg(F.sum("links").alias("links"))
    groups = components(verified.filter("other IS NOT NULL").select(F.col("digest").alias("a"), F.col("other").alias("b")))
    rooted = classes.select("digest", "n_copies", "least_id").join(groups.withColumnRenamed("node", "digest"), "digest", "left").join(links, "digest", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "digest"))
    first = F.struct(F.col("least_id").isNull().alias("n"), "least_id", "digest")
    heads = rooted.groupBy("root").agg(F.min(first).alias("head"))
    found = rooted.join(heads, "root").select(
        "digest", F.col("head.least_id").alias("class_id"), (F.col("digest") == F.col("head.digest")).alias("chosen"), "n_copies",
        (F.col("n_copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    return signed.select("doc_id", "digest", "n_shingles"), found


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id, n_shingles, n_copies, n_links): one row per row of ``docs``.

    class_id: smallest doc_id of the near-duplicate group (links of at least ``threshold``, joined transitively);
    n_copies: rows of the same shingle set; n_links: other rows with a similarity of at least ``threshold``, copies included."""
    rows, found = linked_classes(docs, doc_id, text, threshold)
    joined = rows.join(found, "digest", "left")
    return joined.select(
        F.col("doc_id").alias(doc_id), F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), "n_shingles",
        F.coalesce("n_copies", F.lit(1).cast("bigint")).alias("n_copies"), F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"))


def _digests(text: str, into: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in chunks(batch.column(batch.schema.get_field_index(text))):
                first, grams = shingle_sets(words_of(data, offsets, SPACED))
                part = batch.slice(row, end - row)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(_digest_list(first, grams.tobytes()), pa.binary())], names=[*part.schema.names, into])
    return run


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row of ``docs`` for each near-duplicate group, columns as given; rows without shingles all stay."""
    _, found = linked_classes(docs, doc_id, text, threshold)
    digest, kept = spare(docs, "_digest"), spare(docs, "_kept")
    keyed = python_map(docs, _digests(text, digest), schema_with(docs, digest, "binary"))
    chosen = found.filter("chosen").select(F.col("digest").alias(kept), F.col("class_id").alias(f"{kept}_id"))
    # by set and id: copies have ids of their own, so a mass of copies spreads
    same = (named(digest) == F.col(kept)) & named(doc_id).eqNullSafe(F.col(f"{kept}_id"))
    first = keyed.join(chosen, same, "left_semi").dropDuplicates([digest, doc_id])
    return first.unionByName(keyed.filter(named(digest).isNull())).select(*map(named, docs.columns))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
