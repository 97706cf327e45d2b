"""Substring deduplication by content-defined chunking (operator 10).

A gear hash rolls over the bytes of a text; a place where its top bits are zero ends a chunk, between
``MIN_CHUNK`` and ``MAX_CHUNK`` bytes after the last end.  Places depend on the ``WINDOW`` bytes
before them only, so an insertion moves boundaries nearby and no others.  Chunks
are short, that a passage holds several; what is compared by digest is the run of whole
chunks, from each chunk on, that first reaches ``MIN_RUN`` bytes.  A run that occurs again (here or in another text)
is repeated; the union of the repeated runs of a text are its repeated spans.  Of equal
runs the one of the smallest (doc_id, text digest, place) stays; ``without_repeats`` cuts the others.

Digests are counted by a map-side combined aggregate and joined back to the runs, so a run that many texts share is
one small row before the shuffle; a run that one text holds many times is one row of that text throughout.  The runs that occur
again are kept as a table, of which the first occurrences are an aggregate.

Cases: a null, empty or short text has no run and no repeats; rows of equal doc_id and text repeat each other and
are cut alike (as one document: none is later than the other); a null doc_id sorts last, and each row with one is a document of its own: of
equal texts without an id one row, the least by a hash of all columns, is the first, and all runs of the others are later ones (copies of one text
without an id are numbered in one task); texts are taken whole; an empty table gives no rows; other columns pass ``without_repeats`` as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import named, prefix, python_map, schema_with, stored
from tidemark.llm.words import SPACED, chunks

#: Bytes: the gear hash's window, limits of a chunk, the mean distance of hash places, what a compared run reaches at least.
WINDOW, MIN_CHUNK, MAX_CHUNK, SPACING_BITS, MIN_RUN = 16, 16, 96, 4, 96
#: Of 1e13 different runs, two share a digest of 96 bits with a probability below one in a thousand.
DIGEST_BYTES = 12
#: A repeated span of so many words is a repeated passage.
PASSAGE_WORDS = 25
_COUNTS = ["n_repeated_runs", "repeated_words", "longest_repeat", "later_words"]


def gear(data: np.ndarray) -> np.ndarray:
    """Gear hash at each byte over the ``WINDOW`` bytes that end there: h = (h << 2) + gear[byte], all places at once."""
    table = np.random.Generator(np.random.PCG64(11)).integers(0, 1 << 32, 256, np.uint32)
    h, width = table[data], 1
    while width < WINDOW:
        wider = h.copy()
        wider[width:] += h[:-width] << np.uint32(2 * width)
        h, width = wider, 2 * width
    return h


def boundaries(marks: list[int], begin: int, end: int) -> list[int]:
    """Chunk ends of the text at [begin, end); ``marks``: places after which the hash allows a cut, ascending."""
    cuts, last = [], begin
    for m in marks:
        while m - last > MAX_CHUNK:
            last += MAX_CHUNK
            cuts.append(last)
        if m - last >= MIN_CHUNK:
            cuts.append(m)
            last = m
    while end - last > MAX_CHUNK:
        last += MAX_CHUNK
        cuts.append(last)
    if end > last:
        cuts.append(end)
    return cuts


def _tag(raw: bytes) -> int:
    """Tells rows of one doc_id (or of none) and different texts apart: of 1e7 texts, two share it with a probability of 3e-6."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(raw)).astype(np.int64))


def chunk_runs(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, list[int], np.ndarray, np.ndarray]]:
    """Per text: its row, its chunk starts and ends, and for each run (start, end) in bytes of the text."""
    marks = np.flatnonzero(gear(data) >> np.uint32(32 - SPACING_BITS) == 0) + 1
    at = np.searchsorted(marks, offsets)
    # a mark nearer than MIN_CHUNK to the text's start isn't used, so no window reaches into the text before
    listed = marks.tolist()
    for row in range(len(offsets) - 1):
        begin, end = int(offsets[row]), int(offsets[row + 1])
        cuts = boundaries(listed[at[row]:at[row + 1]], begin, end)
        starts, ends = np.array([begin, *cuts[:-1]] if cuts else [], np.int64), np.array(cuts, np.int64)
        to = np.searchsorted(ends, starts + MIN_RUN)
        full = to < len(ends)
        yield row, cuts, starts[full] - begin, ends[to[full]] - begin


def _runs(doc_id: str, text: str):
    """Texts -> (own_id, tag, high, low, n, b0, places): a row for each different run of a text; places are n times four 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(doc_id))
            for row0, _, data, offsets in chunks(batch.column(batch.schema.get_field_index(text))):
                raw = data.tobytes()
                in_word = SPACED.is_word[data]
                opens = in_word.copy()
                opens[1:] &= ~in_word[:-1]
                begins = offsets[:-1][np.diff(offsets) > 0]
                opens[begins] = in_word[begins]  # whatever ends the text before
                words = np.concatenate([[0], np.cumsum(opens)])  # words that begin before a place
                tags, own, digests, counts, first, places = [], [], [], [], [], []
                for row, _, starts, ends in chunk_runs(data, offsets):
                    if not len(starts):
                        continue
                    begin, end = int(offsets[row]), int(offsets[row + 1])
                    found: dict[bytes, list[bytes]] = {}
                    # words that begin inside; one that was begun before counts where it was begun
                    at = np.stack([starts, ends, words[begin + starts] - words[begin], words[begin + ends] - words[begin]], axis=1).astype(np.int32).tobytes()
                    for k, (a, b) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)):
                        found.setdefault(xxhash.xxh3_128_digest(raw[begin + a:begin + b])[:DIGEST_BYTES], []).append(at[16 * k:16 * k + 16])
                    digests += found
                    counts += map(len, found.values())
                    packed = [b"".join(v) for v in found.values()]
                    first += [int.from_bytes(p[:4], "little") for p in packed]
                    places += packed
                    tags += [_tag(raw[begin:end])] * len(found)
                    own += [ids[row0 + row].as_py()] * len(found)
                if tags:
                    both = np.frombuffer(b"".join(digests), np.int32).reshape(-1, 3)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own, ids.type), pa.array(tags, pa.int64()), pa.array(np.ascontiguousarray(both[:, :2]).view(np.int64).ravel()), pa.array(both[:, 2]), pa.array(counts, pa.int32()),
                         pa.array(first, pa.int32()), pa.array(places, pa.binary())],
                        names=["own_id", "tag", "high", "low", "n", "b0", "places"])
    return run


def _tagged(text: str, into: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row0, row1, data, offsets in chunks(batch.column(batch.schema.get_field_index(text))):
                raw = data.tobytes()
                tags = [_tag(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                part = batch.slice(row0, row1 - row0)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(tags, pa.int64())], names=[*part.schema.names, into])
    return run


def _found(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(own_id, tag, runs): for each text with a repeated run, these runs; home says whether their first occurrence is in this text, at b0."""
    own = docs.select(named(doc_id).alias("doc_id"), named(text).alias("text"))
    ids = own.schema["doc_id"].dataType.simpleString()
    runs = python_map(own, _runs("doc_id", "text"), f"own_id {ids}, tag bigint, high bigint, low int, n int, b0 int, places binary")
    # digests are counted alone; only runs that occur again are compared by their first occurrence
    repeated = runs.groupBy("high", "low").agg(F.sum("n").alias("total")).filter("total > 1").drop("total")
    again = stored(runs.drop("n").join(repeated, ["high", "low"], "left_semi"))
    first = F.struct(F.col("own_id").isNull().alias("null"), "own_id", "tag", "b0")
    again = again.drop("b0").join(again.groupBy("high", "low").agg(F.min(first).alias("first")), ["high", "low"])
    home = F.when(F.col("own_id").eqNullSafe(F.col("first.own_id")) & (F.col("tag") == F.col("first.tag")), F.col("first.b0")).otherwise(F.lit(-1))
    # equal rows give equal runs: a set
    return again.groupBy("own_id", "tag").agg(F.collect_set(F.struct("places", home.alias("home"))).alias("runs"))


def _places(runs) -> tuple[np.ndarray, np.ndarray]:
    """All places of a text's repeated runs as rows (b0, b1, w0, w1), sorted, and whether each is a later occurrence."""
    at = [np.frombuffer(r["places"], np.int32).reshape(-1, 4) for r in runs]
    later = np.concatenate([a[:, 0] != r["home"] for a, r in zip(at, runs, strict=True)])
    every = np.concatenate(at)
    order = np.lexsort((every[:, 1], every[:, 0]))
    return every[order], later[order]


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of each text -> words in the union of all and of the later ones, longest span of the union in words."""
    for batch in batches:
        out = []
        for runs in batch.column(2).to_pylist():
            at, later = _places(runs)
            total, longest = _length(at[:, 2], at[:, 3])
            cut, _ = _length(at[later][:, 2], at[later][:, 3])
            out.append((len(at), total, longest, cut))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array([r[k] for r in out], pa.int64()) for k in range(4))],
                                         names=["own_id", "tag", *_COUNTS])


def _length(lo: np.ndarray, hi: np.ndarray) -> tuple[int, int]:
    """Size of the union of ranges (sorted by lo) and of its longest part."""
    if not len(lo):
        return 0, 0
    reach = np.maximum.accumulate(hi)
    new = np.r_[True, lo[1:] > reach[:-1]]
    size = reach[np.r_[np.flatnonzero(new)[1:] - 1, len(lo) - 1]] - lo[new]
    return int(size.sum()), int(size.max())


def _with_tag(docs: DataFrame, text: str, into: str) -> DataFrame:
    return python_map(docs, _tagged(text, into), schema_with(docs, into, "bigint"))


def _numbered(docs: DataFrame, doc_id: str, text: str, tag: str, copy: str) -> DataFrame:
    """``docs`` with the text's tag and, of rows without an id, the number of the row among those of equal text (else 1)."""
    known = _with_tag(docs.filter(named(doc_id).isNotNull()), text, tag).withColumn(copy, F.lit(1))
    hashed = [named(f.name) for f in docs.schema if "map<" not in f.dataType.simpleString()]  # Spark hashes no maps
    order = Window.partitionBy(tag).orderBy(F.xxhash64(*hashed))
    unknown = _with_tag(docs.filter(named(doc_id).isNull()), text, tag).withColumn(copy, F.row_number().over(order))
    return known.union(unknown)


def repeated_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_repeated_runs, repeated_words, longest_repeat, later_words, has_passage)."""
    own = docs.select(named(doc_id).alias("doc_id"), named(text).alias("text"))
    ids = own.schema["doc_id"].dataType.simpleString()
    found = python_map(_found(own, "doc_id", "text"), _summed, f"own_id {ids}, tag bigint, " + ", ".join(f"{c} bigint" for c in _COUNTS))
    keyed = _numbered(own, "doc_id", "text", "row_tag", "copy").drop("text")
    joined = keyed.join(found, (F.col("row_tag") == F.col("tag")) & F.col("doc_id").eqNullSafe(F.col("own_id")), "left")
    joined = joined.withColumn("later_words", F.when(F.col("copy") > 1, F.col("repeated_words")).otherwise(F.col("later_words")))
    counts = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in _COUNTS]
    return joined.select(F.col("doc_id").alias(doc_id), *counts, (F.coalesce("longest_repeat", F.lit(0)) >= PASSAGE_WORDS).alias("has_passage"))


def _cut(text: str, runs: str, copy: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            out = []
            for t, found, number in zip(*(batch.column(k).to_pylist() for k in (at, *map(batch.schema.get_field_index, (runs, copy)))), strict=True):
                if t is not None and found:
                    raw, kept, last = t.encode(), [], 0
                    places, later = _places(found)
                    for b0, b1 in (places if number > 1 else places[later])[:, :2].tolist():
                        kept.append(raw[last:max(last, b0)])
                        last = max(last, b1)
                    # a cut inside a character takes the rest of it along
                    t = b"".join([*kept, raw[last:]]).decode(errors="ignore")
                out.append(t)
            columns = [pa.array(out, pa.string()) if k == at else batch.column(k) for k in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names).drop_columns([runs, copy])
    return run


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with later occurrences of repeated runs cut out of the texts; the first occurrence stays."""
    start = prefix(docs, "_found")
    tag, runs, own, copy = f"{start}_row", f"{start}_runs", f"{start}_id", f"{start}_copy"
    found = _found(docs, doc_id, text).select(F.col("own_id").alias(own), F.col("tag").alias(f"{start}_tag"), F.col("runs").alias(runs))
    keyed = _numbered(docs, doc_id, text, tag, copy)
    joined = keyed.join(found, (F.col(tag) == F.col(f"{start}_tag")) & named(doc_id).eqNullSafe(F.col(own)), "left")
    return python_map(joined.select(*map(named, docs.columns), F.col(runs), F.col(copy)), _cut(text, runs, copy), docs.schema)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(spark.read.parquet(f"{sf_dir}/documents.parquet"))
