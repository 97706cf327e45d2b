"""Hard-negative mining: rows of other labels that score close below an anchor's positives.

Every component x of a vector becomes ``floor(scale * x)``; the score of a row is its integer inner product with the
anchor, higher first, ties by the smaller id.  An anchor's positives are its best rows of its own label; the negatives
of a positive are the best rows of other labels whose score lies in a window of shares of the positive's score.

Method: Fagin's threshold algorithm.  A shard of candidate rows holds one sorted list per dimension.  An anchor
reads each list from its high end where the anchor's component is positive and from its low end where it is negative
(sorted access), scores every row it meets for the first time in full (random access, integers), and adds up what
the lists' last-read values would score.  No unread row can score more than that threshold, so the search ends once
the threshold lies strictly below the k-th score of each window (ties of the k-th have then been read), below
the window itself, or when every row has been met.

Spark deals the rows into shards and the anchors into slices; a (shard, slice) cell is one group of a cogroup, so a task holds
``SHARD_ROWS`` rows and ``SLICE_ANCHORS`` anchors at most on average, whatever the sizes of tables and labels.  Shards send
their first k rows per anchor (and positive), which one window ranks.  Nothing but two counts reaches the driver.

Defined results: rows with a null id, label or vector, or with a null or non-finite component take no part.
Equal rows, and different rows of one id, count as one: the least by (label, vector).  Shorter vectors are filled up with zeros;
an empty one scores 0.  Integers beyond +-2**23 are set to that bound, so that 65,536 products add up within 64 bits.
An empty table, or one without anchors, gives no rows.  Further columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import named, ship

#: Rows of a shard at most (on average), and the least rows worth a shard of its own while there are few shards.
SHARD_ROWS, LEAST_ROWS, FEW_SHARDS = 65_536, 1_024, 64
#: Anchors that a cell holds at most (on average).
SLICE_ANCHORS = 20_000
#: Sorted accesses per list in the first round; each round doubles the depth.
FIRST_DEPTH = 32
BOUND = 1 << 23


class SortedLists:
    """A shard's rows, by ascending id, and one sorted list per dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels = ids, labels
        # doubles hold sums of products exactly below 2**53 and are multiplied much faster
        most = float(np.abs(vectors).max(initial=0))
        self.exact = np.float64 if vectors.shape[1] * most * BOUND < 2 ** 53 else np.int64
        self.vectors = vectors.astype(self.exact)
        self.up = np.ascontiguousarray(np.argsort(vectors, axis=0, kind="stable").T.astype(np.int32))

    def reads(self, anchor: np.ndarray):
        """Rounds of (rows met for the first time, their scores, threshold for all others)."""
        n = len(self.ids)
        anchor = anchor.astype(self.exact)
        dims = np.flatnonzero(anchor)
        if not n or not len(dims):
            yield np.arange(n), np.zeros(n, np.int64), -np.inf
            return
        weight, high = anchor[dims], anchor[dims] > 0
        met = np.zeros(n, bool)
        lo, hi = 0, min(FIRST_DEPTH, n)
        while True:
            read = np.where(high[:, None], self.up[dims, n - hi:n - lo][:, ::-1], self.up[dims, lo:hi])
            new = np.unique(read[~met[read]])
            met[new] = True
            scores = (self.vectors[new] @ anchor).astype(np.int64)
            done = hi == n or met.all()
            yield new, scores, -np.inf if done else int(weight @ self.vectors[read[:, -1], dims])
            if done:
                return
            lo, hi = hi, min(2 * hi, n)


def first_rows(lists: SortedLists, anchor: np.ndarray, wanted: np.ndarray, windows: list[tuple[float, float]], k: int):
    """For each window of scores, the first ``k`` wanted rows inside (rows, scores), found by the threshold algorithm."""
    best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in windows]
    for new, scores, threshold in lists.reads(anchor):
        keep = wanted[new]
        new, scores = new[keep], scores[keep]
        open_windows = False
        for w, (low, high) in enumerate(windows):
            fit = (scores >= low) & (scores <= high)
            rows, got = np.concatenate([best[w][0], new[fit]]), np.concatenate([best[w][1], scores[fit]])
            order = np.lexsort((rows, -got))[:k]  # rows stand by ascending id
            best[w] = rows[order], got[order]
            least = best[w][1][-1] if len(order) == k else -np.inf
            open_windows |= not (threshold < least or threshold < low)
        if not open_windows:
            break
    return best


def _lengths(column: pa.ChunkedArray) -> np.ndarray:
    return pc.list_value_length(column).to_numpy().astype(np.int64)


def _width(column: pa.ChunkedArray) -> int:
    return int(_lengths(column).max(initial=0))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows, filled up with zeros to ``width``."""
    lengths = _lengths(column)
    out = np.zeros((len(lengths), width), np.int64)
    place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[np.repeat(np.arange(len(lengths)), lengths), place] = pc.list_flatten(column).to_numpy()
    return out


def _lists(rows: pa.Table, width: int) -> SortedLists:
    ids, labels = rows["id"].to_numpy(), rows["label"].to_numpy()
    vectors = _matrix(rows["vector"], width)
    order = np.argsort(ids, kind="stable")
    ids, labels, vectors = ids[order], labels[order], vectors[order]
    first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1])[:len(ids)])
    if len(first) < len(ids):  # several rows of an id: the least by (label, vector), vectors as they came
        given = rows["vector"].to_pylist()
        ends = np.append(first[1:], len(ids))
        first = np.array([min(range(a, b), key=lambda r: (labels[r], given[order[r]])) for a, b in zip(first, ends)])
    return SortedLists(ids[first], labels[first], vectors[first])


_POSITIVE = "anchor_id bigint, positive_id bigint, positive_score bigint"
_NEGATIVE = _POSITIVE + ", negative_id bigint, negative_score bigint"


def _columns(values: list[list[int]], names: list[str]) -> pa.Table:
    return pa.table([pa.array(v, pa.int64()) for v in values], names=names)


def _positives(k: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        width = max(_width(rows["vector"]), _width(anchors["query"]))
        lists, vectors = _lists(rows, width), _matrix(anchors["query"], width)
        out = [[], [], []]
        for a, (anchor, label) in enumerate(zip(anchors["anchor"].to_pylist(), anchors["own"].to_pylist())):
            wanted = (lists.labels == label) & (lists.ids != anchor)
            [(found, scores)] = first_rows(lists, vectors[a], wanted, [(-np.inf, np.inf)], k)
            out[0] += [anchor] * len(found)
            out[1] += lists.ids[found].tolist()
            out[2] += scores.tolist()
        return _columns(out, ["anchor_id", "positive_id", "positive_score"])
    return run


def _negatives(k: int, low: int, high: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        width = max(_width(rows["vector"]), _width(anchors["query"]))
        lists, vectors = _lists(rows, width), _matrix(anchors["query"], width)
        out = [[], [], [], [], []]
        for a, (anchor, label, positives) in enumerate(zip(*(anchors[c].to_pylist() for c in ("anchor", "own", "positives")))):
            # low * p <= 100 * score <= high * p in whole numbers
            windows = [(-(-low * p["score"] // 100), high * p["score"] // 100) for p in positives]
            for p, (found, scores) in zip(positives, first_rows(lists, vectors[a], lists.labels != label, windows, k)):
                out[0] += [anchor] * len(found)
                out[1] += [p["id"]] * len(found)
                out[2] += [p["score"]] * len(found)
                out[3] += lists.ids[found].tolist()
                out[4] += scores.tolist()
        return _columns(out, ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])
    return run


def hard_negatives(rows: DataFrame, is_anchor: Column, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
                   scale: int = 256, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for every anchor and positive.

    ``is_anchor`` is a condition over the columns of ``rows``; ``low`` and ``high`` are per cent of the positive's score."""
    ship(rows.sparkSession)
    usable = F.forall(named(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    live = rows.filter(named(vec_id).isNotNull() & named(label).isNotNull() & named(vector).isNotNull()).filter(usable)
    whole = F.transform(named(vector), lambda x: F.least(F.greatest(F.floor(F.lit(scale) * x.cast("double")).cast("double"),
                                                                    F.lit(-float(BOUND))), F.lit(float(BOUND))).cast("int"))
    live = live.select(named(vec_id).cast("bigint").alias("id"), named(label).cast("bigint").alias("label"), whole.alias("vector"),
                       F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"))
    n_rows, n_anchors = live.agg(F.count("*"), F.count_if("is_anchor")).first()
    shards = max(1, min(-(-n_rows // LEAST_ROWS), FEW_SHARDS), -(-n_rows // SHARD_ROWS))
    slices = max(1, -(-n_anchors // SLICE_ANCHORS))

    def part(n, of="id"):
        return F.pmod(F.xxhash64(of, F.lit(7)), F.lit(n)).cast("int")

    def every(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    cells = live.select(part(shards).alias("shard"), every(slices).alias("slice"), "id", "label", "vector")
    anchors = live.filter("is_anchor").groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row"))
    anchors = anchors.select(F.col("id").alias("anchor"), F.col("row.label").alias("own"), F.col("row.vector").alias("query"))

    def search(queries: DataFrame, function, schema: str) -> DataFrame:
        queries = queries.select(every(shards).alias("shard"), part(slices, "anchor").alias("slice"), *queries.columns)
        return cells.groupBy("shard", "slice").cogroup(queries.groupBy("shard", "slice")).applyInArrow(function, schema)

    def first(found: DataFrame, keys: list[str], score: str, row: str, k: int) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.col(score).desc(), F.col(row))
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    close = first(search(anchors, _positives(positives), _POSITIVE), ["anchor_id"], "positive_score", "positive_id", positives)
    # at most ``positives`` entries a list
    wanted = close.groupBy("anchor_id").agg(F.collect_list(F.struct(F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))).alias("positives"))
    queries = anchors.join(wanted.withColumnRenamed("anchor_id", "anchor"), "anchor")
    far = search(queries, _negatives(negatives, low, high), _NEGATIVE)
    out = first(far, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives)
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


OP11_SQL = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
       list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label AS own, e.vec_id, e.label, CAST(list_inner_product(a.v, e.v) AS BIGINT) AS score
  FROM e a JOIN e ON e.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE label = own QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id
WHERE s.label <> s.own AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
QUALIFY rank <= 10
"""
