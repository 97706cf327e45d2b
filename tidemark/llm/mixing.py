"""Mixing sources to target weights by systematic sampling (operator 6).

Sizes are words ``[^\\x20\\x09-\\x0D]+``.  Sources, by code point and null last, weigh 1, 2, 3, 1, 2, 3, ... and share
the size of all documents; a target stops at ``MOST`` times its source's size and the excess goes to the others
by weight.  That level is found in closed form: ordered by size / weight, the sources that stop are a prefix.

Every document of a source has the same expected copies, target / source size, so the prefix sum at a
document is its rank times that.  One random offset per source is added, and a document is emitted once per integer that the
sum crosses at it.  Documents are ranked by (size, bucket, doc_id, text hash): the order by size keeps
the words taken within about one document's size of the target.

Ranks without a window over a whole source: documents are counted by (source, size, bucket), a bucket being one of
``BUCKETS`` hash values of the doc_id, and the counts are summed up over sizes and then over buckets; the only window over documents is
within one (source, size, bucket), so neither a hot source nor thousands of copies of a text meet in one task.
Windows over sources, and over the sizes of one source, see one row each.

Cases: a null source is a source of its own; a null or empty text has size 0 and takes part (0 words
either way); a source of size 0 has target 0; a null doc_id is placed by its text's hash; repeated rows are
documents of their own; an empty table gives no rows; other columns pass through ``mix`` untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import named, prefix, spare

#: Weights in turn, the limit on a target, hash buckets of a (source, size), the seed of the offsets.
WEIGHTS, MOST, BUCKETS, SEED = (1, 2, 3), 3, 1024, "mix-1"
WORDS = r"[^\x20\x09-\x0D]+"


def _unit(text: F.Column) -> F.Column:
    """A number in [0, 1) from the first 8 hexadecimal digits of a text's MD5."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def targets(sizes: DataFrame) -> DataFrame:
    """``sizes`` (key, source_size; a row for each source) with target: the water level under the limits."""
    everything = Window.partitionBy()
    by_key, by_ratio = Window.orderBy("key"), Window.orderBy("ratio", "key")
    turn = (F.row_number().over(by_key) - 1) % len(WEIGHTS)
    out = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), turn + 1).cast("double"))
    out = out.withColumn("most", F.lit(float(MOST)) * F.col("source_size")).withColumn("ratio", F.col("most") / F.col("weight"))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything).cast("double")
    out = out.withColumn("level", (total - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(onward))
    # the level at the first source that doesn't stop holds for all that follow
    out = out.withColumn("stops", F.col("ratio") <= F.col("level"))
    level = F.min(F.when(~F.col("stops"), F.struct("ratio", "key", "level"))).over(everything)["level"]
    return out.withColumn("final", level).withColumn("target", F.when(F.col("stops") | F.col("final").isNull(), F.col("most")).otherwise(
        F.least(F.col("final") * F.col("weight"), F.col("most")))).select("key", "source_size", "target")


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", into: str = "mix") -> DataFrame:
    """``docs`` with a struct column ``into`` (``spare`` of it, if there is one): size, source_size, target, copies."""
    into, own_names = spare(docs, into), prefix(docs, "_mix_")
    own = own_names + "own"
    row = F.xxhash64(named(text))
    key = F.coalesce(F.concat(F.lit("0"), named(source)), F.lit("1"))
    bucket = F.conv(F.substring(F.md5(F.coalesce(named(doc_id).cast("string"), row.cast("string"))), 1, 6), 16, 10).cast("int") % BUCKETS
    size = F.coalesce(F.regexp_count(named(text), F.lit(WORDS)), F.lit(0)).cast("bigint")
    keyed = F.struct(key.alias("key"), size.alias("size"), bucket.alias("bucket"), row.alias("row"))
    cell = ["key", "size", "bucket"]
    counted = docs.select(keyed.alias(own)).groupBy(*(F.col(f"{own}.{c}") for c in cell)).agg(F.count("*").alias("n"))
    by_size = counted.groupBy("key", "size").agg(F.sum("n").alias("n"))
    sized = targets(by_size.groupBy("key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")))
    before = Window.partitionBy("key").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_size.withColumn("size_start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n").join(sized, "key")
    within = Window.partitionBy("key", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    cells = counted.withColumn("bucket_start", F.coalesce(F.sum("n").over(within), F.lit(0))).join(starts, ["key", "size"])
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    cells = cells.select(*cell, (F.col("size_start") + F.col("bucket_start")).alias("start"), "source_size", "target",
                         expected.alias("expected"), _unit(F.concat(F.lit(SEED), F.col("key"))).alias("offset"))
    cells = cells.select(F.struct(*cell).alias("cell"), F.struct("start", "source_size", "target", "expected", "offset").alias("at"))
    at, cell_name, rank = own_names + "at", own_names + "cell", own_names + "rank"
    cells = cells.select(*(F.col(f"cell.{c}").alias(f"{cell_name}_{c}") for c in cell), F.col("at").alias(at))
    ranked = docs.withColumn(own, keyed)
    for c in cell:
        ranked = ranked.withColumn(f"{cell_name}_{c}", F.col(f"{own}.{c}"))
    place = Window.partitionBy(*(f"{cell_name}_{c}" for c in cell)).orderBy(named(doc_id), F.col(f"{own}.row"))
    ranked = ranked.withColumn(rank, F.row_number().over(place)).join(cells, [f"{cell_name}_{c}" for c in cell])
    sums = (F.col(f"{at}.start") + F.col(rank)).cast("double")
    copies = F.floor(sums * F.col(f"{at}.expected") + F.col(f"{at}.offset")) - F.floor((sums - 1) * F.col(f"{at}.expected") + F.col(f"{at}.offset"))
    mixed = F.struct(F.col(f"{own}.size").alias("size"), F.col(f"{at}.source_size").alias("source_size"), F.col(f"{at}.target").alias("target"), copies.cast("bigint").alias("copies"))
    return ranked.select(*map(named, docs.columns), mixed.alias(into))


def mixture(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is emitted, columns as given."""
    into = spare(docs, "_mix")
    mixed = mix(docs, doc_id, text, source, into).filter(F.col(f"{into}.copies") > 0)
    times = spare(mixed, "_times")
    return mixed.withColumn(times, F.explode(F.sequence(F.lit(1), F.col(f"{into}.copies")))).select(*map(named, docs.columns))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    m = F.col("mix")
    return mix(docs).select("doc_id", m["size"].alias("size"), m["source_size"].alias("source_size"), F.round(m["target"], 6).alias("target"),
                            (m["copies"] * m["size"]).alias("taken"))


#: The level by rounds of resharing, as the contract words it; ranks by one window over a source.
OP6_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce('0' || source, '1') AS key,
    CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS BIGINT) AS size FROM documents),
s AS (SELECT key, CAST(sum(size) AS BIGINT) AS source_size, 1.0::DOUBLE + (row_number() OVER (ORDER BY key) - 1) % 3 AS weight FROM d GROUP BY key),
rounds AS (
    SELECT 0 AS i, key, source_size, weight, false AS stopped, weight * (SELECT sum(source_size) FROM s) / (SELECT sum(weight) FROM s) AS target FROM s
    UNION ALL
    SELECT i + 1, key, source_size, weight, stopped OR target >= 3 * source_size,
      CASE WHEN stopped OR target >= 3 * source_size THEN 3.0::DOUBLE * source_size
        ELSE weight * (sum(source_size) OVER () - sum(CASE WHEN stopped OR target >= 3 * source_size THEN 3.0::DOUBLE * source_size ELSE 0 END) OVER ())
             / sum(CASE WHEN stopped OR target >= 3 * source_size THEN 0 ELSE weight END) OVER () END
    FROM rounds WHERE i < (SELECT count(*) FROM s)),
t AS (SELECT * FROM rounds WHERE i = (SELECT count(*) FROM s)),
r AS (SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS e,
    CAST('0x' || substr(md5('mix-1' || key), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u,
    row_number() OVER (PARTITION BY key ORDER BY size, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 6) AS BIGINT) % 1024, doc_id) AS n
  FROM d JOIN t USING (key))
SELECT doc_id, size, source_size, round(target, 6) AS target, CAST(size * (floor(n::DOUBLE * e + u) - floor((n - 1)::DOUBLE * e + u)) AS BIGINT) AS taken FROM r
"""
