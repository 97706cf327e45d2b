"""Sharding by a permutation-filled lookup table (operator 1).

Every shard has a permutation of the table's slots, offset + j * skip modulo the prime ``SLOTS``, from two hashes
of its name.  The shards take turns, each claiming its next preferred slot that is free, until all slots are claimed; so shards
own nearly equal numbers of slots, and a shard more or less moves few slots beside its own.  The table is filled from the
shards' names alone (it never sees a row) and has ``SLOTS`` entries, which bounds its broadcast; a
document's slot is a hash of its key, its shard one lookup.

Cases: a null doc_id is placed by a hash of its text, so a mass of such rows spreads; a null id and a null text share one
slot; repeated rows go to one shard; an empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.frames import named, spare

#: Shards of the query, and slots: a prime, over a hundred times the shards.
SHARDS, SLOTS = 64, 8191


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(names: list[str], slots: int = SLOTS) -> list[int]:
    """Shard number of each slot."""
    if len(set(names)) != len(names) or not 0 < len(names) <= slots:
        raise ValueError("shards need distinct names and a slot each")
    if slots < 2 or any(slots % k == 0 for k in range(2, int(slots ** 0.5) + 1)):
        raise ValueError("the number of slots must be prime")
    place = [_number(n + ":offset") % slots for n in names]
    skip = [_number(n + ":skip") % (slots - 1) + 1 for n in names]
    table, free = [-1] * slots, slots
    while True:
        for k in range(len(names)):
            while table[place[k]] >= 0:
                place[k] = (place[k] + skip[k]) % slots
            table[place[k]] = k
            free -= 1
            if not free:
                return table


def slot(doc_id: Column, text: Column, slots: int) -> Column:
    """The slot of a document: a hash of its id, or of its text if it has no id."""
    key = F.coalesce(doc_id.cast("string"), F.concat(F.lit("text:"), F.md5(text)), F.lit(""))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("bigint") % slots


def sharded(docs: DataFrame, names: list[str], slots: int = SLOTS, doc_id: str = "doc_id", text: str = "text",
            slot_into: str = "slot", into: str = "shard") -> DataFrame:
    """``docs`` with its slot and the name of its shard, in columns of these names (``spare`` of them, if there are such)."""
    slot_into, into = spare(docs, slot_into), spare(docs, into)
    key, shards = spare(docs, "_slot"), F.array(*map(F.lit, names))
    filled = F.split(F.lit(",".join(map(str, lookup_table(names, slots)))), ",")
    table = docs.sparkSession.range(1).select(F.posexplode(filled).alias(key, "k"))
    table = table.select(F.col(key).cast("bigint").alias(key), F.element_at(shards, F.col("k").cast("int") + 1).alias(into))
    placed = docs.withColumn(key, slot(named(doc_id), named(text), slots)).join(F.broadcast(table), key)
    return placed.select(*map(named, docs.columns), F.col(key).alias(slot_into), F.col(into))


def shard_names(n: int = SHARDS) -> list[str]:
    return [f"shard-{k:05d}" for k in range(n)]


def write_shards(docs: DataFrame, path: str, names: list[str], slots: int = SLOTS, files: int = 8, **columns) -> None:
    """Write ``docs`` as one folder per shard; a shard's rows are dealt over ``files`` tasks, so no task holds a shard."""
    placed = sharded(docs, names, slots, **columns)
    salt, shard = spare(placed, "_salt"), placed.columns[-1]
    dealt = placed.withColumn(salt, F.pmod(F.xxhash64(*map(named, docs.columns)), F.lit(files))).repartition(named(shard), named(salt))
    dealt.drop(salt).write.partitionBy(shard).parquet(path)


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return sharded(docs, shard_names()).select("doc_id", "slot", "shard", F.octet_length("text").cast("bigint").alias("n_bytes"))


#: The turns one by one: each row claims one slot.
OP1_SQL = r"""
WITH RECURSIVE names AS (SELECT k, format('shard-{:05d}', k) AS name FROM range(64) t(k)),
prefs AS (SELECT list(CAST('0x' || substr(md5(name || ':offset'), 1, 15) AS BIGINT) % 8191 ORDER BY k) AS offsets,
    list(CAST('0x' || substr(md5(name || ':skip'), 1, 15) AS BIGINT) % 8190 + 1 ORDER BY k) AS skips FROM names),
fill AS (
    SELECT 0 AS n, list_transform(range(8191), lambda x: -1) AS owner
    UNION ALL
    SELECT n + 1, list_concat(list_append(owner[1:spot], CAST(n % 64 AS INTEGER)), owner[spot + 2:])
    FROM (SELECT *, (offsets[n % 64 + 1] + skips[n % 64 + 1] * list_position(list_transform(range(8191),
            lambda j: owner[(offsets[n % 64 + 1] + skips[n % 64 + 1] * j) % 8191 + 1]), -1) - skips[n % 64 + 1]) % 8191 AS spot
          FROM fill, prefs WHERE n < 8191)),
slots AS (SELECT unnest(range(8191)) AS slot, unnest(owner) AS k FROM fill WHERE n = 8191),
d AS (SELECT doc_id, strlen(text) AS n_bytes, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'text:' || md5(text), '')), 1, 15) AS BIGINT) % 8191 AS slot FROM documents)
SELECT doc_id, slot, name AS shard, CAST(n_bytes AS BIGINT) AS n_bytes FROM d JOIN slots USING (slot) JOIN names USING (k)
"""
