"""Change detection as a keyed state operator of Structured Streaming.

The state of a case is one row: the order and state of its last row.  It is a value state of
``transformWithState``, kept by RocksDB and snapshotted into the query's checkpoint, so a lost executor
loads it again.

A keyed operator hands all rows of a key to one task, so it isn't fed with rows.
``land_changes`` does what can be done without the state: it finds the changes within a batch by the segmented scan
(``changed_rows``) and reduces each key to its *border*: the first row and the state of the last one.  Only the
border needs the past, so a hot key is one row a batch to the keyed operator, whatever its number of rows; the
changes inside the batch pass it by.

Batches of a key come in the order of their times.  A border that begins at or before the last row of its
key is late: it comes out with ``late`` set and leaves the state alone (so does a border that was landed twice; the
changes inside such a batch come out twice, so a landing that may be repeated needs a folder of its own, moved in whole).
Rows with a NULL key have no predecessor (N3): they are changes and need no state.  Absence needs whole
snapshots and stays with ``run_stream``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import BooleanType, StructField, StructType

from ..operators.history import changed_rows, level_rows
from ..schemas import TIE, TS, Level, require_columns

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: What a border says of its key's last row.
LAST = ("_last_at", "_last_tie", "_last_state")
#: Files of a landed batch.
LANDED_FILES = 3


def _ordered(raw: DataFrame, level: Level) -> DataFrame:
    """The level's rows with their order as two comparable columns: a missing time is last, a missing tie-breaker first."""
    cols = [*level.columns, TIE]
    require_columns(raw, cols, "batch")
    at = F.coalesce(F.date_format(TS, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("~"))
    return level_rows(raw.select(*cols), level).withColumns({"_at": at, "_tie": F.coalesce(TIE, F.lit(-2 ** 63).cast("bigint"))})


def _ends(rows: DataFrame, level: Level) -> DataFrame:
    """Each key's first row and the order and state of its last one, by one aggregate (combined before its shuffle)."""
    keys = list(level.keys)
    rest = [c for c in [*level.columns, TIE] if c not in keys]
    ends = rows.dropna(subset=keys).groupBy(*keys).agg(
        F.min(F.struct("_at", "_tie", *rest)).alias("_first"), F.max(F.struct("_at", "_tie", F.col(level.state).alias("_state"))).alias("_last"))
    last = [F.col(f"_last.{c}").alias(n) for c, n in zip(("_at", "_tie", "_state"), LAST, strict=True)]
    return ends.select(*keys, *(f"_first.{c}" for c in (*rest, "_at", "_tie")), *last)


def last_seen(raw: DataFrame, level: Level) -> DataFrame:
    """The state that a stream starts from: the order and state of each key's last row of ``raw``."""
    return _ends(_ordered(raw, level), level).select(*level.keys, *LAST)


def land_changes(batch: DataFrame, level: Level, folder: str, files: int = LANDED_FILES) -> StructType:
    """Land what a batch tells by itself in ``folder`` (parquet): the changes inside it and the border of each key; returns the schema.

    A batch is at most so many ``files``, whatever its size and the cluster's: a trigger takes a number of files, and asks the state of every
    key in them, so batches in many files would ask it for each key as often as there are batches."""
    keys, cols = list(level.keys), [*level.columns, TIE]
    rows = _ordered(batch, level)
    borders = _ends(rows, level)
    # a key's first change is its border; NULL keys have none and stay
    inner = changed_rows(rows, keys, level.state, TS, TIE).join(borders.select(*keys, "_at", "_tie").hint("merge"), [*keys, "_at", "_tie"], "left_anti")
    absent = {n: F.lit(None).cast(borders.schema[n].dataType) for n in LAST}
    landed = borders.withColumn("_border", F.lit(True)).unionByName(inner.withColumns({**absent, "_border": F.lit(False)}))
    landed = landed.select(*cols, "_at", "_tie", *LAST, "_border")
    landed.repartition(files).write.mode("append").parquet(folder)
    return StructType([StructField(f.name, f.dataType) for f in landed.schema])


def _follow(level: Level) -> StatefulProcessor:
    """The keyed operator; made here so that it travels to the workers by value."""
    cols, state = [*level.columns, TIE], level.state

    class Follow(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.last = handle.getValueState("last", "at string, tie bigint, state string")

        def handleInitialState(self, key, initialState, timerValues) -> None:
            self.last.update((initialState["_last_at"], initialState["_last_tie"], initialState["_last_state"]))

        def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
            last = self.last.get()  # None if there is none; every call is a round trip
            # one border for each batch that landed since the last trigger
            for r in sorted(rows, key=lambda r: (r["_at"], r["_tie"])):
                late = last is not None and (r["_at"], r["_tie"]) <= (last[0], last[1])
                # NULL on either side counts as different
                if late or last is None or last[2] is None or r[state] is None or last[2] != r[state]:
                    yield Row(**{c: r[c] for c in cols}, late=late)
                if not late:
                    last = (r["_last_at"], r["_last_tie"], r["_last_state"])
            self.last.update(tuple(last))

        def close(self) -> None:
            pass

    return Follow()


def keyed_changes(landed: DataFrame, level: Level, seen: DataFrame | None = None) -> DataFrame:
    """Stream of the changes among landed batches: the history columns, the tie-breaker and ``late``.

    ``seen``: the state before the first batch (``last_seen``)."""
    keys, cols = list(level.keys), [*level.columns, TIE]
    out = StructType([*landed.select(*cols).schema.fields, StructField("late", BooleanType())])
    borders = landed.filter("_border").groupBy(*keys).transformWithState(
        _follow(level), out, "append", "none", None if seen is None else seen.groupBy(*keys))
    return landed.filter("NOT _border").select(*cols, F.lit(False).alias("late")).unionByName(borders)


def run_keyed(spark: SparkSession, folder: str, schema: StructType, level: Level, into: str, checkpoint: str, seen: DataFrame | None = None,
              files_per_trigger: int | None = None, available_now: bool = True) -> StreamingQuery:
    """Follow the batches landed in ``folder`` and append their changes to the parquet table ``into`` (exactly once, by the sink's log)."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    writer = keyed_changes(reader.parquet(folder), level, seen).writeStream.option("checkpointLocation", checkpoint).outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 hour")
    query = _with_rocksdb(spark, lambda: writer.format("parquet").start(into))
    if available_now:
        query.awaitTermination()
    return query


def _with_rocksdb(spark: SparkSession, start: Callable[[], StreamingQuery]) -> StreamingQuery:
    # transformWithState needs this state store; a query keeps the one it is started with
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        return start()
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)
