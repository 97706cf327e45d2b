"""Structured Streaming form of the incremental run.

Snapshot files land in a folder; a file-source stream picks them up and
``foreachBatch`` applies each micro-batch with ``run_increment``.  The
stream's checkpoint tracks which files were read; the run log in the store's
manifest holds the micro-batch's id, so a micro-batch replayed after a failure
is not applied twice.

A micro-batch may hold several snapshots (a trigger takes every file that
has landed).  They are applied in one pass, each judged on its own
(``apply_snapshots``).  Absence is judged against whole snapshots: either each
lands whole (written elsewhere and moved in), or its files land as they come together with a
marker that tells its number of rows (``markers``); then a snapshot's rows are
held across triggers until all are there (``run_assembled``).  Either way the
history does not depend on how files were grouped into triggers.

Rows whose time was processed before go to the table ``late_rows``; a trigger of late rows
only leaves a run record.  ``watermark`` makes Spark track the event time besides
(reported by ``TriggerMetrics``), it drops nothing.

Change detection needs the previous state of every key and absence detection
needs a whole snapshot, which is why the body is a batch job per trigger
rather than a row-wise stateful operator (``lag`` over a stream is rejected
by Spark, and absence is not visible row by row).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.increment import RunResult, run_assembled, run_increment
from ..schemas import TENANT, TS
from ..sinks.store import TableStore
from .metrics import TriggerMetrics

MARKER_SCHEMA = f"{TENANT} string, {TS} timestamp_ntz, n_rows bigint"


def snapshot_stream(spark: SparkSession, folder: str, schema, files_per_trigger: int | None = None, watermark: str | None = None) -> DataFrame:
    """Stream of raw rows from parquet files in ``folder``, oldest file first; ``watermark``: a delay, e.g. ``"1 day"``."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    stream = reader.parquet(folder)
    if watermark:  # Spark takes no watermark on a time without zone
        stream = stream.withColumn("_event_time", F.col(TS).cast("timestamp")).withWatermark("_event_time", watermark).drop("_event_time")
    return stream


def landing_markers(spark: SparkSession, folder: str) -> Callable[[], DataFrame]:
    """The markers that have landed in ``folder`` (parquet) by the time they are asked for."""
    return lambda: spark.read.schema(MARKER_SCHEMA).parquet(folder)


def write_markers(snapshots: DataFrame, folder: str, scope: str = "global") -> None:
    """Land the markers of whole snapshots: their numbers of rows."""
    of = [TENANT, TS] if scope == "tenant" else [TS]
    counts = snapshots.groupBy(*of).agg(F.count(F.lit(1)).alias("n_rows"))
    if scope != "tenant":
        counts = counts.withColumn(TENANT, F.lit(None).cast("string"))
    counts.select(TENANT, TS, "n_rows").write.mode("append").parquet(folder)


def apply_batch(store: TableStore, batch: DataFrame, batch_id: int, details: DataFrame, benefits: DataFrame,
                scope: str = "global", name: str = "stream", markers: DataFrame | None = None) -> RunResult:
    """Apply one micro-batch, all its (whole) snapshots in one pass."""
    run_id = f"{name}-{batch_id}"
    if markers is not None:
        return run_assembled(store, batch, markers, details, benefits, run_id=run_id, scope=scope)
    return run_increment(store, batch, details, benefits, run_id=run_id, scope=scope, snapshots="each")


def run_stream(store: TableStore, stream: DataFrame, details: DataFrame, benefits: DataFrame, checkpoint: str, scope: str = "global",
               available_now: bool = True, name: str = "stream", markers: Callable[[], DataFrame] | None = None,
               metrics: TriggerMetrics | None = None):
    """Apply every available micro-batch (``availableNow``) or run hourly.

    ``markers``: how many rows each snapshot has, read at every trigger (``landing_markers``).  ``metrics`` is told what every
    trigger read and did.  Returns the finished (or running) ``StreamingQuery``.
    """
    if metrics is not None:
        stream = metrics.observed(stream, name)

    def body(batch: DataFrame, batch_id: int) -> None:
        result = apply_batch(store, batch, batch_id, details, benefits, scope, name, markers() if markers else None)
        if metrics is not None:
            metrics.applied(name, batch_id, result)

    writer = stream.writeStream.queryName(name).foreachBatch(body).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 hour")
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query
