"""The seed-then-daily-runs scenario of FIXTURES.md, on a store in the work folder.

Seed: the full rebuild over snapshots up to 2024-01-20 (as-of 2024-01-20).
Then one incremental run per later snapshot - as a loop of scheduled runs, as
a loop whose runs are each preceded by an attempt that dies, or as a stream
over the snapshots landed as files.  Results are kept per application and input
folder, so queries that read the same scenario share one run.
"""

from __future__ import annotations

import datetime as dt
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import ntz
from ..operators.history import compress_history
from ..schemas import DAY, TS, Level
from ..session import scratch
from ..sinks.store import TableStore, Transaction
from ..sources import fixtures as fx
from ..streaming.keyed import land_changes, last_seen, run_keyed
from ..streaming.stream import landing_markers, run_stream, snapshot_stream, write_markers
from .bootstrap import bootstrap
from .increment import LATE, RunResult, high_water_mark, incremental_scan, keep_lookups, run_from_source, run_increment

SEED_MARK = dt.datetime(2024, 1, 20)
SEED_AS_OF = "2024-01-20"

_done: dict = {}
_lock = threading.Lock()  # queries sharing a scenario may run from several threads


def _once(spark: SparkSession, sf_dir: str, name: str, build):
    key = (name, sf_dir, spark.sparkContext.applicationId)
    with _lock:
        if key not in _done:
            _done[key] = build()
        return _done[key]


def _inputs(spark: SparkSession, sf_dir: str):
    return fx.case_log(spark, sf_dir), fx.case_details(spark, sf_dir), fx.benefits(spark, sf_dir)


def landed_inputs(spark: SparkSession, sf_dir: str):
    """The inputs derived from the driver tables, landed once as parquet tables
    in the work folder - the stored raw log a scheduled run reads, partitioned by day."""
    def build():
        folder = scratch(spark, "landed")
        log, *others = _inputs(spark, sf_dir)
        log.withColumn(DAY, F.to_date(TS)).repartition(DAY).write.partitionBy(DAY).parquet(f"{folder}/case_log")
        for name, df in zip(("case_details", "benefits"), others):
            df.write.parquet(f"{folder}/{name}")
        return tuple(spark.read.parquet(f"{folder}/{name}") for name in ("case_log", "case_details", "benefits"))
    key = ("landed", sf_dir, spark.sparkContext.applicationId)
    if key not in _done:
        _done[key] = build()
    return _done[key]


def seeded_store(spark: SparkSession, sf_dir: str, name: str):
    """A store after the rebuild up to the seed day; details and benefits are tables of the store, of which runs read the buckets at hand."""
    raw, det, ben = landed_inputs(spark, sf_dir)
    store = TableStore(spark, scratch(spark, name))
    bootstrap(store, raw.filter(F.col("fecha_registro") <= ntz(SEED_MARK)), det, ben, SEED_AS_OF)
    return store, raw, *keep_lookups(store, det, ben)


def later_snapshots(raw: DataFrame) -> list:
    """Snapshot times after the seed (one scalar per day: 10 values)."""
    later = raw.filter(F.col("fecha_registro") > ntz(SEED_MARK)).select("fecha_registro").distinct()
    return sorted(r[0] for r in later.collect())


def daily_runs(spark: SparkSession, sf_dir: str) -> TableStore:
    """Seed, then one scheduled run per later snapshot."""
    def build():
        store, raw, det, ben = seeded_store(spark, sf_dir, "daily")
        for t in later_snapshots(raw):
            # The raw table as it stands after snapshot t has landed.
            run_from_source(store, raw.filter(F.col("fecha_registro") <= ntz(t)), det, ben,
                            run_id=f"scheduled-{t:%Y%m%d%H%M}")
        return store
    return _once(spark, sf_dir, "daily", build)


class Died(RuntimeError):
    """Stands for the loss of the driver."""


class DyingStore(TableStore):
    """A store whose runs die at their ``writes``-th write, or at the commit if there are fewer."""

    writes = 10 ** 6

    def transaction(self) -> Transaction:
        store, left = self, [self.writes]

        class Dying(Transaction):
            def _put(self, *args):
                if not left[0]:
                    raise Died("before a write")
                left[0] -= 1
                return super()._put(*args)

            def commit(self, *args, **kwargs):
                raise Died("before the commit")

        return Dying(store, store.manifest().copy())


def died(store: TableStore, batch: DataFrame, det: DataFrame, ben: DataFrame, writes: int, **kwargs) -> RunResult | None:
    """An attempt at a run that dies at a write or at its commit."""
    dying = DyingStore(store.spark, store.root, store.buckets)
    dying.writes = writes
    try:
        return run_increment(dying, batch, det, ben, **kwargs)
    except Died:
        return None


def retried_runs(spark: SparkSession, sf_dir: str) -> TableStore:
    """As ``daily_runs``, but before each run an attempt at that snapshot and the one after it dies at another write."""
    def build():
        store, raw, det, ben = seeded_store(spark, sf_dir, "retried")
        times = later_snapshots(raw)
        for k, t in enumerate(times):
            ahead = raw.filter(F.col("fecha_registro") <= ntz(times[min(k + 1, len(times) - 1)]))
            run_id = f"scheduled-{t:%Y%m%d%H%M}"
            died(store, incremental_scan(ahead, high_water_mark(store)), det, ben, k + 1, run_id=run_id)
            run_from_source(store, raw.filter(F.col("fecha_registro") <= ntz(t)), det, ben, run_id=run_id)
        return store
    return _once(spark, sf_dir, "retried", build)


def tenant_run(spark: SparkSession, sf_dir: str) -> TableStore:
    """Tenants recorded at times of their own: seed, then one tenant-scope run over all later snapshots."""
    def build():
        raw = fx.case_log(spark, sf_dir, staggered=True)
        day1 = SEED_MARK + dt.timedelta(days=1)
        store = TableStore(spark, scratch(spark, "tenants"))
        det, ben = fx.case_details(spark, sf_dir), fx.benefits(spark, sf_dir)
        bootstrap(store, raw.filter(F.col("fecha_registro") < ntz(day1)), det, ben, SEED_AS_OF)
        run_from_source(store, raw, det, ben, scope="tenant", run_id="tenants", snapshots="each")
        return store
    return _once(spark, sf_dir, "tenants", build)


def streamed_runs(spark: SparkSession, sf_dir: str) -> TableStore:
    """Seed, then a stream over the later snapshots, landed as files."""
    def build():
        store, raw, det, ben = seeded_store(spark, sf_dir, "streamed")
        incoming = scratch(spark, "incoming")
        # Fixture landing step: the later snapshots land as parquet files.
        raw.filter(F.col("fecha_registro") > ntz(SEED_MARK)).write.parquet(incoming)
        run_stream(store, snapshot_stream(spark, incoming, raw.schema), det, ben, checkpoint=scratch(spark, "stream-checkpoint"))
        return store
    return _once(spark, sf_dir, "streamed", build)


def assembled_runs(spark: SparkSession, sf_dir: str) -> TableStore:
    """Seed, then a stream whose snapshots each land as three files and whose triggers take thirteen:
    some snapshots come in two triggers.  Then a second run of the stream finds a file of old rows only."""
    def build():
        store, raw, det, ben = seeded_store(spark, sf_dir, "assembled")
        incoming, markers, checkpoint = (scratch(spark, n) for n in ("pieces", "markers", "assembled-checkpoint"))
        later = raw.filter(F.col("fecha_registro") > ntz(SEED_MARK))
        write_markers(later, markers)
        for t in later_snapshots(raw):
            later.filter(F.col("fecha_registro") == ntz(t)).repartition(3, "load_seq").write.mode("append").parquet(incoming)

        def stream():
            run_stream(store, snapshot_stream(spark, incoming, raw.schema, files_per_trigger=13, watermark="1 day"), det, ben,
                       checkpoint=checkpoint, name="assembled", markers=landing_markers(spark, markers))
        stream()
        raw.filter(F.dayofmonth("fecha_registro") % 7 == 3).coalesce(1).write.mode("append").parquet(incoming)
        stream()
        return store
    return _once(spark, sf_dir, "assembled", build)


def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that came after their time was processed."""
    return assembled_runs(spark, sf_dir).read(LATE).drop("run_id")


def keyed_stream(spark: SparkSession, sf_dir: str, level: Level) -> DataFrame:
    """The level's changes: those up to the seed day from the log, the later ones by the keyed state operator, which
    starts from the state of that day and finds each later snapshot's changes and borders landed."""
    def build():
        raw, _, _ = landed_inputs(spark, sf_dir)
        seed = raw.filter(F.col(TS) <= ntz(SEED_MARK))
        folder, into, checkpoint = (scratch(spark, f"keyed-{level.name}-{n}") for n in ("in", "out", "checkpoint"))
        for t in later_snapshots(raw):
            schema = land_changes(raw.filter(F.col(TS) == ntz(t)), level, folder)
        run_keyed(spark, folder, schema, level, into, checkpoint, last_seen(seed, level), files_per_trigger=16)
        later = spark.read.parquet(into).filter("NOT late").select(*level.columns)
        return compress_history(seed, level).select(*level.columns).unionByName(later)
    return _once(spark, sf_dir, f"keyed-{level.name}", build)
