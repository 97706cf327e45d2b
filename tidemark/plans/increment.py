"""Incremental run (C28): one batch of new snapshot rows against the stored tables.

Per level: newest stored state -> changes of the batch (C1) + suppression
markers for active keys absent from a snapshot (C6, C7) -> append to history
(K1) -> refresh the dimension rows of the affected keys (C22, C26, C27, K3, K4).

The run reads only the batch, small state tables and the buckets of keyed
tables that the batch's keys fall into, never the raw log or the history.
Everything it writes becomes visible by one commit (``sinks.store``): a run
that dies midway leaves no trace, and its retry starts from the state before
it (T7).  A run is keyed by ``run_id`` (e.g. the streaming batch id): a run that
already committed is skipped.
"""

from __future__ import annotations

import datetime as dt
import logging
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.nulls import keyed_filter, not_blank, null_safe_join
from ..functions.time import ntz
from ..operators.dims import (child_dim, child_summary_parts, finish_parent_summary, merge_child_parts,
                              merge_child_summary, merge_parent_summary, parent_dim, parent_summary_parts,
                              tenant_start)
from ..operators.history import apply_snapshots, detect_changes, level_rows, suppressed_incremental
from ..operators.latest import latest_per_key, latest_snapshot, latest_state, load_order
from ..schemas import CHILD, DAY, PARENT, RAW_COLUMNS, SUPPRESSED, TENANT, TIE, TS, Level, require_columns
from ..sinks.store import TableStore, Touched, Transaction, together
from .bootstrap import (C_KEYS, CHILD_DIM, CHILD_HISTORY, CHILD_STATE, CHILD_SUMMARY, LATEST_CHILD, LATEST_PARENT,
                        P_KEYS, PARENT_DIM, PARENT_HISTORY, PARENT_STATE, PARENT_SUMMARY, TENANT_START,
                        latest_child_rows, latest_parent_rows, marks_of)

#: Rows of snapshots that haven't landed whole, and rows that came after their time was processed.
STAGED, LATE = "staged_rows", "late_rows"
#: A bucket with so many delta versions is folded after the run.
COMPACT_AFTER = 24


@dataclass
class RunResult:
    """What a run did.  ``rows``: applied; ``late``: given but at or before the mark, not applied (T4);
    ``held``: rows of snapshots that aren't whole yet; ``skipped``: nothing was applied."""

    run_id: str | None
    rows: int = 0
    late: int = 0
    held: int = 0
    mark: dt.datetime | None = None
    history_rows: dict = field(default_factory=dict)
    dim_rows: dict = field(default_factory=dict)
    skipped: bool = False


def _time(text: str | None) -> dt.datetime | None:
    return None if text is None else dt.datetime.fromisoformat(text)


def high_water_mark(store: TableStore, source: str = "processed") -> dt.datetime | None:
    """Newest timestamp already processed.

    ``processed``: the mark recorded with each committed run (Q1), which
    scheduled runs read.  ``history``: the newest timestamp in the parent
    history, as the original takes it; snapshots that change no parent come
    after it, so a run from it reads them again (``run_from_source(mark="history")``).
    """
    if source == "history":
        ph = store.read(PARENT_HISTORY)
        return None if ph is None else ph.agg(F.max(TS)).first()[0]
    return _time(store.manifest().marks.get(""))


def tenant_marks(store: TableStore) -> dict:
    """The mark of each tenant (T1, tenant scope)."""
    return {None if k == "n" else k[1:]: _time(v) for k, v in store.manifest().marks.items() if k}


def incremental_scan(raw: DataFrame, mark) -> DataFrame:
    """Rows strictly newer than ``mark``, all rows without one.

    The comparison reaches the parquet scan as a pushed filter; on a log partitioned by the
    day of its rows (a column ``dia``) it is a partition filter too, so a run lists
    only the days from the mark on.  ``mark`` may be a dict of tenants' marks: each tenant's
    rows are compared with its own (a tenant without one is new).
    """
    if mark is None or mark == {}:
        return raw
    if not isinstance(mark, dict):
        if DAY in raw.columns:  # rows without a time are late; their partition isn't read
            raw = raw.filter(F.col(DAY) >= F.lit(mark.date()))
        return raw.filter(F.col(TS) > ntz(mark))
    return _with_mark(raw, mark).filter(F.col("_mark").isNull() | (F.col(TS) > F.col("_mark"))).drop("_mark")


def _with_mark(rows: DataFrame, mark: dict) -> DataFrame:
    kind = rows.schema[TENANT].dataType.simpleString()
    table = rows.sparkSession.createDataFrame(list(mark.items()), f"{TENANT} string, _mark timestamp_ntz")
    return null_safe_join(rows, table.withColumn(TENANT, F.col(TENANT).cast(kind)), [TENANT], "left", few=True)


#: Lookup tables that a store can keep, and their keys.
DETAILS, BENEFITS = "case_details", "benefits"
LOOKUP_KEYS = {DETAILS: ["url_ficha"], BENEFITS: ["cliente", "folio"]}


def keep_lookups(store: TableStore, details: DataFrame, benefits: DataFrame) -> tuple[str, str]:
    """Keep details and benefits as keyed tables of the store (S4): a run that is given their names reads the buckets of its
    keys instead of the whole tables.  New rows are added with ``store.append(rows, name, LOOKUP_KEYS[name])``.

    A run takes the last loaded row of a key (C15, C18).  Rows of the frames that are loaded before another one of their key can't be
    that any more and aren't kept, so a run doesn't move and sort them again; rows that tie for it all are."""
    tx = store.transaction()
    together(lambda: tx.replace(_last_loaded(details, LOOKUP_KEYS[DETAILS]), DETAILS, LOOKUP_KEYS[DETAILS]),
             lambda: tx.replace(_last_loaded(benefits, LOOKUP_KEYS[BENEFITS]), BENEFITS, LOOKUP_KEYS[BENEFITS]))
    tx.commit()
    return DETAILS, BENEFITS


def _last_loaded(rows: DataFrame, keys) -> DataFrame:
    """Each key's last loaded row, or rows that tie for it."""
    last = Window.partitionBy(*keys).orderBy(*load_order(last=True))
    return rows.withColumn("_rank", F.rank().over(last)).filter("_rank = 1").drop("_rank")


def _looked_up(tx: Transaction, table: DataFrame | str, wanted: DataFrame, keys, touched: Touched | None = None) -> DataFrame:
    """The rows of a lookup table that the keys ``wanted`` (columns in the order of ``keys``) ask for; ``touched``: their buckets, if known."""
    wanted = wanted.toDF(*keys).distinct()
    if isinstance(table, str):
        table = tx.read(table, buckets=(touched or tx.touched(wanted, keys)).of(table))
    return _semi(table, wanted, keys)


def _semi(df: DataFrame, keys_df: DataFrame, keys, right_keys=None) -> DataFrame:
    return null_safe_join(df, keys_df, keys, "left_semi", right_keys=right_keys)


def _markers(written: DataFrame, level: Level) -> DataFrame:
    # Markers are the appended rows without a tie-breaker.
    return written.filter((F.col(level.state) == SUPPRESSED) & F.col(TIE).isNull())


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` that counts its rows as they are written, without a job of its own."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen


def _after_state(batch: DataFrame, state: DataFrame, level: Level, buckets: int | None) -> DataFrame:
    """The rows of ``batch`` that come after their key's newest stored row: those up to it were applied before."""
    keys = list(level.keys)
    own = keyed_filter(state, batch.select(*keys).distinct(), keys, "left_semi", buckets)
    known = null_safe_join(batch, own.select(*keys, F.col(TS).alias("_stored")), keys, "left")
    return known.filter(F.col("_stored").isNull() | F.coalesce(F.col(TS) > F.col("_stored"), F.lit(False))).drop("_stored")


def _level_rows_out(state: DataFrame | None, buckets: int | None, batch: DataFrame, level: Level, scope: str, snapshots: str, reread: bool) -> DataFrame:
    if snapshots == "each":
        return apply_snapshots(batch, state, level, scope, buckets=buckets)
    fresh = _after_state(batch, state, level, buckets) if reread and state is not None else batch
    out = detect_changes(fresh, state, level, buckets=buckets)
    if state is None:
        return out
    newest = latest_snapshot(level_rows(batch, level), scope)
    return out.unionByName(suppressed_incremental(state, newest, level, scope=scope, buckets=buckets))


def _history_step(tx: Transaction, batch: DataFrame, level: Level, scope: str, snapshots: str, reread: bool) -> tuple[int, DataFrame]:
    """Append the level's changes and markers to history, state and summary; returns them and their number."""
    history, state_table, summary_table, parts = (
        (PARENT_HISTORY, PARENT_STATE, PARENT_SUMMARY, parent_summary_parts) if level is PARENT else
        (CHILD_HISTORY, CHILD_STATE, CHILD_SUMMARY, child_summary_parts))
    keys = list(level.keys)
    state = latest_state(tx.read(state_table), level) if tx.exists(state_table) else None
    out, seen = _counted(_level_rows_out(state, tx.buckets_of(state_table), batch, level, scope, snapshots, reread).select(*level.columns, TIE))
    written = tx.append(out, history)
    n = seen.get["n"]
    if n:
        # Readers de-duplicate the state over its versions, and the summary parts are MIN/MAX aggregates.
        together(lambda: tx.append(latest_state(written, level), state_table, cluster=keys), lambda: tx.append(parts(written), summary_table, keys))
    return n, written


def _open(store: TableStore, run_id: str | None) -> Transaction | None:
    """A transaction for the run, or None if the run has committed already."""
    tx = store.transaction()
    return None if run_id is not None and any(r["run_id"] == run_id for r in tx.state.runs) else tx


def _fresh(tx: Transaction, rows: DataFrame, scope: str, into: str = "_fresh", since: dt.datetime | None = None) -> DataFrame:
    """``rows`` with a flag: after the mark (in tenant scope the tenant's own; ``since``, if it is given), so not yet processed (T4)."""
    if since is not None:
        return rows.withColumn(into, F.coalesce(F.col(TS) > ntz(since), F.lit(False)))
    own = {None if k == "n" else k[1:]: _time(v) for k, v in tx.state.marks.items() if k}
    mark = _time(tx.state.marks.get(""))
    if scope == "tenant" and own:
        return _with_mark(rows, own).withColumn(into, F.col("_mark").isNull() | F.coalesce(F.col(TS) > F.col("_mark"), F.lit(False))).drop("_mark")
    return rows.withColumn(into, F.lit(True) if mark is None else F.coalesce(F.col(TS) > ntz(mark), F.lit(False)))


def run_increment(store: TableStore, batch: DataFrame, details: DataFrame | str, benefits: DataFrame | str,
                  run_id: str | None = None, scope: str = "global", snapshots: str = "newest", since: dt.datetime | None = None) -> RunResult:
    """Apply one batch of raw rows.

    ``details`` and ``benefits`` are frames, or names of tables of the store (``keep_lookups``).

    ``snapshots="newest"``: absence is judged against the batch's newest
    snapshot only, as the original run does.  ``"each"``: against every
    snapshot of the batch, in one pass, as one run per snapshot would.
    ``scope="tenant"``: marks and snapshots are each tenant's own.
    Rows at or before the mark are late (T4): never applied, but kept in the table
    ``late_rows`` with the run that brought them; a run of late rows only is recorded as well.
    ``since``: a mark of the caller's in place of the processed one.  Rows applied before may then come again; those up
    to their key's newest stored row make no change.  With ``scope="global"`` and ``snapshots="newest"`` only.
    """
    if since is not None and (scope, snapshots) != ("global", "newest"):
        raise ValueError("a mark of the caller's needs scope 'global' and snapshots 'newest'")
    tx = _open(store, run_id)
    if tx is None:
        return RunResult(run_id, skipped=True)
    require_columns(batch, CHILD.columns + PARENT.columns + (TIE,), "batch")
    flagged = _fresh(tx, batch, scope, since=since).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _apply(store, tx, flagged, details, benefits, run_id, scope, snapshots, reread=since is not None)
    finally:
        flagged.unpersist()


def run_assembled(store: TableStore, batch: DataFrame, markers: DataFrame, details: DataFrame | str, benefits: DataFrame | str,
                  run_id: str | None = None, scope: str = "global") -> RunResult:
    """Apply the snapshots that are whole, hold the rows of the others.

    ``markers`` says how many rows each snapshot has (``fecha_registro``, ``n_rows``, in tenant scope ``cliente`` too); its
    writer lands a marker beside a snapshot's files.  The rows of the batch join those held from earlier
    batches in the table ``staged_rows``.  A snapshot is whole once all its rows are there; snapshots are applied in order, so a
    whole one waits for an earlier one that isn't, and one without a marker waits for it.  What is applied and what stays held
    changes in the run's one commit, so a run that dies leaves the rows where they were.
    """
    tx = _open(store, run_id)
    if tx is None:
        return RunResult(run_id, skipped=True)
    require_columns(batch, RAW_COLUMNS, "batch")
    rows = batch.select(*RAW_COLUMNS)
    if tx.exists(STAGED):
        rows = rows.unionByName(tx.read(STAGED))
    of = [TENANT] if scope == "tenant" else []
    flagged = _fresh(tx, rows, scope).persist(StorageLevel.MEMORY_AND_DISK)
    cached = [flagged]
    try:
        landed = flagged.filter(F.col("_fresh") & F.col(TS).isNotNull()).groupBy(*of, TS).agg(F.count(F.lit(1)).alias("_have"))
        told = markers.groupBy(*of, TS).agg(F.max("n_rows").alias("_told"))
        partial = null_safe_join(landed, told, [*of, TS], "left", few=True).filter(F.col("_told").isNull() | (F.col("_have") < F.col("_told")))
        first = partial.groupBy(*of).agg(F.min(TS).alias("_first"))  # a row, or one per tenant
        waits = F.col("_fresh") & F.coalesce(F.col(TS) >= F.col("_first"), F.lit(False))
        if of:
            split = null_safe_join(flagged, first, of, "left", few=True)
        else:
            split = flagged.withColumn("_first", first.select("_first").scalar())
        split = split.withColumn("_waits", waits).drop("_first").persist(StorageLevel.MEMORY_AND_DISK)
        cached.append(split)
        held, seen = _counted(split.filter("_waits").select(*RAW_COLUMNS))
        tx.replace(held, STAGED)
        result = _apply(store, tx, split.filter("NOT _waits").drop("_waits"), details, benefits, run_id, scope, "each", seen.get["n"])
        return result
    finally:
        for df in cached:
            df.unpersist()


def _apply(store: TableStore, tx: Transaction, flagged: DataFrame, details: DataFrame | str, benefits: DataFrame | str, run_id: str | None,
           scope: str, snapshots: str, held: int = 0, reread: bool = False) -> RunResult:
    """Apply the fresh rows of ``flagged``, keep the others as late, commit."""
    cached: list[DataFrame] = []
    mark = _time(tx.state.marks.get(""))
    fresh = F.col("_fresh")
    try:
        stats = flagged.groupBy(TENANT).agg(F.max(F.when(fresh, F.col(TS))).alias("newest"), F.count(F.when(fresh, 1)).alias("rows"),
                                            F.count(F.when(~fresh, 1)).alias("late")).collect()  # a row per tenant
        rows, late = sum(r["rows"] for r in stats), sum(r["late"] for r in stats)
        result = RunResult(run_id, rows=rows, late=late, held=held, skipped=rows == 0)
        if rows == 0 and late == 0 and held == 0:
            return result
        if late:
            missed = flagged.filter(~fresh).select(*(c for c in RAW_COLUMNS if c in flagged.columns), F.lit(run_id).cast("string").alias("run_id"))
            tx.append(missed, LATE)
        marks = marks_of((r[TENANT], r["newest"]) for r in stats)
        if mark is not None and marks.get("") is not None:
            marks[""] = max(marks[""], mark.isoformat(sep=" "))  # a tenant may trail the others
        result.mark = _time(marks.get(""))
        if rows:
            _apply_rows(tx, flagged.filter(fresh).drop("_fresh"), details, benefits, scope, snapshots, result, cached, reread)
        record = {"run_id": run_id or f"run-{marks.get('')}", "mark": marks.get(""), "rows": rows, "late": late, "held": held}
        tx.commit(record, marks)
    finally:
        for df in cached:
            df.unpersist()
    try:
        compact_state(store, COMPACT_AFTER)
    except Exception as error:  # the run is committed; a later one folds
        logging.getLogger(__name__).warning("deltas were not folded: %s", error)
    return result


def _apply_rows(tx: Transaction, batch: DataFrame, details: DataFrame | str, benefits: DataFrame | str, scope: str, snapshots: str,
                result: RunResult, cached: list, reread: bool) -> None:
    starts = tenant_start(batch)
    if tx.exists(TENANT_START):
        starts = tx.read(TENANT_START).unionByName(starts).groupBy(TENANT).agg(F.min("fecha_primer_registro").alias("fecha_primer_registro"))
    (n_p, parents), (n_c, children), starts, _, _ = together(
        lambda: _history_step(tx, batch, PARENT, scope, snapshots, reread),
        lambda: _history_step(tx, batch, CHILD, scope, snapshots, reread),
        lambda: tx.replace(starts, TENANT_START),
        lambda: tx.append(latest_parent_rows(batch), LATEST_PARENT, P_KEYS),
        lambda: tx.append(latest_child_rows(batch), LATEST_CHILD, C_KEYS))
    result.history_rows.update(parent=n_p, child=n_c)
    if n_p:
        result.dim_rows["parent"] = _refresh_parents(tx, batch, _markers(parents, PARENT), details, starts, cached)
    if n_c:
        result.dim_rows["child"] = _refresh_children(tx, batch, _markers(children, CHILD), benefits, cached)


def _affected(tx: Transaction, batch: DataFrame, markers: DataFrame, level: Level, cached: list):
    keys = affected_keys(batch, markers, level).persist(StorageLevel.MEMORY_AND_DISK)
    cached.append(keys)
    return keys, tx.touched(keys, list(level.keys))


def _refresh_parents(tx, batch, markers, details, starts, cached) -> int:
    affected, touched = _affected(tx, batch, markers, PARENT, cached)
    raw = latest_per_key(_semi(tx.read(LATEST_PARENT, buckets=touched.of(LATEST_PARENT)), affected, P_KEYS), P_KEYS)
    raw = raw.persist(StorageLevel.MEMORY_AND_DISK)
    cached.append(raw)
    parts = _semi(tx.read(PARENT_SUMMARY, buckets=touched.of(PARENT_SUMMARY)), affected, P_KEYS)
    summary = finish_parent_summary(merge_parent_summary(parts))
    own_details = _looked_up(tx, details, raw.select("url_ficha"), LOOKUP_KEYS[DETAILS])
    new_rows, seen = _counted(parent_dim(raw, None, own_details, "incremental", starts=starts, summary=summary))
    tx.upsert(new_rows, affected, PARENT_DIM, P_KEYS, touched)
    return seen.get["n"]


def _refresh_children(tx, batch, markers, benefits, cached) -> int:
    affected, touched = _affected(tx, batch, markers, CHILD, cached)
    raw = latest_per_key(_semi(tx.read(LATEST_CHILD, buckets=touched.of(LATEST_CHILD)), affected, C_KEYS), list(CHILD.dim_keys))
    raw = raw.persist(StorageLevel.MEMORY_AND_DISK)
    cached.append(raw)
    first_last = merge_child_summary(_semi(tx.read(CHILD_SUMMARY, buckets=touched.of(CHILD_SUMMARY)), affected, C_KEYS))
    own_benefits = _looked_up(tx, benefits, affected.select(*C_KEYS), LOOKUP_KEYS[BENEFITS], touched)
    # the parents of these children only
    parent_keys = raw.select(*P_KEYS).distinct()
    own_parents = tx.touched(parent_keys, P_KEYS).of(PARENT_DIM)
    parents = _semi(tx.read(PARENT_DIM, buckets=own_parents), parent_keys, P_KEYS)
    new_rows, seen = _counted(child_dim(raw, None, own_benefits, parents, "incremental", first_last=first_last))
    tx.upsert(new_rows, affected, CHILD_DIM, C_KEYS, touched)
    return seen.get["n"]


def compact_state(store: TableStore, versions: int = 2) -> list[str]:
    """Fold the small versions of each table that has at least ``versions`` of them in a bucket (same content), in one commit.

    Large versions and tables that no run has made yet stay as they are; returns the tables folded."""
    return store.fold({
        LATEST_PARENT: lambda d: latest_per_key(d, P_KEYS), LATEST_CHILD: lambda d: latest_per_key(d, list(CHILD.dim_keys)),
        PARENT_STATE: lambda d: latest_state(d, PARENT), CHILD_STATE: lambda d: latest_state(d, CHILD),
        PARENT_SUMMARY: merge_parent_summary, CHILD_SUMMARY: merge_child_parts,
        PARENT_HISTORY: lambda d: d, CHILD_HISTORY: lambda d: d}, versions)


def run_from_source(store: TableStore, raw: DataFrame, details: DataFrame | str, benefits: DataFrame | str,
                    scope: str = "global", mark: str = "processed", **kwargs) -> RunResult:
    """Scheduled form: read the rows newer than the high-water mark, then run.

    ``mark="history"``: from the newest time in the parent history, as the original does (T1); snapshots since then that
    changed no parent are read again and change nothing."""
    if mark not in ("processed", "history"):
        raise ValueError(f"unknown mark {mark!r}")
    if mark == "history" and (since := high_water_mark(store, mark)) is not None:
        return run_increment(store, incremental_scan(raw, since), details, benefits, scope=scope, since=since, **kwargs)
    after = tenant_marks(store) if scope == "tenant" else high_water_mark(store)
    return run_increment(store, incremental_scan(raw, after), details, benefits, scope=scope, **kwargs)


def affected_keys(batch: DataFrame, markers: DataFrame, level: Level) -> DataFrame:
    """Keys seen in the batch plus keys given a suppression marker."""
    keys = list(level.keys)
    rows = batch.filter(not_blank(level.blank_key)) if level.blank_key else batch
    return rows.select(*keys).unionByName(markers.select(*keys)).distinct()
