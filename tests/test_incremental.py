"""Incremental runs, the stream, replay safety and the upsert against oracles."""

import collections

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF001, raw_df, ts
import oracle as O
import __spark_entry__ as E
from tidemark.operators.history import compress_history
from tidemark.plans.bootstrap import CHILD_DIM, CHILD_HISTORY, PARENT_DIM, PARENT_HISTORY, bootstrap
from tidemark.plans.increment import high_water_mark, run_from_source, run_increment, tenant_marks
from tidemark.plans.scenario import daily_runs, landed_inputs, streamed_runs, _inputs
from tidemark.schemas import CHILD, PARENT, SUPPRESSED
from test_oracle import TABLES, rows_of_spark, rows_of_sql
from tidemark.functions.time import ntz
from tidemark.session import scratch
from tidemark.sinks.store import TableStore


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def history(store, table, level):
    return store.read(table).select(*level.columns)


@pytest.mark.parametrize("level,table", [(PARENT, PARENT_HISTORY), (CHILD, CHILD_HISTORY)])
def test_runs_match_closed_form(spark, con, level, table):
    store = daily_runs(spark, SF001)
    q = O.base_query()
    sql = q.select(f"SELECT {O.LEVELS[level.name]['cols']} FROM {O.incremental_history(q, level.name)}")
    assert rows_of_spark(history(store, table, level)) == rows_of_sql(con, sql)


@pytest.mark.parametrize("level,table", [(PARENT, PARENT_HISTORY), (CHILD, CHILD_HISTORY)])
def test_stream_equals_loop(spark, level, table):
    loop = daily_runs(spark, SF001)
    stream = streamed_runs(spark, SF001)
    assert rows_of_spark(history(loop, table, level)) == rows_of_spark(history(stream, table, level))
    for dim in (PARENT_DIM, CHILD_DIM):
        assert rows_of_spark(loop.read(dim)) == rows_of_spark(stream.read(dim))


def test_replay_is_harmless(spark):
    store = daily_runs(spark, SF001)
    raw, det, ben = _inputs(spark, SF001)
    before = {t: store.read(t).count() for t in (PARENT_HISTORY, CHILD_HISTORY, PARENT_DIM, CHILD_DIM)}
    # Same run id: skipped.  Fresh id over an already processed range: nothing new.
    last = store.manifest().runs[-1]
    mark = high_water_mark(store)
    r = run_from_source(store, raw.filter(F.col("fecha_registro") <= ntz(mark)), det, ben,
                        run_id=last["run_id"])
    assert r.skipped
    seeded_raw = raw.filter(F.col("fecha_registro") <= ntz(mark))
    replay = seeded_raw.filter(F.col("fecha_registro") == ntz(mark))
    r2 = run_increment(store, replay, det, ben, run_id="replay-test")
    assert r2.skipped and r2.rows == 0 and r2.late == replay.count()  # at or before the mark: late, counted (T4)
    after = {t: store.read(t).count() for t in before}
    assert before == after


def test_dimension_keys_unique(spark):
    store = daily_runs(spark, SF001)
    pd = store.read(PARENT_DIM)
    assert pd.count() == pd.select("cliente", "folio_padre").distinct().count()
    cd = store.read(CHILD_DIM)
    assert cd.count() == cd.select("cliente", "folio_padre", "folio_hijo").distinct().count()


def test_changes_never_repeat_previous_state(spark):
    store = daily_runs(spark, SF001)
    from pyspark.sql import Window
    h = store.read(PARENT_HISTORY)
    w = Window.partitionBy("cliente", "folio_padre").orderBy(
        F.col("fecha_registro").asc_nulls_last(), F.col("load_seq").asc_nulls_last())
    rep = h.withColumn("p", F.lag("estado_padre").over(w)).filter(F.col("p") == F.col("estado_padre"))
    assert rep.count() == 0


def test_full_history_within_incremental_history(spark):
    """Full history is a subset of the incremental one minus markers; the surplus
    rows are returns with the state the key had before it vanished."""
    store = daily_runs(spark, SF001)
    raw, _, _ = _inputs(spark, SF001)
    full = collections.Counter(map(tuple, compress_history(raw, PARENT).select(*PARENT.columns).collect()))
    incr = collections.Counter(map(tuple, store.read(PARENT_HISTORY).filter(
        F.col("estado_padre") != SUPPRESSED).select(*PARENT.columns).collect()))
    assert not (full - incr)
    surplus = incr - full
    assert surplus  # the fixture has returns with unchanged state
    # Each surplus row follows a marker and repeats the state held before it.
    hist = sorted(store.read(PARENT_HISTORY).collect(),
                  key=lambda r: (r["cliente"], r["folio_padre"], r["fecha_registro"],
                                 r["load_seq"] is None, r["load_seq"] or 0))
    by_key = collections.defaultdict(list)
    for r in hist:
        by_key[(r["cliente"], r["folio_padre"])].append(r)
    for row in surplus.elements():
        seq = by_key[(row[0], row[1])]
        i = next(j for j, r in enumerate(seq) if tuple(r[c] for c in PARENT.columns) == row)
        assert i >= 2 and seq[i - 1]["estado_padre"] == SUPPRESSED
        assert seq[i - 2]["estado_padre"] == row[3]


def test_upsert_queries_match_oracle(spark, con):
    for name in ("parent_dim_upsert", "child_dim_upsert"):
        assert rows_of_spark(E.queries()[name](spark, SF001)) == rows_of_sql(con, E.oracle_sql()[name]), name


@pytest.mark.parametrize("ahead", [False, True])
def test_retry_after_a_crash_at_any_write(spark, ahead):
    """A batch of two snapshots dies at one write after another (or at its commit); the retry, with or
    without a further snapshot that landed meanwhile, equals a clean run (T7)."""
    import datetime as dt
    from tidemark.plans.increment import incremental_scan
    from tidemark.plans.scenario import died, seeded_store
    until = dt.datetime(2024, 1, 23 if ahead else 22)
    stores = []
    for name in ("retry", "clean"):
        store, raw, det, ben = seeded_store(spark, SF001, name)
        if name == "retry":
            two = incremental_scan(raw.filter(F.col("fecha_registro") <= ntz(dt.datetime(2024, 1, 22))), high_water_mark(store))
            before = store.manifest()
            for writes in (0, 1, 2, 4, 7, 9, 99):
                assert died(store, two, det, ben, writes, run_id="r") is None
                assert store.manifest() == before
        run = run_from_source(store, raw.filter(F.col("fecha_registro") <= ntz(until)), det, ben, run_id="r", snapshots="each")
        assert run.rows and run.history_rows["parent"] and run.dim_rows["child"]
        stores.append(store)
    for t in (PARENT_HISTORY, CHILD_HISTORY, PARENT_DIM, CHILD_DIM):
        assert rows_of_spark(stores[0].read(t)) == rows_of_spark(stores[1].read(t)), t


def test_tenant_that_arrives_later(spark):
    """Tenant 1 at 02:00, then tenant 2's snapshot of 01:00: applied in tenant scope, late in global scope."""
    from conftest import raw_df, ts
    from tidemark.plans.bootstrap import bootstrap
    from tidemark.session import scratch
    from tidemark.sinks.store import TableStore
    from tidemark.plans.scenario import landed_inputs
    _, det, ben = landed_inputs(spark, SF001)
    seed = raw_df(spark, [dict(fecha_registro=ts(1)), dict(cliente="2", fecha_registro=ts(1))])
    first = raw_df(spark, [dict(fecha_registro=ts(2, 2), estado_padre="b")])
    second = raw_df(spark, [dict(cliente="2", fecha_registro=ts(2, 1), estado_padre="c"), dict(cliente="1", fecha_registro=ts(2, 1), estado_padre="z")])
    for scope, rows, late in (("tenant", 1, 1), ("global", 0, 2)):
        store = TableStore(spark, scratch(spark, f"later-{scope}"))
        bootstrap(store, seed, det, ben, "2024-01-01")
        assert run_increment(store, first, det, ben, scope=scope).late == 0
        result = run_increment(store, second, det, ben, scope=scope)
        assert (result.rows, result.late) == (rows, late)
        states = [r["estado_padre"] for r in store.read(PARENT_HISTORY).filter("cliente = '2'").collect()]
        assert ("c" in states) == (scope == "tenant")
    assert tenant_marks(store)["1"] == ts(2, 2)


def test_tenant_scope_run_on_staggered_snapshots(spark):
    """Tenants recorded at different times: the tenant-scope run marks exactly
    what the per-tenant operator marks; the global scope marks more (Q3)."""
    import datetime as dt
    from tidemark.operators.history import suppressed_batch, suppressed_incremental
    from tidemark.operators.latest import latest_snapshot, latest_state
    from tidemark.plans.bootstrap import bootstrap
    from tidemark.plans.increment import high_water_mark, run_increment
    from tidemark.session import scratch
    from tidemark.sinks.store import TableStore
    from tidemark.sources import fixtures as fx
    raw = fx.case_log(spark, SF001, staggered=True)
    det, ben = fx.case_details(spark, SF001), fx.benefits(spark, SF001)
    d1, d2 = dt.datetime(2024, 1, 21), dt.datetime(2024, 1, 22)
    seed = raw.filter(F.col("fecha_registro") < ntz(d1))
    day = raw.filter((F.col("fecha_registro") >= ntz(d1)) & (F.col("fecha_registro") < ntz(d2)))
    state = latest_state(compress_history(seed, PARENT).unionByName(
        suppressed_batch(seed, PARENT, "2024-01-20")), PARENT)
    want = suppressed_incremental(state, latest_snapshot(day, "tenant"), PARENT, scope="tenant")
    glob = suppressed_incremental(state, latest_snapshot(day, "global"), PARENT, scope="global")
    assert glob.count() > want.count()
    store = TableStore(spark, scratch(spark, "tenant-scope"))
    bootstrap(store, seed, det, ben, "2024-01-20")
    run_increment(store, day, det, ben, run_id="t1", scope="tenant")
    got = store.read(PARENT_HISTORY).filter(F.col("load_seq").isNull() & (F.col("fecha_registro") >= ntz(d1)))
    assert rows_of_spark(got.select(*PARENT.columns)) == rows_of_spark(want.select(*PARENT.columns))
    newest = store.read(PARENT_HISTORY).agg(F.max("fecha_registro")).first()[0]
    assert high_water_mark(store, "history") == newest


def test_compaction_and_retention_keep_content(spark):
    """Folding the deltas and deleting old versions changes no table."""
    from tidemark.plans.bootstrap import CHILD_STATE, CHILD_SUMMARY, LATEST_CHILD, LATEST_PARENT, PARENT_STATE, PARENT_SUMMARY
    from tidemark.plans.increment import compact_state
    store = daily_runs(spark, SF001)
    deltas = (PARENT_STATE, CHILD_STATE, PARENT_SUMMARY, CHILD_SUMMARY, LATEST_PARENT, LATEST_CHILD)
    tables = (PARENT_HISTORY, CHILD_HISTORY, PARENT_DIM, CHILD_DIM)
    before, contents = {t: store.read(t).count() for t in deltas}, {t: rows_of_spark(store.read(t)) for t in tables}
    compact_state(store)
    assert store.retain(1, hours=0) > 20
    assert all(store.read(t).count() <= before[t] for t in deltas)
    assert {t: rows_of_spark(store.read(t)) for t in tables} == contents
    assert max(len(v) for t in store.manifest().tables.values() for v in t["buckets"].values()) == 1
    assert compact_state(store) == []


def test_compaction_of_a_store_that_never_saw_a_child(spark, monkeypatch):
    """Tables that no run has made are left out, and a fold that fails doesn't fail the committed run."""
    from conftest import raw_df, ts
    from tidemark.plans import increment
    from tidemark.plans.scenario import landed_inputs
    from tidemark.session import scratch
    from tidemark.sinks.store import TableStore
    _, det, ben = landed_inputs(spark, SF001)
    store = TableStore(spark, scratch(spark, "childless-store"))
    monkeypatch.setattr(increment, "COMPACT_AFTER", 2)
    for day in (1, 2):
        run_increment(store, raw_df(spark, [dict(fecha_registro=ts(day), folio_hijo="", estado_padre=str(day))]), det, ben)
    assert store.read(PARENT_HISTORY).count() == 2 and max(len(v) for v in store.manifest().tables[PARENT_DIM]["buckets"].values()) == 1
    assert len(store.manifest().tables[PARENT_HISTORY]["versions"]) == 1

    def broken(*args):
        raise OSError("disk")
    monkeypatch.setattr(increment, "compact_state", broken)
    result = run_increment(store, raw_df(spark, [dict(fecha_registro=ts(3), folio_hijo="", estado_padre="x")]), det, ben)
    assert result.rows == 1 and store.read(PARENT_HISTORY).count() == 3


def test_runs_from_the_history_mark(spark):
    """Snapshots 2 and 3 change children only, so each run from the history's newest time reads them again."""
    def day(d, parent, child, gone=()):
        return [dict(folio_padre=f"P{k}", folio_hijo=f"H{k}", fecha_registro=ts(d), estado_padre=parent, estado_hijo=child[k % len(child)])
                for k in range(6) if k not in gone] + [dict(folio_padre=None, fecha_registro=ts(d), estado_padre=parent, estado_hijo=child[0])] * (d > 4)
    days = [raw_df(spark, r).cache() for r in (day(1, "a", "x"), day(2, "a", "xy"), day(3, "a", "yx"), day(5, "b", "xz", gone=(2,)))]
    _, det, ben = landed_inputs(spark, SF001)
    stores = {}
    for mark in ("processed", "history"):
        store = stores[mark] = TableStore(spark, scratch(spark, f"mark-{mark}"), buckets=2)
        bootstrap(store, days[0], det, ben, "2024-01-01")
        log, read = days[0], []
        for d in days[1:]:
            log = log.unionByName(d)
            read.append(run_from_source(store, log, det, ben, mark=mark).rows)
        assert read == ([6, 6, 6] if mark == "processed" else [6, 12, 18])
        assert high_water_mark(store) == ts(5) and run_from_source(store, log, det, ben, mark=mark).rows == 0
    for table, columns in ((PARENT_HISTORY, PARENT.columns), (CHILD_HISTORY, CHILD.columns), (PARENT_DIM, None), (CHILD_DIM, None)):
        one, other = (s.read(table) if columns is None else s.read(table).select(*columns) for s in stores.values())
        assert rows_of_spark(one) == rows_of_spark(other), table
    with pytest.raises(ValueError):
        run_from_source(stores["history"], log, det, ben, mark="history", snapshots="each")
