"""Snapshots assembled across triggers, late rows, trigger metrics; partition pruning and bucketed lookups of a run."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF001, raw_df, ts
from test_oracle import rows_of_spark
from tidemark.functions.time import ntz
from tidemark.operators.dims import detail_enrichment
from tidemark.plans.bootstrap import CHILD_DIM, CHILD_HISTORY, PARENT_DIM, PARENT_HISTORY, bootstrap
from tidemark.plans.increment import DETAILS, LATE, STAGED, incremental_scan, keep_lookups, run_assembled, run_increment
from tidemark.plans.scenario import landed_inputs
from tidemark.schemas import CHILD, PARENT, RAW_COLUMNS
from tidemark.session import scratch
from tidemark.sinks.store import TableStore
from tidemark.streaming.metrics import TriggerMetrics
from tidemark.streaming.stream import landing_markers, run_stream, snapshot_stream, write_markers


def cases(day, gone=(), state="a"):
    return [dict(cliente=str(k % 2), folio_padre=f"P{k}", folio_hijo=f"H{k}", fecha_registro=ts(day), estado_padre=state + str(k % 3),
                 estado_hijo=state) for k in range(12) if k not in gone]


@pytest.fixture(scope="module")
def seed(spark):
    return raw_df(spark, cases(1)).cache()


def seeded(spark, seed, name):
    _, det, ben = landed_inputs(spark, SF001)
    store = TableStore(spark, scratch(spark, name), buckets=2)
    bootstrap(store, seed, det, ben, "2024-01-01")
    return store, *keep_lookups(store, det, ben)


def test_a_snapshot_in_three_files_equals_the_loop(spark, seed):
    second, third = raw_df(spark, cases(2, gone=(3,))).cache(), raw_df(spark, cases(3, gone=(5,), state="b")).cache()
    loop, det, ben = seeded(spark, seed, "whole")
    for day in (second, third):
        run_increment(loop, day, det, ben)

    store, det, ben = seeded(spark, seed, "pieces")
    incoming, told, checkpoint = (scratch(spark, n) for n in ("pieces-in", "pieces-told", "pieces-ckpt"))
    write_markers(second.unionByName(third), told)
    metrics = TriggerMetrics()
    spark.streams.addListener(metrics)

    def stream():
        run_stream(store, snapshot_stream(spark, incoming, seed.schema, files_per_trigger=1, watermark="1 hour"), det, ben, checkpoint,
                   name="pieces", markers=landing_markers(spark, told), metrics=metrics)
    try:
        for day in (second, third):
            for k in range(3):
                day.filter(F.col("load_seq") % 3 == k).coalesce(1).write.mode("append").parquet(incoming)
        stream()
        for t, level in ((PARENT_HISTORY, PARENT), (CHILD_HISTORY, CHILD)):
            assert rows_of_spark(store.read(t).select(*level.columns)) == rows_of_spark(loop.read(t).select(*level.columns))
        for t in (PARENT_DIM, CHILD_DIM):
            assert rows_of_spark(store.read(t)) == rows_of_spark(loop.read(t))
        assert store.read(STAGED).count() == 0 and not store.exists(LATE)
        # a trigger of late rows only leaves a record, the rows, and nothing else
        old = raw_df(spark, cases(2)[:4])
        old.coalesce(1).write.mode("append").parquet(incoming)
        before = rows_of_spark(store.read(PARENT_HISTORY))
        stream()
        assert rows_of_spark(store.read(PARENT_HISTORY)) == before
        assert rows_of_spark(store.read(LATE).drop("run_id")) == rows_of_spark(old) and store.manifest().runs[-1]["late"] == 4
        triggers = metrics.wait()
    finally:
        spark.streams.removeListener(metrics)
    assert [t.result.rows for t in triggers] == [0, 0, 11, 0, 0, 11, 0]
    assert [t.read for t in triggers] == [t.result.rows + t.result.late + t.result.held - held for t, held in
                                          zip(triggers, [0, *(t.result.held for t in triggers)])]
    assert [t.result.late for t in triggers] == [0] * 6 + [4] and triggers[2].result.history_rows["parent"] == 1
    assert triggers[-1].watermark and triggers[-1].undated == 0


def test_order_markers_and_tenants_of_assembly(spark, seed):
    """A whole snapshot waits for an earlier one that isn't whole; one without a marker waits; tenants wait for their own only."""
    for scope, applied in (("global", 0), ("tenant", 6)):
        store, det, ben = seeded(spark, seed, f"order-{scope}")
        second, third = raw_df(spark, cases(2)), raw_df(spark, cases(3)).cache()
        told = second.unionByName(third).groupBy("cliente", "fecha_registro").agg(F.count("*").alias("n_rows"))
        if scope == "global":
            told = told.groupBy("fecha_registro").agg(F.sum("n_rows").alias("n_rows"))
        part = second.filter("cliente = '0' OR folio_padre = 'P1'").cache()  # tenant 0 is whole, tenant 1 isn't
        first = run_assembled(store, part, told, det, ben, "r1", scope)
        assert first.rows == applied and first.held == part.count() - applied
        assert run_assembled(store, part, told, det, ben, "r1", scope).skipped  # a replayed trigger
        both = run_assembled(store, third.filter("cliente = '1'"), told, det, ben, "r2", scope)
        assert both.rows == 0  # the third day of tenant 1 waits for its second
        rest = second.join(part.select("load_seq"), "load_seq", "left_anti").select(*RAW_COLUMNS)
        last = run_assembled(store, rest, told.filter(F.col("fecha_registro") == ntz(dt.datetime(2024, 1, 2))), det, ben, "r3", scope)
        assert last.rows == 12 - applied and last.held == 6  # no marker of the third day any more
        assert store.read(STAGED).select("fecha_registro").distinct().collect() == [(ts(3),)]


def test_a_run_reads_new_days_and_its_own_lookup_rows(spark, seed):
    raw, det, ben = landed_inputs(spark, SF001)
    mark = dt.datetime(2024, 1, 28)
    new = incremental_scan(raw, mark)
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "dia" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {f.split("dia=")[1][:10] for f in new.inputFiles()} >= {"2024-01-29"}
    assert rows_of_spark(new) == rows_of_spark(raw.filter(F.col("fecha_registro") > ntz(mark)))
    store = TableStore(spark, scratch(spark, "lookups"), buckets=16)
    bootstrap(store, seed, det, ben, "2024-01-01")
    names = keep_lookups(store, det, ben)
    whole = TableStore(spark, scratch(spark, "lookups-whole"))
    bootstrap(whole, seed, det, ben, "2024-01-01")
    day = raw_df(spark, [dict(r, url_ficha=f"u/{k}") for k, r in enumerate(cases(2, gone=range(3, 12), state="c"))])
    run_increment(store, day, *names)
    run_increment(whole, day, det, ben)
    for t in (PARENT_DIM, CHILD_DIM):
        assert rows_of_spark(store.read(t)) == rows_of_spark(whole.read(t))
    tx = store.transaction()
    some = tx.read(DETAILS, buckets=tx.touched(day.select("url_ficha"), ["url_ficha"]).of(DETAILS))
    assert 0 < some.count() < store.read(DETAILS).count() / 2


def test_half_the_urls_null_are_split_over_tasks(spark):
    """The null-safe detail join meets its rows by shuffle, and a partition of NULL (or hot) URLs is split at run time."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k"}
    old = {c: spark.conf.get(c, None) for c in conf}
    try:
        for c, v in conf.items():
            spark.conf.set(c, v)
        dim = spark.range(0, 40000, 1, 8).select("id", F.when(F.col("id") % 2 == 0, F.concat(F.lit("u/"), F.col("id") % 5000)).alias("url_ficha"))
        _, det, _ = landed_inputs(spark, SF001)
        nulls = det.limit(1).withColumn("url_ficha", F.lit(None).cast("string"))
        out = detail_enrichment(dim, det.unionByName(nulls))
        assert out.count() == 40000 and out.filter("url_ficha IS NULL AND fecha_atencion IS NOT NULL").count() == 20000
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for c, v in old.items():
            spark.conf.unset(c) if v is None else spark.conf.set(c, v)
