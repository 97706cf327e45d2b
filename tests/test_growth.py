"""What a run moves: keys that grow with the cases don't pass the driver, and lookups are moved once a key."""

import pytest
from pyspark.sql import functions as F

from conftest import raw_df, ts
from tidemark.functions.nulls import keyed_filter, null_safe_join
from tidemark.operators.history import apply_snapshots, detect_changes
from tidemark.operators.latest import latest_state
from tidemark.plans.increment import BENEFITS, DETAILS, keep_lookups
from tidemark.schemas import CHILD, PARENT
from tidemark.session import scratch
from tidemark.sinks.store import TableStore


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_growing_sides_are_not_broadcast(spark, how):
    left = spark.createDataFrame([("1", "a"), (None, "b"), ("2", None), ("3", "c")], "cliente string, folio_padre string")
    right = spark.createDataFrame([("1", "a", 1), (None, "b", 2), ("2", None, 3), ("2", "x", 4)], "cliente string, folio_padre string, n int")
    keys = ["cliente", "folio_padre"]
    joined = null_safe_join(left, right, keys, how)
    assert "Broadcast" not in plan_of(joined)
    assert joined.count() == {"left": 4, "inner": 3, "left_semi": 3, "left_anti": 1}[how]
    # a row per tenant is left to Spark
    assert "Broadcast" in plan_of(null_safe_join(left, right, keys, how, few=True))
    if how.startswith("left_"):
        assert "Broadcast" not in plan_of(keyed_filter(left, right.select(*keys), keys, how, 3))


@pytest.mark.parametrize("level", [PARENT, CHILD])
def test_a_run_does_not_broadcast_its_keys(spark, level):
    first = raw_df(spark, [dict(folio_padre=f"P{k}", folio_hijo=f"H{k}", fecha_registro=ts(1)) for k in range(6)])
    later = raw_df(spark, [dict(folio_padre=f"P{k}", folio_hijo=f"H{k}", fecha_registro=ts(d), estado_padre="b", estado_hijo="y") for d in (2, 3) for k in range(d, 6)])
    state = latest_state(first, level)
    assert "BroadcastHashJoin" not in plan_of(detect_changes(later, state, level))
    out = apply_snapshots(later, state, level)
    assert out.filter(F.col(level.state) == "Folio suprimido").count() == 3 and out.count() == 7


@pytest.mark.parametrize("scope", ["global", "tenant"])
@pytest.mark.parametrize("level", [PARENT, CHILD])
def test_a_pass_over_snapshots_takes_the_state_once(spark, level, scope):
    first = raw_df(spark, [dict(cliente=c, folio_padre=f"P{k}", folio_hijo=f"H{k}", fecha_registro=ts(1)) for k in range(6) for c in ("1", None)])
    later = raw_df(spark, [dict(cliente=c, folio_padre=f"P{k}", folio_hijo=f"H{k}", fecha_registro=ts(d), estado_padre="a", estado_hijo="x")
                           for d in (2, 3, 4) for k in range(d, 6) for c in ("1", None)])
    path = scratch(spark, "state")
    latest_state(first, level).write.parquet(path)
    out = apply_snapshots(later, spark.read.parquet(path), level, scope)
    assert out.filter(F.col(level.state) == "Folio suprimido").count() == 8
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def test_lookups_keep_the_rows_that_can_be_the_last_loaded(spark):
    details = spark.createDataFrame(
        [("u/1", "old", 1), ("u/1", "new", 2), ("u/2", "tie", 5), ("u/2", "tie as well", 5), ("u/2", "old", 4),
         (None, "old", 1), (None, "new", 3), ("u/3", "numbered", 9), ("u/3", "unnumbered", None)],
        "url_ficha string, problema_salud string, load_seq bigint")
    benefits = spark.createDataFrame([("1", "H1", "old", 1), ("1", "H1", "new", 2), ("2", "H1", "other tenant", 1), (None, None, "x", 1)],
                                     "cliente string, folio string, descripcion string, load_seq bigint")
    store = TableStore(spark, scratch(spark, "last-loaded"), buckets=2)
    assert keep_lookups(store, details, benefits) == (DETAILS, BENEFITS)
    held = {tuple(r) for r in store.read(DETAILS).select("url_ficha", "problema_salud").collect()}
    assert held == {("u/1", "new"), ("u/2", "tie"), ("u/2", "tie as well"), (None, "new"), ("u/3", "unnumbered")}
    assert {r["descripcion"] for r in store.read(BENEFITS).collect()} == {"new", "other tenant", "x"}
