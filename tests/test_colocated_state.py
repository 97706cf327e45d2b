"""State tables as bucketed Spark tables: absence and change detection leave the state where it is."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import raw_df, ts
from tidemark.functions.nulls import keyed_filter, null_safe_join
from tidemark.operators.history import apply_snapshots, detect_changes, suppressed_incremental
from tidemark.operators.latest import latest_state
from tidemark.schemas import CHILD, PARENT, TIE
from tidemark.session import scratch
from tidemark.sinks.store import TableStore


def stored(spark, level, buckets=6, days=(1, 2, 3)):
    """A state in several versions, with NULL keys and states and keys that a later version renews."""
    store = TableStore(spark, scratch(spark, "clustered"), buckets=buckets)
    for day in days:
        rows = [dict(cliente=c, folio_padre=p, folio_hijo=f"{p}-h", fecha_registro=ts(day), estado_padre=s, estado_hijo=s)
                for c in ("1", "it's", None) for p in (f"P{day}", "P", None)
                for s in [None if p == "P1" else f"s{day}"]]
        tx = store.transaction()
        tx.append(latest_state(raw_df(spark, rows).select(*level.columns, TIE), level), "state", cluster=list(level.keys))
        tx.commit()
    return store


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture
def shuffled_joins(spark):
    """No broadcasts, and more shuffle partitions than buckets, so that Spark would rather move the state."""
    new = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "11"}
    old = {k: spark.conf.get(k, None) for k in new}
    for k, v in new.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def exchanged_scans(df):
    """How many scans of a clustered table lie below an exchange, and how many don't, in the executed plan."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("\n+- == Initial Plan ==")[0]
    below = free = 0
    above: list[tuple[int, bool]] = []
    for line in plan.splitlines():
        found = re.match(r"[\s:|+-]*", line)
        depth = len(found.group())
        above = [a for a in above if a[0] < depth]
        if "FileScan parquet spark_catalog" in line:
            assert "Bucketed: true" in line
            moved = any(x for _, x in above)
            below, free = below + moved, free + (not moved)
        above.append((depth, "Exchange" in line))
    return below, free


def test_versions_read_as_one_clustered_table(spark):
    store = stored(spark, PARENT)
    held = store.read("state")
    assert held.count() == 27 and len(store.manifest().tables["state"]["versions"]) == 3
    assert latest_state(held, PARENT).filter("folio_padre = 'P' AND cliente = 'it''s'").first()["estado_padre"] == "s3"
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("tidemark_")]
    # another store setting doesn't change the table's buckets, and a fold keeps its rows
    other = TableStore(spark, store.root, buckets=3)
    other.append(held.limit(0), "state", cluster=list(PARENT.keys))
    assert rows(other.read("state")) == rows(held) and other.transaction().buckets_of("state") == 6
    before = rows(latest_state(held, PARENT))
    assert other.fold({"state": lambda d: latest_state(d, PARENT)}) == ["state"]
    assert rows(other.read("state")) == before and len(other.manifest().tables["state"]["versions"]) == 1
    with pytest.raises(ValueError):
        other.append(held, "state", list(PARENT.keys))
    with pytest.raises(ValueError):
        other.replace(held, "new", ["cliente"], ["cliente"])


def test_an_uncommitted_version_is_not_read(spark):
    store = stored(spark, PARENT, days=(1,))
    held = rows(store.read("state"))
    tx = store.transaction()
    tx.append(store.read("state"), "state", cluster=list(PARENT.keys))  # and the run dies
    assert rows(store.read("state")) == held and len(tx.read("state").collect()) == 2 * len(held)


@pytest.mark.parametrize("how", ["left_semi", "left_anti"])
def test_keyed_filter_matches_null_with_null(spark, shuffled_joins, how):
    keys = list(PARENT.keys)
    state = latest_state(stored(spark, PARENT).read("state"), PARENT)
    wanted = spark.createDataFrame([("1", "P"), (None, "P"), ("1", None), ("it's", "P2"), ("x", "y"), ("1", "P")], "cliente string, folio_padre string")
    for some in (wanted, wanted.limit(0)):
        assert rows(keyed_filter(state, some, keys, how, 6)) == rows(null_safe_join(state, some, keys, how))


@pytest.mark.parametrize("level", [PARENT, CHILD])
def test_the_state_is_not_moved(spark, shuffled_joins, level):
    store = stored(spark, level)
    state = latest_state(store.read("state"), level)
    batch = raw_df(spark, [dict(cliente=c, folio_padre=p, folio_hijo=f"{p}-h", fecha_registro=ts(day), estado_padre="s3", estado_hijo="s3")
                           for day in (5, 6) for c in ("1", None) for p in ("P", "P2", "new", None)][:-2])
    day = batch.filter(F.col("fecha_registro") == ts(5))
    known = F.concat(*level.keys).isNotNull()
    for form in (lambda d, b: suppressed_incremental(d, day, level, buckets=b), lambda d, b: detect_changes(day, d, level, buckets=b),
                 lambda d, b: apply_snapshots(batch, d, level, buckets=b), lambda d, b: apply_snapshots(batch, d, level, "tenant", buckets=b)):
        assert rows(form(state, 6)) == rows(form(state, None))
    gone = suppressed_incremental(state, day, level, buckets=6).filter(known)
    assert exchanged_scans(gone) == (0, 1)
    moved = suppressed_incremental(state, day, level).filter(known)
    assert exchanged_scans(moved) == (1, 0)
