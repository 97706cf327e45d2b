"""Change detection by the keyed state operator against the batch form."""

import pytest
from pyspark.sql import functions as F

from conftest import raw_df, ts
from test_oracle import rows_of_spark
from tidemark.operators.history import compress_history
from tidemark.schemas import CHILD, PARENT
from tidemark.session import scratch
from tidemark.streaming.keyed import LANDED_FILES, land_changes, last_seen, run_keyed


def _day(day, states, **more):
    """Rows of one day: {case: its states in load order}."""
    return [dict(folio_padre=k, folio_hijo=None if k is None else f"H{k}", fecha_registro=None if day is None else ts(day), estado_padre=s, estado_hijo=s, **more)
            for k, all_of in states.items() for s in all_of]


DAYS = [
    _day(1, {"A": "xxy", "B": "x", "C": [None], None: "xx"}),
    _day(2, {"A": "yyyy", "B": "yx", "C": [None, "x"]}),
    _day(3, {"A": "yxxy" * 5, "D": "x", None: "x"}),
    _day(4, {"B": "x", "D": [None, None, "z"], "A": "y"}) + _day(None, {"A": "y", "B": "z"}),
]


def _streamed(spark, days, level, seen=None, files=None):
    folder, into, checkpoint = (scratch(spark, n) for n in ("keyed-in", "keyed-out", "keyed-ckpt"))
    for day in days:
        schema = land_changes(day, level, folder)
    run_keyed(spark, folder, schema, level, into, checkpoint, seen, files)
    return folder, schema, into, checkpoint


@pytest.mark.parametrize("level, files", [(PARENT, None), (CHILD, 1)], ids=["parent", "child"])
def test_equals_the_batch_form(spark, level, files):
    days = [raw_df(spark, d).cache() for d in DAYS]
    log = days[0]
    for d in days[1:]:
        log = log.unionByName(d)
    want = rows_of_spark(compress_history(log, level).select(*level.columns))
    into = _streamed(spark, days, level, files=files)[2]
    got = spark.read.parquet(into)
    assert got.filter("late").isEmpty()
    assert rows_of_spark(got.select(*level.columns)) == want
    # the same from a state that the first two days left
    into = _streamed(spark, days[2:], level, last_seen(days[0].unionByName(days[1]), level), files)[2]
    early = compress_history(days[0].unionByName(days[1]), level)
    assert rows_of_spark(early.select(*level.columns).unionByName(spark.read.parquet(into).select(*level.columns))) == want


def test_a_hot_key_is_one_border_a_batch(spark):
    hot = raw_df(spark, _day(1, {"A": "xy" * 300, "B": "x"}))
    folder = scratch(spark, "hot")
    land_changes(hot, PARENT, folder)
    landed = spark.read.parquet(folder)
    assert landed.filter("_border").count() == 2 and landed.filter("NOT _border").count() == 599


def test_a_batch_is_few_files_whatever_its_partitions(spark):
    new = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "9"}
    old = {c: spark.conf.get(c) for c in new}
    day = raw_df(spark, [dict(folio_padre=f"P{k}", estado_padre=s) for k in range(60) for s in "xyx"])
    folder = scratch(spark, "few-files")
    try:
        for c, v in new.items():
            spark.conf.set(c, v)
        land_changes(day, PARENT, folder)
        landed = spark.read.parquet(folder)
        assert len(landed.inputFiles()) <= LANDED_FILES
        assert landed.filter("_border").count() == 60 and landed.filter("NOT _border").count() == 120
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_restart_and_late_batches(spark):
    days = [raw_df(spark, d).cache() for d in DAYS[:3]]
    folder, schema, into, checkpoint = _streamed(spark, days[:1], PARENT)
    # a second run of the query finds the state of the first; a batch that lands again is late
    for day in (days[1], days[0].filter("folio_padre = 'B'"), days[2]):
        land_changes(day, PARENT, folder)
        run_keyed(spark, folder, schema, PARENT, into, checkpoint)
    got = spark.read.parquet(into)
    assert [r.folio_padre for r in got.filter("late").collect()] == ["B"]
    log = days[0].unionByName(days[1]).unionByName(days[2])
    assert rows_of_spark(got.filter("NOT late").select(*PARENT.columns)) == rows_of_spark(compress_history(log, PARENT).select(*PARENT.columns))


def test_nothing_landed_gives_nothing(spark):
    into = _streamed(spark, [raw_df(spark, DAYS[0]).limit(0)], PARENT)[2]
    assert spark.read.schema("cliente string").parquet(into).filter(F.lit(True)).isEmpty()
