"""Every registered query against its DuckDB oracle at sf0.001 (the driver's check)."""

import collections
import datetime as dt

import duckdb
import pytest

from conftest import SF001

import __spark_entry__ as E

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
# Queries that run whole scenarios are covered in test_incremental.py.
SCENARIOS = {"incremental_run_history_parent", "incremental_run_history_child"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, collections.Counter(tuple(norm(r[c]) for c in cols) for r in df.collect())


def rows_of_sql(con, sql):
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, collections.Counter(tuple(norm(r[i]) for i in idx) for r in res.fetchall())


def test_every_query_has_an_oracle():
    assert set(E.core_queries()) == set(E.core_oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(set(E.core_queries()) - SCENARIOS))
def test_query_matches_oracle(spark, con, name):
    s_cols, s_rows = rows_of_spark(E.queries()[name](spark, SF001))
    o_cols, o_rows = rows_of_sql(con, E.oracle_sql()[name])
    assert s_cols == o_cols
    assert s_rows == o_rows


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["cliente", "folio_padre", "fecha_registro", "estado_padre"]
    assert df.count() == 315


def test_results_do_not_depend_on_session_time_zone(spark, con):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Santiago")
    try:
        for name in ("incremental_scan", "latest_snapshot_global", "changes_vs_state_parent",
                     "suppressed_incr_child", "suppressed_batch_parent", "suppressed_incr_staggered_tenant"):
            assert rows_of_spark(E.queries()[name](spark, SF001)) == rows_of_sql(con, E.oracle_sql()[name]), name
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
