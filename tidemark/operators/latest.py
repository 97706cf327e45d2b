"""Newest / first / last row per key and newest snapshot.

Whole rows are picked with ``row_number() == 1``; Spark plans that filter as
a ``WindowGroupLimit`` that keeps one row per key *before* the shuffle as
well as after it, so a hot key costs one row per map task, not all of its
rows.  Per-column first/last values are aggregates with map-side partial
aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import TIE, TS, Level


def newest_first(ts: str = TS, tie: str = TIE) -> list[Column]:
    """Order of ``DISTINCT ON (keys) ... ORDER BY ts DESC``: NULL timestamps
    first (N6); within a timestamp, rows without a tie-breaker (suppression
    markers) first, then the later-loaded row (Q7)."""
    return [F.col(ts).desc_nulls_first(), F.col(tie).desc_nulls_first()]


def load_order(tie: str = TIE, last: bool = False) -> list[Column]:
    """Plain load order, for keep-first / keep-last de-duplication."""
    return [F.col(tie).desc_nulls_first()] if last else [F.col(tie).asc_nulls_last()]


def first_per_key(df: DataFrame, keys, order: list[Column]) -> DataFrame:
    """The first row of each key under ``order`` (NULL keys form their own group)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def latest_per_key(df: DataFrame, keys, ts: str = TS, tie: str = TIE) -> DataFrame:
    """Newest row per key."""
    return first_per_key(df, keys, newest_first(ts, tie))


def latest_state(history: DataFrame, level: Level, tie: str = TIE) -> DataFrame:
    """Newest stored history row per key of ``level``."""
    return latest_per_key(history, list(level.keys), TS, tie)


def _rank_struct(ts: str, tie: str) -> Column:
    # Ascending history order as one comparable value: timestamps with NULL
    # last, then real rows before markers (NULL tie last), then load order.
    return F.struct(F.col(ts).isNull(), F.col(ts), F.col(tie).isNull(), F.col(tie))


def first_last_state(history: DataFrame, keys, state: str, ts: str = TS, tie: str = TIE,
                     skip_nulls: bool = True, first: bool = True, last: bool = True,
                     names: dict | None = None) -> DataFrame:
    """First and/or last state of each key with their timestamps, in one aggregate.

    ``skip_nulls=True`` (A6, A7, N8): the state is the first/last *non-NULL*
    state and the timestamp the min/max timestamp, each column on its own, as
    an ordered group ``first()``/``last()`` does; NULL keys are dropped (N4).
    ``skip_nulls=False`` (D5): both come from the first/last whole row.
    Output columns: keys, ``first_state``, ``first_ts``, ``last_state``,
    ``last_ts`` (renamed through ``names``).
    """
    keys = list(keys)
    rank = _rank_struct(ts, tie)
    aggs = []
    if skip_nulls:
        history = history.dropna(subset=keys)
        ranked = F.when(F.col(state).isNotNull(), rank)
        if first:
            aggs += [F.min_by(F.col(state), ranked).alias("first_state"), F.min(ts).alias("first_ts")]
        if last:
            aggs += [F.max_by(F.col(state), ranked).alias("last_state"), F.max(ts).alias("last_ts")]
        out = history.groupBy(*keys).agg(*aggs)
    else:
        row = F.struct(F.col(state).alias("s"), F.col(ts).alias("t"))
        if first:
            aggs.append(F.min_by(row, rank).alias("_f"))
        if last:
            aggs.append(F.max_by(row, rank).alias("_l"))
        out = history.groupBy(*keys).agg(*aggs)
        cols = list(keys)
        if first:
            cols += [F.col("_f.s").alias("first_state"), F.col("_f.t").alias("first_ts")]
        if last:
            cols += [F.col("_l.s").alias("last_state"), F.col("_l.t").alias("last_ts")]
        out = out.select(*cols)
    for k, v in (names or {}).items():
        out = out.withColumnRenamed(k, v)
    return out


def latest_snapshot(df: DataFrame, scope: str = "global", tenant: str = "cliente",
                    ts: str = TS) -> DataFrame:
    """Rows of the newest snapshot (C23, F8, A1) or of each tenant's newest.

    ``global``: the newest timestamp is a scalar subquery, evaluated once.
    ``tenant``: each tenant's newest timestamp, joined back; the aggregate has one
    row per tenant, which AQE broadcasts from its measured size.
    """
    if scope == "global":
        return df.filter(F.col(ts) == df.agg(F.max(ts)).scalar())
    if scope != "tenant":
        raise ValueError(f"unknown scope {scope!r}")
    per_tenant = df.groupBy(tenant).agg(F.max(ts).alias("_newest"))
    joined = df.join(per_tenant, on=tenant, how="inner")
    return joined.filter(F.col(ts) == F.col("_newest")).drop("_newest")
