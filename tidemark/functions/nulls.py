"""NULL rules of the case log, as Column expressions.

The log's semantics treat NULL differently from SQL in a few places; each
helper names the rule it implements (see README, "NULL semantics").
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ne_or_null(a, b) -> Column:
    """``a != b`` where a NULL on either side counts as different."""
    return F.coalesce(_col(a) != _col(b), F.lit(True))


def eq_strict(a, b) -> Column:
    """``a == b`` where a NULL on either side counts as not equal."""
    return F.coalesce(_col(a) == _col(b), F.lit(False))


def not_in_or_null(c, values) -> Column:
    """``c NOT IN values`` that keeps NULL."""
    return F.coalesce(~_col(c).isin(*values), F.lit(True))


def not_blank(c) -> Column:
    """Neither NULL nor the empty string."""
    c = _col(c)
    return c.isNotNull() & (c != F.lit(""))


def any_null(cols) -> Column:
    """True when any of ``cols`` is NULL."""
    return reduce(lambda a, b: a | b, [_col(c).isNull() for c in cols], F.lit(False))


def not_contains_or_null(c, needle: str) -> Column:
    """Substring exclusion that keeps NULL (F4, incremental form)."""
    return F.coalesce(~_col(c).contains(needle), F.lit(True))


def null_safe_join(left: DataFrame, right: DataFrame, keys, how: str = "left",
                   right_keys=None, few: bool = False) -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL.

    ``right_keys`` names the key columns on the right when they differ.  The
    output carries the left key columns once, like ``join(on=[...])``.  Spark
    plans ``<=>`` as an ordinary equi-join key, so the join stays a
    sort-merge join: a right side that grows with the cases would be collected
    by the driver for a broadcast, once a join and run, as long as it is below
    Spark's threshold.  ``few``: the right side has a row per tenant or
    snapshot; Spark may broadcast it by its measured size.
    """
    keys = list(keys)
    right_keys = list(right_keys or keys)
    tmp = [f"__rk_{i}" for i in range(len(keys))]
    r = right
    for rk, t in zip(right_keys, tmp):
        r = r.withColumnRenamed(rk, t)
    if not few:
        r = r.hint("merge")
    cond = [left[k].eqNullSafe(r[t]) for k, t in zip(keys, tmp)]
    out = left.join(r, cond, how)
    if how in ("left_semi", "left_anti", "semi", "anti", "leftsemi", "leftanti"):
        return out
    return out.drop(*tmp)


def keyed_filter(left: DataFrame, keys_df: DataFrame, keys, how: str, buckets: int | None = None) -> DataFrame:
    """Rows of ``left`` whose keys are (``left_semi``) or aren't (``left_anti``) in ``keys_df``, NULL matching NULL.

    ``buckets``: ``left`` is clustered by ``keys`` into so many buckets.  Then the distinct ``keys_df`` alone is dealt
    to them and ``left`` stays where it is.  Spark knows clusters by the plain columns, which ``<=>`` hides, so rows
    with a NULL key, which its scan can skip by the files' statistics, are matched apart.
    """
    keys = list(keys)
    if buckets is None:
        return null_safe_join(left, keys_df, keys, how)
    odd = any_null(keys)
    known = left.filter(~odd).join(keys_df.filter(~odd).repartition(buckets, *keys).hint("merge"), keys, how)
    return known.unionByName(null_safe_join(left.filter(odd), keys_df.filter(odd), keys, how))


def keyed_left_join(left: DataFrame, right: DataFrame, keys, buckets: int | None = None) -> DataFrame:
    """Left join of ``right`` on ``keys``, NULL matching NULL (N5); ``buckets``: as in ``keyed_filter``, ``left`` stays where it is."""
    keys = list(keys)
    if buckets is None:
        return null_safe_join(left, right, keys, "left")
    odd = any_null(keys)
    known = left.filter(~odd).join(right.filter(~odd).repartition(buckets, *keys).hint("merge"), keys, "left")
    return known.unionByName(null_safe_join(left.filter(odd), right.filter(odd), keys, "left"))
