"""State-history operators: change detection and suppression markers.

* ``changed_rows``       - lag-and-compare over (keys, order) as a segmented scan, skew-safe (W1, W2)
* ``compress_history``   - full history of one level from the raw log (C2, C3)
* ``detect_changes``     - changes of a new batch against stored state (C1, T6)
* ``suppressed_batch``   - keys whose last-seen day differs from ``as_of`` (C4, C5)
* ``suppressed_incremental`` - active keys absent from a snapshot (C6, C7)
* ``apply_snapshots``    - changes and markers of several snapshots in one pass (T2)
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from ..functions.nulls import any_null, keyed_filter, keyed_left_join, ne_or_null, not_blank, null_safe_join
from ..schemas import PARENT, SUPPRESSED, TENANT, TIE, TS, Level, require_columns
from .latest import first_per_key

def _order(ts: str, tie: str, pre=()) -> list[Column]:
    # Timestamps ascend with NULL last (N7); rows of one timestamp keep their
    # load order, given by the tie-breaker.
    return [F.col(ts).asc_nulls_last(), *[F.col(p).asc() for p in pre], F.col(tie).asc_nulls_first()]


def changed_rows(df: DataFrame, keys, state: str, ts: str = TS, tie: str = TIE, pre=(), always: Column | None = None) -> DataFrame:
    """The rows whose state differs from the previous row of their key.

    Rows are ordered by (``ts`` NULLS LAST, ``pre``..., ``tie``) within
    ``keys``.  A row is a change when it is the first of its key, when its
    state differs from the previous one with NULL counting as different (N1),
    or when a key column is NULL (N3: such rows have no predecessor).

    A segmented scan: the log is read once and shuffled once, into even ranges of
    (keys, order), so neither a hot key nor one of its days is one task's.  Each range is sorted and
    compared row by row, a batch of columns at a time; unchanged rows go no further.  Only a range's
    first row has its predecessor elsewhere: the last row of an earlier range, if that is of its key.  So the
    first and last row of every range, and no others, meet by key in a window; the changes pass it spread by a hash.

    ``always``: rows for which it holds come out whether they are changes or not.
    """
    keys = list(keys)
    order = [*keys, F.col(ts).isNull(), ts, *pre, tie]
    names = [f"_o{k}" for k in range(len(order))]
    x = df.withColumns({n: F.col(c) if isinstance(c, str) else c for n, c in zip(names, order)})
    if always is not None:
        x = x.withColumn("_always", F.coalesce(always, F.lit(False)))
    x = x.repartitionByRange(*names).sortWithinPartitions(*names)
    schema = StructType([*x.schema.fields, StructField("_changed", BooleanType()), StructField("_edge", BooleanType())])
    x = x.mapInArrow(_compared(keys, state, None if always is None else "_always"), schema)
    x = x.withColumn("_deal", F.when(~F.col("_edge"), F.xxhash64(*names)))
    edges = Window.partitionBy(*keys, "_deal").orderBy(*names)
    x = x.withColumn("_prev", F.lag(F.struct(F.col(state).alias("s"))).over(edges))
    differs = any_null(keys) | F.col("_prev").isNull() | ne_or_null(F.col(state), F.col("_prev.s"))
    if always is not None:
        differs = differs | F.col("_always")
    return x.filter(F.coalesce(F.col("_changed"), differs)).select(*df.columns)


def _compared(keys: list[str], state: str, always: str | None = None):
    """The changes (and ``always`` rows) among the sorted rows of a range, and its first row (``_changed`` is NULL, as the row before isn't here) and last row."""
    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        def marked(rows, changed, edge):
            edges = pa.repeat(pa.scalar(edge), len(rows))
            return pa.RecordBatch.from_arrays([*rows.columns, changed, edges], names=[*rows.schema.names, "_changed", "_edge"])

        last = last_changed = None  # the row before the batch, and whether it is a change
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            parts = []
            for name in (*keys, state):
                column = batch.column(batch.schema.get_field_index(name))
                before = pa.nulls(1, column.type) if last is None else last.column(last.schema.get_field_index(name))
                # NULL on either side counts as different
                parts.append(pc.fill_null(pc.not_equal(column, pa.concat_arrays([before, column.slice(0, n - 1)])), True))
            if always is not None:
                parts.append(batch.column(batch.schema.get_field_index(always)))
            changed = reduce(pc.or_, parts)
            start = 0
            if last is None:
                changed = pa.concat_arrays([pa.nulls(1, pa.bool_()), changed.slice(1)])
                if n > 1:
                    yield marked(batch.slice(0, 1), changed.slice(0, 1), True)
                start = 1
            elif not last_changed[0].is_valid:
                yield marked(last, last_changed, True)  # a first row alone in its batch
            elif last_changed[0].as_py():
                yield marked(last, last_changed, False)
            inner = batch.slice(start, max(0, n - 1 - start))
            kept = changed.slice(start, len(inner))
            inner = inner.filter(kept)
            if inner.num_rows:
                yield marked(inner, pa.repeat(pa.scalar(True), inner.num_rows), False)
            last, last_changed = batch.slice(n - 1, 1), changed.slice(n - 1, 1)
        if last is not None:
            yield marked(last, last_changed, True)
    return run


def level_rows(raw: DataFrame, level: Level) -> DataFrame:
    """The raw rows that belong to ``level`` (blank child keys removed, N10)."""
    if level.blank_key:
        raw = raw.filter(not_blank(level.blank_key))
    return raw


def compress_history(raw: DataFrame, level: Level = PARENT, tie: str = TIE) -> DataFrame:
    """Full state history of a level: one row per state transition.

    Returns the level's history columns plus the tie-breaker.
    """
    cols = list(level.columns) + [tie]
    require_columns(raw, cols, "raw log")
    rows = level_rows(raw.select(*cols), level)
    return changed_rows(rows, level.keys, level.state, TS, tie)


def detect_changes(new: DataFrame, stored_state: DataFrame | None, level: Level = PARENT,
                   tie: str = TIE, buckets: int | None = None) -> DataFrame:
    """Rows of a new batch whose state differs from the key's previous state.

    ``stored_state`` holds the newest stored row per key (``latest_state``)
    or is ``None`` on a first run.  Stored rows sort before new rows of the
    same timestamp; only rows of ``new`` are returned (``is_new`` origin flag,
    Q2), so a stored row is never emitted again.  A key whose stored state is
    ``Folio suprimido`` and that reappears yields a change row (T6).
    ``buckets``: the state is clustered by its keys into so many (``keyed_filter``).
    """
    cols = list(level.columns) + [tie]
    require_columns(new, cols, "batch")
    batch = level_rows(new.select(*cols), level).withColumn("_is_new", F.lit(True))
    if stored_state is not None:
        # Only keys of the batch need their stored state: the window then sees
        # O(batch) rows instead of one row per stored key.  A plain equi semi
        # join is exact - rows with a NULL key are changes anyway (N3) - and it
        # keeps the state's existing partitioning on the keys.
        keys = list(level.keys)
        wanted = batch.select(*keys).distinct()
        if buckets is not None:
            wanted = wanted.repartition(buckets, *keys)
        old = stored_state.select(*cols).join(wanted.hint("merge"), keys, "left_semi")
        batch = old.withColumn("_is_new", F.lit(False)).unionByName(batch)
    return changed_rows(batch, level.keys, level.state, TS, tie, pre=("_is_new",)).filter("_is_new").select(*cols)


def _as_date(as_of) -> Column:
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, str):
        as_of = dt.date.fromisoformat(as_of)
    return F.lit(as_of)


def suppressed_batch(raw: DataFrame, level: Level = PARENT, as_of=None, literal: bool = False,
                     tie: str = TIE) -> DataFrame:
    """Suppression markers of the batch rebuild.

    A key whose last-seen snapshot does not fall on ``as_of`` gets a row with
    state ``Folio suprimido`` at its *last-seen* timestamp.  ``as_of`` is a
    date parameter (default: the session's current date), so results are
    reproducible.

    Child level: by default children are decided on (tenant, child) with blank
    keys removed, and the parent of the newest row is reported (Q8).
    ``literal=True`` groups on (tenant, parent, child), keeps blank children
    and reports the smallest parent per (tenant, child).
    Parent context columns of child markers are NULL, as in the rebuild.
    """
    as_of = _as_date(as_of) if as_of is not None else F.current_date()
    seen = F.coalesce(F.to_date(F.col(TS)) != as_of, F.lit(True))
    if level is PARENT or not level.context:
        keys = list(level.keys)
        last = (raw.dropna(subset=keys).groupBy(*keys).agg(F.max(TS).alias(TS)).filter(seen))
        out = last.withColumn(level.state, F.lit(SUPPRESSED))
        return _pad(out, level, tie)
    parent = level.context[0]
    if literal:
        gk = list(level.dim_keys)
        last = (raw.dropna(subset=gk).groupBy(*gk).agg(F.max(TS).alias(TS)).filter(seen))
        pick = (last.groupBy(*level.keys)
                .agg(F.min(F.struct(F.col(parent), F.col(TS))).alias("_m"))
                .select(*level.keys, f"_m.{parent}", f"_m.{TS}"))
        return _pad(pick.withColumn(level.state, F.lit(SUPPRESSED)), level, tie)
    rows = level_rows(raw, level).dropna(subset=list(level.keys))
    # the newest row by time (unknown times last) and load order
    newest = first_per_key(rows.select(*dict.fromkeys([*level.keys, parent, TS, tie])), list(level.keys),
                           [F.col(TS).desc_nulls_last(), F.col(tie).desc_nulls_last()])
    return _pad(newest.filter(seen).drop(tie).withColumn(level.state, F.lit(SUPPRESSED)), level, tie)


def _pad(df: DataFrame, level: Level, tie: str) -> DataFrame:
    """Project onto the history columns; absent ones (and the tie) are NULL."""
    types = {TS: "timestamp_ntz", tie: "bigint"}
    absent = {c: F.lit(None).cast(types.get(c, "string")).alias(c) for c in [*level.columns, tie] if c not in df.columns}
    return df.select(*(absent.get(c, F.col(c)) for c in [*level.columns, tie]))


def suppressed_incremental(latest: DataFrame, snapshot: DataFrame, level: Level = PARENT,
                           scope: str = "global", tenant: str = TENANT, tie: str = TIE, buckets: int | None = None) -> DataFrame:
    """Suppression markers of the incremental run.

    ``latest`` is the newest stored row per key, ``snapshot`` the rows of the
    newest snapshot of the batch (``latest_snapshot``).  Every key whose
    newest state is not already ``Folio suprimido`` (a NULL state counts as
    active, N1) and that is absent from the snapshot (NULL keys match, N5)
    gets a marker at the snapshot's timestamp.  Child markers keep the parent
    context of the newest stored row (C7).

    The snapshot of a level is its own rows: a snapshot without rows of this
    level (no rows at all, or none with a child) suppresses nothing.

    ``scope="global"``: one snapshot time.  ``scope="tenant"``: only tenants
    with rows of this level in the snapshot are checked, each against its own
    snapshot time.

    ``buckets``: ``latest`` is clustered by its keys into so many; absence then moves the
    snapshot's keys only, not the state.
    """
    keys = list(level.keys)
    rows = level_rows(snapshot, level)
    present = rows.select(*keys).distinct()
    active = latest.filter(ne_or_null(F.col(level.state), F.lit(SUPPRESSED)))
    gone = keyed_filter(active, present, keys, "left_anti", buckets)
    if scope == "global":
        newest = rows.agg(F.max(TS)).scalar()
        gone = gone.withColumn(TS, newest).filter(F.col(TS).isNotNull())
    elif scope == "tenant":
        per_tenant = rows.groupBy(tenant).agg(F.max(TS).alias("_snap"))
        gone = null_safe_join(gone, per_tenant, [tenant], "inner", few=True)
        gone = gone.withColumn(TS, F.col("_snap")).drop("_snap")
    else:
        raise ValueError(f"unknown scope {scope!r}")
    gone = gone.withColumn(level.state, F.lit(SUPPRESSED)).withColumn(tie, F.lit(None).cast("bigint"))
    return gone.select(*level.columns, tie)


def apply_snapshots(batch: DataFrame, stored_state: DataFrame | None, level: Level = PARENT,
                    scope: str = "global", tenant: str = TENANT, tie: str = TIE, buckets: int | None = None) -> DataFrame:
    """Changes and markers of a batch of several snapshots, as one run per snapshot would add them.

    All snapshots are applied in one pass.  A key that is active at one
    snapshot (or in the stored state, before the first) and absent from the
    next one gets a marker there; a key's snapshots are a row each, so its next one is
    read beside it, and each stored row meets its key's presence at the first snapshot in one
    join, which tells both its marker and whether the pass needs it.  The markers then take part
    in change detection, so a key that comes back is a change (T6).  Child
    markers carry the context of the key's newest history row before them.
    Snapshots of a level are the times of its own rows, per tenant in tenant
    scope; a snapshot without rows of the level leaves it alone.
    ``buckets``: the stored state is clustered by its keys into so many and isn't moved.
    """
    if scope not in ("global", "tenant"):
        raise ValueError(f"unknown scope {scope!r}")
    keys, cols = list(level.keys), [*level.columns, tie]
    of = [tenant] if scope == "tenant" else []
    rows = level_rows(batch.select(*cols), level)
    # one row per key and snapshot; its last row there decides whether the key is active
    last, gone = F.max(tie), F.max(F.when(F.col(level.state) == SUPPRESSED, F.col(tie)))
    seen = rows.groupBy(*keys, TS).agg(F.coalesce(last == gone, F.lit(False)).alias("_gone"))
    times = rows.select(*of, TS).distinct()
    order = Window.partitionBy(*of).orderBy(TS)  # one row per snapshot (and tenant)
    steps = times.withColumn("_next", F.lead(TS).over(order))
    then = F.lead(TS).over(Window.partitionBy(*keys).orderBy(TS))  # at most a row per snapshot
    due = null_safe_join(seen.withColumn("_then", then).filter("NOT _gone"), steps, [*of, TS], few=True)
    missing = due.filter(F.col("_next").isNotNull() & ~F.col("_then").eqNullSafe(F.col("_next"))).select(*keys, F.col("_next").alias(TS))
    markers = _pad(missing.withColumn(level.state, F.lit(SUPPRESSED)), level, tie).withColumn("_kind", F.lit(2))
    every = rows.withColumn("_kind", F.lit(1)).unionByName(markers)
    if stored_state is not None:
        every = _stored_part(stored_state.select(*cols), seen, times, level, of, tie, buckets).unionByName(every)
    # the stored rows come out too, as the context of the markers
    always = F.col("_kind") == 0 if stored_state is not None and level.context else None
    line = changed_rows(every, keys, level.state, TS, tie, pre=("_kind",), always=always)
    if not level.context:
        return line.filter("_kind > 0").select(*cols)
    context = [c for c in level.context if c not in keys]
    before = Window.partitionBy(*keys).orderBy(*_order(TS, tie, ("_kind",))).rowsBetween(Window.unboundedPreceding, -1)
    newest = F.last(F.when(F.col("_kind") < 2, F.struct(*context)), ignorenulls=True).over(before)
    line = line.withColumn("_context", newest)
    for c in context:
        line = line.withColumn(c, F.when(F.col("_kind") == 2, F.col(f"_context.{c}")).otherwise(F.col(c)))
    return line.filter("_kind > 0").select(*cols)


def _stored_part(stored: DataFrame, seen: DataFrame, times: DataFrame, level: Level, of: list[str], tie: str, buckets: int | None) -> DataFrame:
    """What the stored state adds to a pass: the stored rows of the keys at hand (``_kind`` 0; NULL keys count for the
    markers' context only) and the markers of the active ones absent from the first snapshot (``_kind`` 2)."""
    keys = list(level.keys)
    if of:
        first = times.groupBy(*of).agg(F.min(TS).alias("_first"))
        seen = null_safe_join(seen, first, of, "inner", few=True)
    else:
        seen = seen.withColumn("_first", times.agg(F.min(TS)).scalar())
    there = seen.groupBy(*keys).agg(F.max(F.col(TS).eqNullSafe(F.col("_first"))).alias("_there"))
    known = keyed_left_join(stored, there, keys, buckets)
    # stored keys are due at the first snapshot, in tenant scope at their tenant's if it has one
    if of:
        known = null_safe_join(known, first.withColumn("_due", F.lit(True)), of, "left", few=True).withColumn("_due", F.coalesce("_due", F.lit(False)))
    else:
        known = known.withColumn("_first", times.agg(F.min(TS)).scalar()).withColumn("_due", F.col("_first").isNotNull())
    absent = F.col("_due") & ne_or_null(F.col(level.state), F.lit(SUPPRESSED)) & ~F.coalesce("_there", F.lit(False))
    kinds = F.when(absent, F.array(F.lit(0), F.lit(2))).when(F.col("_there").isNotNull(), F.array(F.lit(0)))
    known = known.withColumn("_kind", F.explode(kinds))
    marks = {TS: F.col("_first"), level.state: F.lit(SUPPRESSED)}
    own = [F.col(c) if c in keys else F.when(F.col("_kind") == 2, marks.get(c, F.lit(None))).otherwise(F.col(c)).alias(c) for c in [*level.columns, tie]]
    return known.select(*own, "_kind")
