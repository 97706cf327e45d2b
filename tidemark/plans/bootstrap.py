"""Full rebuild (C29): two histories and two dimensions from the whole raw log."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dims import child_dim, child_summary_parts, parent_dim, parent_summary_parts, tenant_start
from ..operators.history import compress_history, level_rows, suppressed_batch
from ..operators.latest import latest_per_key, latest_state
from ..schemas import CHILD, CHILD_BASE, PARENT, PARENT_STATIC, RAW_COLUMNS, TENANT, TIE, TS, require_columns
from ..sinks.store import TableStore, together

# Table names in the store.
PARENT_HISTORY = "parent_history"
CHILD_HISTORY = "child_history"
PARENT_DIM = "parent_dim"
CHILD_DIM = "child_dim"
# State kept so that an incremental run never rescans the raw log: the newest
# raw row per parent and per child (what the incremental rules read) and the
# tenants' first snapshot.
LATEST_PARENT = "latest_parent"
LATEST_CHILD = "latest_child"
TENANT_START = "tenant_start"
# Newest history row per key, kept beside each history so that a run reads
# O(keys) rows instead of recomputing it over the whole history.
PARENT_STATE = "parent_state"
CHILD_STATE = "child_state"
# Mergeable per-key aggregates of each history (incremental rules): what the
# dimension refresh needs, without rescanning history.
PARENT_SUMMARY = "parent_summary"
CHILD_SUMMARY = "child_summary"

# Keyed tables are bucketed by these keys; the child's are (tenant, child), by
# which a batch's affected children are known.
P_KEYS, C_KEYS = list(PARENT.keys), list(CHILD.keys)


@dataclass
class Histories:
    parent: DataFrame
    child: DataFrame


def batch_histories(raw: DataFrame, as_of, literal_child: bool = False) -> Histories:
    """History tables of the rebuild: changes plus last-seen suppression markers."""
    parent = compress_history(raw, PARENT).unionByName(suppressed_batch(raw, PARENT, as_of))
    child = compress_history(raw, CHILD).unionByName(suppressed_batch(raw, CHILD, as_of, literal=literal_child))
    return Histories(parent, child)


def latest_parent_rows(raw: DataFrame) -> DataFrame:
    """Newest raw row per (tenant, parent), with the columns the parent dimension reads."""
    return latest_per_key(raw.select(*PARENT_STATIC, TS, TIE), P_KEYS)


def latest_child_rows(raw: DataFrame) -> DataFrame:
    """Newest raw row per (tenant, parent, child), with the columns the child dimension reads."""
    return latest_per_key(level_rows(raw.select(*CHILD_BASE, TS, TIE), CHILD), list(CHILD.dim_keys))


def bootstrap(store: TableStore, raw: DataFrame, details: DataFrame, benefits: DataFrame, as_of,
              literal_child: bool = False, match_tenant: bool = True) -> dict:
    """Rebuild every table from ``raw`` (replace, K2) and record the mark, in one commit.

    The raw log is scanned once; the passes below read that scan's columns from
    the executors' disks (a lost executor's share is scanned again).  Derived
    tables are read back as written before the next one uses them.
    Returns row counts per table.
    """
    require_columns(raw, RAW_COLUMNS, "raw log")
    raw = raw.select(*RAW_COLUMNS).persist(StorageLevel.DISK_ONLY)
    try:
        tx = store.transaction()
        h = batch_histories(raw, as_of, literal_child)
        ph, ch, starts, _, _ = together(
            lambda: tx.replace(h.parent, PARENT_HISTORY),
            lambda: tx.replace(h.child, CHILD_HISTORY),
            lambda: tx.replace(tenant_start(raw), TENANT_START),
            lambda: tx.replace(latest_parent_rows(raw), LATEST_PARENT, P_KEYS),
            lambda: tx.replace(latest_child_rows(raw), LATEST_CHILD, C_KEYS))
        pdim, *_ = together(
            lambda: tx.replace(parent_dim(raw, ph, details, "batch", starts=starts, match_tenant=match_tenant), PARENT_DIM, P_KEYS),
            lambda: tx.replace(latest_state(ph, PARENT), PARENT_STATE, cluster=P_KEYS),
            lambda: tx.replace(latest_state(ch, CHILD), CHILD_STATE, cluster=C_KEYS),
            lambda: tx.replace(parent_summary_parts(ph), PARENT_SUMMARY, P_KEYS),
            lambda: tx.replace(child_summary_parts(ch), CHILD_SUMMARY, C_KEYS))
        cdim = tx.replace(child_dim(raw, ch, benefits, pdim, "batch", match_tenant=match_tenant), CHILD_DIM, C_KEYS)
        seen = raw.groupBy(TENANT).agg(F.max(TS).alias("mark"), F.count(F.lit(1)).alias("rows")).collect()
        marks = marks_of((r[TENANT], r["mark"]) for r in seen)
        tx.state.runs, tx.state.marks = [], {}
        tx.commit({"run_id": "bootstrap", "mark": marks.get(""), "rows": sum(r["rows"] for r in seen), "late": 0}, marks)
        return {t: d.count() for t, d in ((PARENT_HISTORY, ph), (CHILD_HISTORY, ch), (PARENT_DIM, pdim), (CHILD_DIM, cdim))}
    finally:
        raw.unpersist()


def marks_of(newest) -> dict[str, str]:
    """High-water marks for a manifest from (tenant, newest time): one for all rows (``""``), one per tenant (``"t" + tenant``)."""
    known = [(t, m) for t, m in newest if m is not None]
    marks = {"n" if t is None else f"t{t}": m.isoformat(sep=" ") for t, m in known}
    return marks | ({"": max(m for _, m in known).isoformat(sep=" ")} if known else {})
