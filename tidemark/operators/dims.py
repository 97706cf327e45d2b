"""Dimension operators: one row per case, derived from the raw log and history.

``rules="batch"`` reproduces the full rebuild, ``rules="incremental"`` the
affected-key refresh; they differ where the two programs differ (README,
"Two rule sets").  All joins are on full keys (tenant + case) unless
``match_tenant=False`` asks for the case-only matching of the original (Q10).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import eq_strict, ne_or_null, not_blank, not_contains_or_null, not_in_or_null, null_safe_join
from ..functions.text import extract_code
from ..schemas import (ASSIGNED, BENEFIT_COLUMNS, CHILD, CHILD_BASE, CHILD_DIM, CODED_URL_MARK, CURRENT,
                       DETAIL_COLUMNS, LEGACY, NOT_ACCEPTED, PARENT, PARENT_DIM, PARENT_STATIC, TIE, TS)
from .latest import first_last_state, first_per_key, load_order, newest_first

RULES = ("batch", "incremental")


def _check_rules(rules: str) -> None:
    if rules not in RULES:
        raise ValueError(f"rules must be one of {RULES}, got {rules!r}")


# ---------------------------------------------------------------- parent side

def tenant_start(raw: DataFrame) -> DataFrame:
    """Earliest snapshot of each tenant (C9): ``cliente, fecha_primer_registro``."""
    return (raw.dropna(subset=["cliente"]).groupBy("cliente")
            .agg(F.min(TS).alias("fecha_primer_registro")))


def followup_class(static: DataFrame, starts: DataFrame) -> DataFrame:
    """``tipo_seguimiento``: ``current`` when assigned on/after the tenant's start,
    ``legacy`` when before; rows with an unknown date or tenant drop out (C10, N9).

    The tenant table has one row per tenant; AQE broadcasts it from its measured size.
    """
    j = static.join(starts, on="cliente", how="left")
    a, s = F.col("fecha_asignacion"), F.col("fecha_primer_registro")
    cls = F.when(a >= s, F.lit(CURRENT)).when(a < s, F.lit(LEGACY))
    return j.withColumn("tipo_seguimiento", cls).filter(F.col("tipo_seguimiento").isNotNull())


def parent_static(raw: DataFrame, rules: str = "batch", tie: str = TIE) -> DataFrame:
    """Static attributes per (tenant, parent) (C14).

    batch: drop coded URLs, then keep the first loaded row.
    incremental: keep the newest row, then drop it if its URL is coded (Q4).
    A NULL URL is never treated as coded.
    """
    _check_rules(rules)
    cols = list(PARENT_STATIC) + [TS, tie]
    rows = raw.select(*cols)
    keys = ["cliente", "folio_padre"]
    if rules == "batch":
        out = first_per_key(rows.filter(not_contains_or_null("url_ficha", CODED_URL_MARK)), keys, load_order(tie))
    else:
        out = first_per_key(rows, keys, newest_first(TS, tie)).filter(
            not_contains_or_null("url_ficha", CODED_URL_MARK))
    return out.select(*PARENT_STATIC)


def acceptance_current(history: DataFrame) -> DataFrame:
    """Earliest history time in an accepted state (C11): not assigned, suppressed
    or rejected; NULL states count as accepted (N2).  One row per key (Q6)."""
    return (history.dropna(subset=["cliente", "folio_padre"])
            .filter(not_in_or_null("estado_padre", NOT_ACCEPTED))
            .groupBy("cliente", "folio_padre").agg(F.min(TS).alias("fecha_asignacion_aceptada")))


def _restrict(history: DataFrame, cases: DataFrame, match_tenant: bool) -> DataFrame:
    keys = ["cliente", "folio_padre"] if match_tenant else ["folio_padre"]
    return null_safe_join(history, cases.select(*keys).distinct(), keys, "left_semi")


def acceptance_legacy_incremental(legacy: DataFrame, history: DataFrame,
                                  match_tenant: bool = True) -> DataFrame:
    """Acceptance date of legacy cases, incremental rule.

    A case that was ever ``Asignado`` takes its earliest time in any other
    state (NULL counts as other, N1), which may be NULL; any other case takes
    its assignment date.
    """
    hist = _restrict(history, legacy, match_tenant).dropna(subset=["cliente", "folio_padre"])
    first_other = hist.groupBy("cliente", "folio_padre").agg(
        F.min(F.when(ne_or_null("estado_padre", F.lit(ASSIGNED)), F.col(TS))).alias("_first_other"),
        F.max(eq_strict("estado_padre", F.lit(ASSIGNED))).alias("_assigned"))
    if match_tenant:
        out = null_safe_join(legacy, first_other, ["cliente", "folio_padre"], "left")
    else:
        assigned = (hist.filter(eq_strict("estado_padre", F.lit(ASSIGNED)))
                    .select("folio_padre").distinct().withColumn("_assigned_f", F.lit(True)))
        out = null_safe_join(legacy, first_other.drop("_assigned"), ["cliente", "folio_padre"], "left")
        out = null_safe_join(out, assigned, ["folio_padre"], "left").withColumnRenamed("_assigned_f", "_assigned")
    accepted = F.when(F.coalesce(F.col("_assigned"), F.lit(False)), F.col("_first_other")).otherwise(
        F.col("fecha_asignacion"))
    return out.withColumn("fecha_asignacion_aceptada", accepted).drop("_first_other", "_assigned")


def acceptance_legacy_batch(legacy: DataFrame, history: DataFrame, match_tenant: bool = True) -> DataFrame:
    """Acceptance date of legacy cases, rebuild rule.

    Among "identifiable" cases (ever ``Asignado``), the case's earliest
    history time, provided a row at exactly that time is in another state
    (NULL counts as other); otherwise the assignment date.  ``match_tenant=False``
    reproduces the original's identifiability test, which checks tenant and
    case *independently*.
    """
    keys = ["cliente", "folio_padre"]
    hist = _restrict(history, legacy, match_tenant)
    ident = hist.filter(eq_strict("estado_padre", F.lit(ASSIGNED))).select(*keys).distinct()
    if match_tenant:
        hist = null_safe_join(hist, ident, keys, "left_semi")
    else:
        tenants = ident.select("cliente").distinct()
        hist = null_safe_join(hist, tenants, ["cliente"], "left_semi", few=True)
        hist = null_safe_join(hist, ident.select("folio_padre").distinct(), ["folio_padre"], "left_semi")
    # Earliest (time, is-Asignado) pair: the flag is 0 when some row at the
    # earliest time is in another state.
    flag = F.when(eq_strict("estado_padre", F.lit(ASSIGNED)), F.lit(1)).otherwise(F.lit(0))
    first = (hist.dropna(subset=keys).groupBy(*keys)
             .agg(F.min(F.when(F.col(TS).isNotNull(), F.struct(F.col(TS).alias("t"), flag.alias("a"))))
                  .alias("_m"))
             .select(*keys, F.when(F.col("_m.a") == 0, F.col("_m.t")).alias("_first")))
    out = null_safe_join(legacy, first, keys, "left")
    return (out.withColumn("fecha_asignacion_aceptada", F.coalesce(F.col("_first"), F.col("fecha_asignacion")))
            .drop("_first"))


def latest_details(details: DataFrame, tie: str = TIE) -> DataFrame:
    """One detail row per URL, the last loaded."""
    return first_per_key(details.select(*DETAIL_COLUMNS, tie), ["url_ficha"], load_order(tie, last=True)
                         ).select(*DETAIL_COLUMNS)


def detail_enrichment(dim: DataFrame, details: DataFrame, tie: str = TIE) -> DataFrame:
    """Left join of the newest detail row per URL."""
    return null_safe_join(dim, latest_details(details, tie), ["url_ficha"], "left")


def parent_latest_state(history: DataFrame, rules: str = "batch", tie: str = TIE) -> DataFrame:
    """Last state of each parent and its time (C16): the last whole row (batch,
    D5) or the last non-NULL state with the newest time (incremental, A7)."""
    _check_rules(rules)
    return first_last_state(history, ["cliente", "folio_padre"], "estado_padre", TS, tie,
                            skip_nulls=(rules == "incremental"), first=False,
                            names={"last_state": "ultimo_estado_folio_padre",
                                   "last_ts": "fecha_ultimo_estado_folio_padre"})


def _rank(tie: str = TIE):
    # Ascending history order as one comparable value (see latest._rank_struct).
    return F.struct(F.col(TS).isNull(), F.col(TS), F.col(tie).isNull(), F.col(tie))


def parent_summary_parts(history: DataFrame, tie: str = TIE) -> DataFrame:
    """Per-key partial aggregates of the history under the incremental rules.

    Every column is a MIN or MAX, so parts computed over any split of the
    history (base + per-run deltas, even overlapping ones) merge into the same
    result with ``merge_parent_summary``: a run never rescans old history.
    """
    keys = ["cliente", "folio_padre"]
    ok = ~(F.col("cliente").isNull() | F.col("folio_padre").isNull())
    state, ts = F.col("estado_padre"), F.col(TS)
    return history.groupBy(*keys).agg(
        F.min(F.when(ok & not_in_or_null(state, NOT_ACCEPTED), ts)).alias("_acc_current"),
        F.max(F.when(ok, eq_strict(state, F.lit(ASSIGNED)))).alias("_assigned"),
        F.min(F.when(ok & ne_or_null(state, F.lit(ASSIGNED)), ts)).alias("_first_other"),
        F.max(F.when(ok & state.isNotNull(), F.struct(_rank(tie).alias("r"), state.alias("s")))).alias("_last"),
        F.max(F.when(ok, ts)).alias("_last_ts"))


def merge_parent_summary(parts: DataFrame) -> DataFrame:
    keys = ["cliente", "folio_padre"]
    return parts.groupBy(*keys).agg(
        F.min("_acc_current").alias("_acc_current"), F.max("_assigned").alias("_assigned"),
        F.min("_first_other").alias("_first_other"), F.max("_last").alias("_last"),
        F.max("_last_ts").alias("_last_ts"))


def finish_parent_summary(parts: DataFrame) -> DataFrame:
    return parts.select("cliente", "folio_padre", "_acc_current", "_assigned", "_first_other",
                        F.col("_last.s").alias("ultimo_estado_folio_padre"),
                        F.col("_last_ts").alias("fecha_ultimo_estado_folio_padre"))


def parent_history_summary(history: DataFrame, rules: str = "batch", tie: str = TIE) -> DataFrame:
    """Everything the parent dimension needs from history, in one aggregate per key.

    Acceptance inputs of both classes (C11, C12 or C13) and the latest state
    (C16) share one shuffle of the history instead of one each.  Aggregates
    that the single operators compute with NULL keys dropped (N4) are masked
    to NULL for a NULL-key group, which a left join yields as well.
    """
    _check_rules(rules)
    if rules == "incremental":
        return finish_parent_summary(parent_summary_parts(history, tie))
    keys = ["cliente", "folio_padre"]
    ok = ~(F.col("cliente").isNull() | F.col("folio_padre").isNull())
    state, ts = F.col("estado_padre"), F.col(TS)
    flag = F.when(eq_strict(state, F.lit(ASSIGNED)), F.lit(1)).otherwise(F.lit(0))
    out = history.groupBy(*keys).agg(
        F.min(F.when(ok & not_in_or_null(state, NOT_ACCEPTED), ts)).alias("_acc_current"),
        F.max(F.when(ok, eq_strict(state, F.lit(ASSIGNED)))).alias("_assigned"),
        F.min(F.when(ok & ts.isNotNull(), F.struct(ts.alias("t"), flag.alias("a")))).alias("_m"),
        F.max_by(F.struct(state.alias("s"), ts.alias("t")), _rank(tie)).alias("_l"))
    return (out.select(*keys, "_acc_current", "_assigned",
                       F.when(F.coalesce(F.col("_assigned"), F.lit(False)) & (F.col("_m.a") == 0), F.col("_m.t"))
                       .alias("_first_batch"),
                       F.col("_l.s").alias("ultimo_estado_folio_padre"),
                       F.col("_l.t").alias("fecha_ultimo_estado_folio_padre")))


def parent_dim(raw: DataFrame, history: DataFrame | None, details: DataFrame, rules: str = "batch",
               starts: DataFrame | None = None, match_tenant: bool = True, tie: str = TIE,
               summary: DataFrame | None = None) -> DataFrame:
    """Parent dimension (C24 / C26): static attributes, follow-up class,
    acceptance date, case details and latest state; 14 columns.

    ``raw`` and ``history`` may be restricted to some cases (affected-key
    refresh); ``starts`` must then come from the whole raw log.  History is
    aggregated once (``parent_history_summary``) and joined once; a run
    passes ``summary`` (merged parts, incremental rules) instead of history.
    """
    _check_rules(rules)
    static = parent_static(raw, rules, tie)
    classified = followup_class(static, starts if starts is not None else tenant_start(raw))
    if not match_tenant:
        return _parent_dim_case_keys(classified, history, details, rules, tie)
    keys = ["cliente", "folio_padre"]
    if summary is None:
        summary = parent_history_summary(history, rules, tie)
    dim = null_safe_join(classified, summary, keys, "left")
    assigned = F.coalesce(F.col("_assigned"), F.lit(False))
    if rules == "incremental":
        legacy = F.when(assigned, F.col("_first_other")).otherwise(F.col("fecha_asignacion"))
    else:
        legacy = F.coalesce(F.col("_first_batch"), F.col("fecha_asignacion"))
    accepted = F.when(F.col("tipo_seguimiento") == CURRENT, F.col("_acc_current")).otherwise(legacy)
    dim = dim.withColumn("fecha_asignacion_aceptada", accepted)
    dim = detail_enrichment(dim, details, tie)
    return dim.select(*PARENT_DIM)


def _parent_dim_case_keys(classified: DataFrame, history: DataFrame, details: DataFrame, rules: str,
                          tie: str) -> DataFrame:
    """Parent dimension with the original's case-only history matching (Q10)."""
    current = classified.filter(F.col("tipo_seguimiento") == CURRENT)
    current = null_safe_join(current, acceptance_current(history), ["cliente", "folio_padre"], "left")
    legacy = classified.filter(F.col("tipo_seguimiento") == LEGACY)
    if rules == "batch":
        legacy = acceptance_legacy_batch(legacy, history, False)
    else:
        legacy = acceptance_legacy_incremental(legacy, history, False)
    dim = current.unionByName(legacy).drop("fecha_primer_registro")
    dim = detail_enrichment(dim, details, tie)
    dim = null_safe_join(dim, parent_latest_state(history, rules, tie), ["cliente", "folio_padre"], "left")
    return dim.select(*PARENT_DIM)


# ----------------------------------------------------------------- child side

def child_base(raw: DataFrame, rules: str = "batch", tie: str = TIE) -> DataFrame:
    """Base attributes per (tenant, parent, child), blank children removed (C17):
    the last loaded row (batch) or the newest row (incremental)."""
    _check_rules(rules)
    keys = ["cliente", "folio_padre", "folio_hijo"]
    rows = raw.select(*CHILD_BASE, TS, tie)
    order = load_order(tie, last=True) if rules == "batch" else newest_first(TS, tie)
    return first_per_key(rows, keys, order).filter(not_blank("folio_hijo")).select(*CHILD_BASE)


def latest_benefits(benefits: DataFrame, match_tenant: bool = True, tie: str = TIE) -> DataFrame:
    """One benefit row per (tenant, folio) - per folio with ``match_tenant=False``
    - the last loaded, with ``estado`` renamed ``estado_prestacion`` (C18)."""
    keys = ["cliente", "folio"] if match_tenant else ["folio"]
    return (first_per_key(benefits.select(*BENEFIT_COLUMNS, tie), keys, load_order(tie, last=True))
            .select("cliente", "folio", "descripcion", F.col("estado").alias("estado_prestacion")))


def benefit_enrichment(base: DataFrame, benefits: DataFrame, match_tenant: bool = True,
                       tie: str = TIE) -> DataFrame:
    """Left join of the latest benefit on (tenant, child) = (cliente, folio)."""
    return null_safe_join(base, latest_benefits(benefits, match_tenant, tie), ["cliente", "folio_hijo"],
                          "left", right_keys=["cliente", "folio"])


def child_followup(base: DataFrame, parents: DataFrame) -> DataFrame:
    """The parent's follow-up class, joined on (tenant, parent)."""
    return null_safe_join(base, parents.select("cliente", "folio_padre", "tipo_seguimiento"),
                          ["cliente", "folio_padre"], "left")


def child_first_last_state(history: DataFrame, rules: str = "batch", tie: str = TIE) -> DataFrame:
    """First and last state of each (tenant, parent, child) with times (C20), in
    one aggregate: whole rows (batch, D5) or non-NULL states (incremental, A6/A7)."""
    _check_rules(rules)
    return first_last_state(history, ["cliente", "folio_padre", "folio_hijo"], "estado_hijo", TS, tie,
                            skip_nulls=(rules == "incremental"),
                            names={"last_state": "ultimo_estado_folio_hijo",
                                   "last_ts": "fecha_ultimo_estado_folio_hijo",
                                   "first_state": "primer_estado_folio_hijo",
                                   "first_ts": "fecha_primer_estado_folio_hijo"})


def child_summary_parts(history: DataFrame, tie: str = TIE) -> DataFrame:
    """Mergeable per-key parts of the child's first/last state (incremental rules, A6/A7)."""
    keys = ["cliente", "folio_padre", "folio_hijo"]
    state, ts = F.col("estado_hijo"), F.col(TS)
    ranked = F.when(state.isNotNull(), F.struct(_rank(tie).alias("r"), state.alias("s")))
    return history.dropna(subset=keys).groupBy(*keys).agg(
        F.min(ranked).alias("_first"), F.min(ts).alias("_first_ts"),
        F.max(ranked).alias("_last"), F.max(ts).alias("_last_ts"))


def merge_child_parts(parts: DataFrame) -> DataFrame:
    keys = ["cliente", "folio_padre", "folio_hijo"]
    return parts.groupBy(*keys).agg(F.min("_first").alias("_first"), F.min("_first_ts").alias("_first_ts"),
                                    F.max("_last").alias("_last"), F.max("_last_ts").alias("_last_ts"))


def merge_child_summary(parts: DataFrame) -> DataFrame:
    """Merge parts and finish them into the four first/last columns."""
    keys = ["cliente", "folio_padre", "folio_hijo"]
    m = merge_child_parts(parts)
    return m.select(*keys, F.col("_last.s").alias("ultimo_estado_folio_hijo"),
                    F.col("_last_ts").alias("fecha_ultimo_estado_folio_hijo"),
                    F.col("_first.s").alias("primer_estado_folio_hijo"),
                    F.col("_first_ts").alias("fecha_primer_estado_folio_hijo"))


def with_code(df: DataFrame) -> DataFrame:
    """``grd``: the zero-padded code of ``descripcion`` for GRD children."""
    return df.withColumn("grd", extract_code("descripcion", "ppa_grd"))


def child_dim(raw: DataFrame, history: DataFrame | None, benefits: DataFrame, parents: DataFrame,
              rules: str = "batch", match_tenant: bool = True, tie: str = TIE,
              first_last: DataFrame | None = None) -> DataFrame:
    """Child dimension (C25 / C27); 15 columns.  A run passes ``first_last``
    (``merge_child_summary`` of stored parts) instead of history."""
    base = child_base(raw, rules, tie)
    base = benefit_enrichment(base, benefits, match_tenant, tie)
    base = child_followup(base, parents)
    if first_last is None:
        first_last = child_first_last_state(history, rules, tie)
    base = null_safe_join(base, first_last, ["cliente", "folio_padre", "folio_hijo"], "left")
    return with_code(base).select(*CHILD_DIM)


__all__ = [
    "tenant_start", "followup_class", "parent_static", "acceptance_current",
    "acceptance_legacy_incremental", "acceptance_legacy_batch", "latest_details",
    "detail_enrichment", "parent_latest_state", "parent_dim", "child_base",
    "latest_benefits", "benefit_enrichment", "child_followup", "child_first_last_state",
    "with_code", "child_dim", "PARENT", "CHILD",
]
