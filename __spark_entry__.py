"""

Every query reads the driver's tables through the case-log fixtures
(``tidemark.sources.fixtures``) and runs over them whole.  Dates that select
a scenario (the seed day, the as-of day) are literals, never the clock.
"""

from __future__ import annotations

import datetime as dt
import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracle as O
from tidemark.operators import dims as D
from tidemark.operators.history import apply_snapshots, compress_history, detect_changes, suppressed_batch, suppressed_incremental
from tidemark.operators.latest import latest_snapshot, latest_state
from tidemark.plans.bootstrap import CHILD_DIM, CHILD_HISTORY, PARENT_DIM, PARENT_HISTORY
from tidemark.plans.increment import affected_keys, high_water_mark, incremental_scan, tenant_marks
from tidemark.plans.scenario import SEED_AS_OF, SEED_MARK, assembled_runs, daily_runs, keyed_stream, late_rows, retried_runs, streamed_runs, tenant_run
from tidemark.schemas import CHILD, PARENT, PARENT_STATIC, CHILD_BASE
from tidemark.sources import fixtures as fx
from tidemark.functions.time import ntz

try:  # the training-data operators and their pipeline are a part that can be left out
    from tidemark.llm import registry as llm
except ImportError as error:
    if error.name not in ("tidemark.llm", "tidemark.llm.registry", "corpus_pipeline"):
        warnings.warn(f"the training-data operators are left out: {error}", stacklevel=2)
    llm = None

SF_SMOKE = "/root/testdata/sf0.001"
AS_OF = "2024-01-30"
DAY1 = dt.datetime(2024, 1, 21)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the full parent state history (changes + suppression markers)."""
    return _parent_history_table(spark, SF_SMOKE)


# ------------------------------------------------------------------ helpers

def _raw(spark, sf):
    return fx.case_log(spark, sf)


def _hist(spark, sf, level, as_of=AS_OF, raw=None):
    raw = raw if raw is not None else _raw(spark, sf)
    return compress_history(raw, level).unionByName(suppressed_batch(raw, level, as_of))


def _seed(spark, sf):
    raw = _raw(spark, sf)
    return raw.filter(F.col("fecha_registro") <= ntz(SEED_MARK)), raw.filter(
        F.col("fecha_registro") > ntz(SEED_MARK))


def _seed_state(spark, sf, level):
    seed, later = _seed(spark, sf)
    return latest_state(_hist(spark, sf, level, SEED_AS_OF, seed), level), later


def _parent_history_table(spark, sf):
    return _hist(spark, sf, PARENT).select(*PARENT.columns)


def _classified(spark, sf, rules="batch"):
    raw = _raw(spark, sf)
    return D.followup_class(D.parent_static(raw, rules), D.tenant_start(raw))


def _parent_dim(spark, sf):
    raw = _raw(spark, sf)
    return D.parent_dim(raw, _hist(spark, sf, PARENT, raw=raw), fx.case_details(spark, sf), "batch")


def _child_dim(spark, sf):
    raw = _raw(spark, sf)
    return D.child_dim(raw, _hist(spark, sf, CHILD, raw=raw), fx.benefits(spark, sf), _parent_dim(spark, sf), "batch")


def _parent_dim_incr(spark, sf):
    raw = _raw(spark, sf)
    return D.parent_dim(raw, _hist(spark, sf, PARENT, raw=raw), fx.case_details(spark, sf), "incremental")


def _child_dim_incr(spark, sf):
    raw = _raw(spark, sf)
    return D.child_dim(raw, _hist(spark, sf, CHILD, raw=raw), fx.benefits(spark, sf), _parent_dim_incr(spark, sf),
                       "incremental")


def _store_table(store_fn, table, level):
    def run(spark, sf):
        return store_fn(spark, sf).read(table).select(*level.columns)
    return run


def _marks(spark, sf):
    """The marks of the daily runs, and the rows they cover."""
    store = daily_runs(spark, sf)
    mark, history_mark = high_water_mark(store), high_water_mark(store, "history")
    return _raw(spark, sf).agg(F.count(F.when(F.col("fecha_registro") <= ntz(mark), 1)).alias("n_rows")).select(
        ntz(mark).alias("mark"), ntz(history_mark).alias("history_mark"), "n_rows")


def _tenant_marks(spark, sf):
    marks = tenant_marks(tenant_run(spark, sf))
    raw = fx.case_log(spark, sf, staggered=True)
    rows = raw.groupBy("cliente").agg(F.count(F.lit(1)).alias("n_rows"))
    table = spark.createDataFrame(list(marks.items()), "cliente string, mark timestamp_ntz")
    return rows.join(table, "cliente").select("cliente", "mark", "n_rows")


def _childless(spark, sf):
    """The log with the children of every third day blanked: snapshots without children."""
    raw = _raw(spark, sf)
    return raw.withColumn("folio_hijo", F.when(F.dayofmonth("fecha_registro") % 3 == 0, F.lit("")).otherwise(F.col("folio_hijo")))


def _childless_changes(level):
    def run(spark, sf):
        raw = _childless(spark, sf)
        seed, later = raw.filter(F.col("fecha_registro") < ntz(DAY1)), raw.filter(F.col("fecha_registro") >= ntz(DAY1))
        state = latest_state(_hist(spark, sf, level, SEED_AS_OF, seed), level)
        return apply_snapshots(later, state, level).select(*level.columns)
    return run


def _childless_suppressed(spark, sf):
    """The day after the seed has no children: nothing is suppressed that day; the next day counts."""
    raw = _childless(spark, sf)
    seed = raw.filter(F.col("fecha_registro") < ntz(DAY1))
    state = latest_state(_hist(spark, sf, CHILD, SEED_AS_OF, seed), CHILD)
    days = [raw.filter(F.col("fecha_registro") == ntz(DAY1 + dt.timedelta(days=k))) for k in (0, 1)]
    return suppressed_incremental(state, days[0], CHILD).unionByName(suppressed_incremental(state, days[1], CHILD)).select(*CHILD.columns)


# ------------------------------------------------------------------ queries

def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return core_queries() | (llm.QUERIES if llm else {})


def oracle_sql() -> dict[str, str]:
    return core_oracle_sql() | (llm.ORACLE_SQL if llm else {})


def core_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Queries of the reference's own operators."""
    def staggered(spark, sf):
        return fx.case_log(spark, sf, staggered=True)

    def supp_staggered(scope):
        def run(spark, sf):
            raw = staggered(spark, sf)
            seed = raw.filter(F.col("fecha_registro") < ntz(DAY1))
            later = raw.filter(F.col("fecha_registro") >= ntz(DAY1))
            state = latest_state(compress_history(seed, PARENT).unionByName(
                suppressed_batch(seed, PARENT, SEED_AS_OF)), PARENT)
            snap = latest_snapshot(later, scope)
            return suppressed_incremental(state, snap, PARENT, scope=scope).select(*PARENT.columns)
        return run

    def changes(level):
        def run(spark, sf):
            state, later = _seed_state(spark, sf, level)
            return detect_changes(later, state, level).select(*level.columns)
        return run

    def supp_incr(level):
        def run(spark, sf):
            state, later = _seed_state(spark, sf, level)
            return suppressed_incremental(state, latest_snapshot(later), level).select(*level.columns)
        return run

    def acceptance(kind):
        def run(spark, sf):
            raw = _raw(spark, sf)
            cls = D.followup_class(D.parent_static(raw, "batch"), D.tenant_start(raw))
            hist = _hist(spark, sf, PARENT, raw=raw)
            if kind == "current":
                cur = cls.filter(F.col("tipo_seguimiento") == "current")
                out = cur.join(D.acceptance_current(hist), ["cliente", "folio_padre"], "left")
            elif kind == "legacy_incr":
                out = D.acceptance_legacy_incremental(cls.filter(F.col("tipo_seguimiento") == "legacy"), hist)
            else:
                out = D.acceptance_legacy_batch(cls.filter(F.col("tipo_seguimiento") == "legacy"), hist)
            return out.select(*PARENT_STATIC, "tipo_seguimiento", "fecha_asignacion_aceptada")
        return run

    def latest_state_q(level):
        def run(spark, sf):
            return latest_state(_hist(spark, sf, level), level).select(*level.columns)
        return run

    def first_last(rules):
        def run(spark, sf):
            return D.child_first_last_state(_hist(spark, sf, CHILD), rules)
        return run

    def parent_last(rules):
        def run(spark, sf):
            return D.parent_latest_state(_hist(spark, sf, PARENT), rules)
        return run

    def aff_keys(spark, sf):
        state, later = _seed_state(spark, sf, PARENT)
        markers = apply_snapshots(later, state, PARENT).filter(F.col("load_seq").isNull())
        return affected_keys(later, markers, PARENT)

    return {
        "case_log": lambda s, sf: _raw(s, sf),
        "incremental_scan": lambda s, sf: incremental_scan(_raw(s, sf), SEED_MARK),
        "high_water_mark": _marks,
        "tenant_marks": _tenant_marks,
        "latest_snapshot_global": lambda s, sf: latest_snapshot(_raw(s, sf), "global"),
        "tenant_latest_snapshot": lambda s, sf: latest_snapshot(staggered(s, sf), "tenant"),
        "parent_history": lambda s, sf: compress_history(_raw(s, sf), PARENT).select(*PARENT.columns),
        "child_history": lambda s, sf: compress_history(_raw(s, sf), CHILD).select(*CHILD.columns),
        "suppressed_batch_parent": lambda s, sf: suppressed_batch(_raw(s, sf), PARENT, AS_OF).select(*PARENT.columns),
        "suppressed_batch_child": lambda s, sf: suppressed_batch(_raw(s, sf), CHILD, AS_OF).select(*CHILD.columns),
        "suppressed_batch_child_literal": lambda s, sf: suppressed_batch(
            _raw(s, sf), CHILD, AS_OF, literal=True).select(*CHILD.columns),
        "parent_history_table": _parent_history_table,
        "child_history_table": lambda s, sf: _hist(s, sf, CHILD).select(*CHILD.columns),
        "latest_state_parent": latest_state_q(PARENT),
        "latest_state_child": latest_state_q(CHILD),
        "changes_vs_state_parent": changes(PARENT),
        "changes_vs_state_child": changes(CHILD),
        "suppressed_incr_parent": supp_incr(PARENT),
        "suppressed_incr_child": supp_incr(CHILD),
        "suppressed_incr_staggered_global": supp_staggered("global"),
        "suppressed_incr_staggered_tenant": supp_staggered("tenant"),
        "tenant_start": lambda s, sf: D.tenant_start(_raw(s, sf)),
        "followup_class": lambda s, sf: _classified(s, sf).select(*PARENT_STATIC, "tipo_seguimiento"),
        "acceptance_current": acceptance("current"),
        "acceptance_legacy_incr": acceptance("legacy_incr"),
        "acceptance_legacy_batch": acceptance("legacy_batch"),
        "parent_static_batch": lambda s, sf: D.parent_static(_raw(s, sf), "batch"),
        "parent_static_incr": lambda s, sf: D.parent_static(_raw(s, sf), "incremental"),
        "latest_details": lambda s, sf: D.latest_details(fx.case_details(s, sf)),
        "detail_enrichment": lambda s, sf: D.detail_enrichment(D.parent_static(_raw(s, sf), "batch"),
                                                               fx.case_details(s, sf)),
        "parent_latest_state": parent_last("batch"),
        "parent_latest_state_incr": parent_last("incremental"),
        "child_base_batch": lambda s, sf: D.child_base(_raw(s, sf), "batch"),
        "child_base_incr": lambda s, sf: D.child_base(_raw(s, sf), "incremental"),
        "benefit_enrichment": lambda s, sf: D.benefit_enrichment(D.child_base(_raw(s, sf), "batch"),
                                                                 fx.benefits(s, sf)),
        "code_extraction": lambda s, sf: D.with_code(D.benefit_enrichment(
            D.child_base(_raw(s, sf), "batch"), fx.benefits(s, sf))).select(
                "cliente", "folio_padre", "folio_hijo", "ppa_grd", "descripcion", "grd"),
        "child_followup": lambda s, sf: D.child_followup(D.child_base(_raw(s, sf), "batch"),
                                                         _parent_dim(s, sf)).select(*CHILD_BASE, "tipo_seguimiento"),
        "child_first_last_state": first_last("batch"),
        "child_first_last_state_incr": first_last("incremental"),
        "affected_keys": aff_keys,
        "parent_dim_full": _parent_dim,
        "child_dim_full": _child_dim,
        "parent_dim_incr_rules": _parent_dim_incr,
        "child_dim_incr_rules": _child_dim_incr,
        "changes_childless_days": _childless_changes(CHILD),
        "changes_childless_days_parent": _childless_changes(PARENT),
        "suppressed_childless_day": _childless_suppressed,
        "parent_dim_upsert": lambda s, sf: daily_runs(s, sf).read(PARENT_DIM),
        "child_dim_upsert": lambda s, sf: daily_runs(s, sf).read(CHILD_DIM),
        "parent_dim_stream": lambda s, sf: streamed_runs(s, sf).read(PARENT_DIM),
        "child_dim_stream": lambda s, sf: streamed_runs(s, sf).read(CHILD_DIM),
        "retry_history_parent": _store_table(retried_runs, PARENT_HISTORY, PARENT),
        "retry_history_child": _store_table(retried_runs, CHILD_HISTORY, CHILD),
        "tenant_run_history_parent": _store_table(tenant_run, PARENT_HISTORY, PARENT),
        "tenant_run_history_child": _store_table(tenant_run, CHILD_HISTORY, CHILD),
        "incremental_run_history_parent": _store_table(daily_runs, PARENT_HISTORY, PARENT),
        "incremental_run_history_child": _store_table(daily_runs, CHILD_HISTORY, CHILD),
        "stream_history_parent": _store_table(streamed_runs, PARENT_HISTORY, PARENT),
        "stream_history_child": _store_table(streamed_runs, CHILD_HISTORY, CHILD),
        "assembled_history_parent": _store_table(assembled_runs, PARENT_HISTORY, PARENT),
        "assembled_history_child": _store_table(assembled_runs, CHILD_HISTORY, CHILD),
        "stream_late_rows": late_rows,
        "keyed_history_parent": lambda s, sf: keyed_stream(s, sf, PARENT),
        "keyed_history_child": lambda s, sf: keyed_stream(s, sf, CHILD),
    }


# ------------------------------------------------------------------- oracles

def _sql(build) -> str:
    q = O.base_query()
    return build(q)


def core_oracle_sql() -> dict[str, str]:
    def hist(q, level, src="case_log"):
        return O.history_table(q, src, level, O.AS_OF)

    def seed_state(q, level):
        seed, later = O.seed_and_later(q)
        return O.latest_state(q, O.history_table(q, seed, level, O.SEED_DATE), level), later

    def changes(level):
        def b(q):
            st, later = seed_state(q, level)
            return q.select(f"SELECT {O.LEVELS[level]['cols']} FROM {O.changes_vs_state(q, st, later, level)}")
        return b

    def supp_incr(level):
        def b(q):
            st, later = seed_state(q, level)
            return q.select(f"SELECT {O.LEVELS[level]['cols']} FROM {O.suppressed_incr(q, st, later, level)}")
        return b

    def supp_staggered(scope):
        def b(q):
            seed = q.add("stag_seed", f"SELECT * FROM case_log_staggered WHERE fecha_registro < {O.DAY1}")
            later = q.add("stag_later", f"SELECT * FROM case_log_staggered WHERE fecha_registro >= {O.DAY1}")
            st = O.latest_state(q, O.history_table(q, seed, "parent", O.SEED_DATE), "parent")
            return q.select(f"SELECT {O.P_COLS} FROM {O.suppressed_incr(q, st, later, 'parent', scope)}")
        return b

    def classified(q, rules="batch"):
        return O.followup(q, O.parent_static(q, "case_log", rules), O.tenant_start(q, "case_log"))

    def acceptance(kind):
        def b(q):
            cls = classified(q)
            h = hist(q, "parent")
            fn = {"current": O.acceptance_current, "legacy_incr": O.acceptance_legacy_incr,
                  "legacy_batch": O.acceptance_legacy_batch}[kind]
            return q.select(f"SELECT {O.STATIC}, tipo_seguimiento, fecha_asignacion_aceptada FROM {fn(q, cls, h)}")
        return b

    def latest_state_q(level):
        def b(q):
            return q.select(f"SELECT {O.LEVELS[level]['cols']} FROM {O.latest_state(q, hist(q, level), level)}")
        return b

    def parent_last(rules):
        def b(q):
            t = O.first_last(q, hist(q, "parent"), ["cliente", "folio_padre"], "estado_padre",
                             rules == "incremental", False, O.P_LAST)
            return q.select(f"SELECT * FROM {t}")
        return b

    def child_fl(rules):
        def b(q):
            t = O.first_last(q, hist(q, "child"), ["cliente", "folio_padre", "folio_hijo"], "estado_hijo",
                             rules == "incremental", True, O.C_FL)
            return q.select(f"SELECT * FROM {t}")
        return b

    def pdim(q):
        return O.parent_dim(q, "case_log", hist(q, "parent"), "batch")

    def cdim(q):
        return O.child_dim(q, "case_log", hist(q, "child"), pdim(q), "batch")

    def pdim_incr(q):
        return O.parent_dim(q, "case_log", hist(q, "parent"), "incremental")

    def cdim_incr(q):
        return O.child_dim(q, "case_log", hist(q, "child"), pdim_incr(q), "incremental")

    def childless(q):
        return q.add("case_log_childless", """SELECT * REPLACE (CASE WHEN day(fecha_registro) % 3 = 0 THEN '' ELSE folio_hijo END AS folio_hijo)
                                             FROM case_log""")

    def childless_changes(level):
        def b(q):
            t = O.incremental_history(q, level, childless(q))
            return q.select(f"SELECT {O.LEVELS[level]['cols']} FROM {t} WHERE fecha_registro >= {O.DAY1}")
        return b

    def childless_day(q):
        src = childless(q)
        seed, later = O.seed_and_later(q, src)
        st = O.latest_state(q, O.history_table(q, seed, "child", O.SEED_DATE), "child")
        day2 = q.add("second_day", f"SELECT * FROM {later} WHERE fecha_registro = {O.DAY1} + INTERVAL 1 DAY")
        return q.select(f"SELECT {O.C_COLS} FROM {O.suppressed_incr(q, st, day2, 'child')}")

    def tenant_hist(level):
        def b(q):
            t = O.incremental_history(q, level, "case_log_staggered", per_tenant=True)
            return q.select(f"SELECT {O.LEVELS[level]['cols']} FROM {t}")
        return b

    def incr_hist(level):
        def b(q):
            t = O.incremental_history(q, level)
            return q.select(f"SELECT {O.LEVELS[level]['cols']} FROM {t}")
        return b

    all_cols = ("cliente, folio_padre, folio_hijo, fecha_registro, estado_padre, estado_hijo, ppa_grd, monto_total, "
                "fecha_asignacion, rut_paciente, nombre_paciente, intervencion_sanitaria, url_ficha, load_seq")
    builders = {
        "case_log": lambda q: q.select(f"SELECT {all_cols} FROM case_log"),
        "incremental_scan": lambda q: q.select(f"SELECT {all_cols} FROM case_log WHERE fecha_registro > {O.SEED}"),
        "high_water_mark": lambda q: q.select(f"""
SELECT max(fecha_registro) AS mark, (SELECT max(fecha_registro) FROM {O.incremental_history(q, 'parent')}) AS history_mark,
       count(*) AS n_rows FROM case_log"""),
        "tenant_marks": lambda q: q.select("SELECT cliente, max(fecha_registro) AS mark, count(*) AS n_rows FROM case_log_staggered GROUP BY cliente"),
        "latest_snapshot_global": lambda q: q.select(
            f"SELECT {all_cols} FROM case_log WHERE fecha_registro = (SELECT max(fecha_registro) FROM case_log)"),
        "tenant_latest_snapshot": lambda q: q.select(f"""
SELECT {', '.join('c.' + c.strip() for c in all_cols.split(','))} FROM case_log_staggered c
JOIN (SELECT cliente, max(fecha_registro) AS m FROM case_log_staggered GROUP BY cliente) t
  ON c.cliente = t.cliente AND c.fecha_registro = t.m"""),
        "parent_history": lambda q: q.select(f"SELECT {O.P_COLS} FROM {O.compress(q, 'case_log', 'parent')}"),
        "child_history": lambda q: q.select(f"SELECT {O.C_COLS} FROM {O.compress(q, 'case_log', 'child')}"),
        "suppressed_batch_parent": lambda q: q.select(
            f"SELECT {O.P_COLS} FROM {O.suppressed_batch(q, 'case_log', 'parent', O.AS_OF)}"),
        "suppressed_batch_child": lambda q: q.select(
            f"SELECT {O.C_COLS} FROM {O.suppressed_batch(q, 'case_log', 'child', O.AS_OF)}"),
        "suppressed_batch_child_literal": lambda q: q.select(
            f"SELECT {O.C_COLS} FROM {O.suppressed_batch(q, 'case_log', 'child', O.AS_OF, literal=True)}"),
        "parent_history_table": lambda q: q.select(f"SELECT {O.P_COLS} FROM {hist(q, 'parent')}"),
        "child_history_table": lambda q: q.select(f"SELECT {O.C_COLS} FROM {hist(q, 'child')}"),
        "latest_state_parent": latest_state_q("parent"),
        "latest_state_child": latest_state_q("child"),
        "changes_vs_state_parent": changes("parent"),
        "changes_vs_state_child": changes("child"),
        "suppressed_incr_parent": supp_incr("parent"),
        "suppressed_incr_child": supp_incr("child"),
        "suppressed_incr_staggered_global": supp_staggered("global"),
        "suppressed_incr_staggered_tenant": supp_staggered("tenant"),
        "tenant_start": lambda q: q.select(f"SELECT * FROM {O.tenant_start(q, 'case_log')}"),
        "followup_class": lambda q: q.select(f"SELECT {O.STATIC}, tipo_seguimiento FROM {classified(q)}"),
        "acceptance_current": acceptance("current"),
        "acceptance_legacy_incr": acceptance("legacy_incr"),
        "acceptance_legacy_batch": acceptance("legacy_batch"),
        "parent_static_batch": lambda q: q.select(f"SELECT * FROM {O.parent_static(q, 'case_log', 'batch')}"),
        "parent_static_incr": lambda q: q.select(f"SELECT * FROM {O.parent_static(q, 'case_log', 'incremental')}"),
        "latest_details": lambda q: q.select(f"SELECT * FROM {O.latest_details(q)}"),
        "detail_enrichment": lambda q: q.select(f"""
SELECT s.*, d.fecha_atencion, d.intervencion_sanitaria_ingreso, d.problema_salud
FROM {O.parent_static(q, 'case_log', 'batch')} s LEFT JOIN {O.latest_details(q)} d
  ON s.url_ficha IS NOT DISTINCT FROM d.url_ficha"""),
        "parent_latest_state": parent_last("batch"),
        "parent_latest_state_incr": parent_last("incremental"),
        "child_base_batch": lambda q: q.select(f"SELECT * FROM {O.child_base(q, 'case_log', 'batch')}"),
        "child_base_incr": lambda q: q.select(f"SELECT * FROM {O.child_base(q, 'case_log', 'incremental')}"),
        "benefit_enrichment": lambda q: q.select(
            f"SELECT * FROM {O.benefit_enrichment(q, O.child_base(q, 'case_log', 'batch'))}"),
        "code_extraction": lambda q: q.select(f"""
SELECT cliente, folio_padre, folio_hijo, ppa_grd, descripcion, {O.grd_expr()} AS grd
FROM {O.benefit_enrichment(q, O.child_base(q, 'case_log', 'batch'))}"""),
        "child_followup": lambda q: q.select(f"""
SELECT b.*, p.tipo_seguimiento FROM {O.child_base(q, 'case_log', 'batch')} b
LEFT JOIN {pdim(q)} p ON {O.nse('b', 'p', ['cliente', 'folio_padre'])}"""),
        "child_first_last_state": child_fl("batch"),
        "child_first_last_state_incr": child_fl("incremental"),
        "affected_keys": lambda q: q.select(f"SELECT * FROM {O.affected(q, 'parent')}"),
        "changes_childless_days": childless_changes("child"),
        "changes_childless_days_parent": childless_changes("parent"),
        "suppressed_childless_day": childless_day,
        "parent_dim_full": lambda q: q.select(f"SELECT * FROM {pdim(q)}"),
        "child_dim_full": lambda q: q.select(f"SELECT * FROM {cdim(q)}"),
        "parent_dim_incr_rules": lambda q: q.select(f"SELECT * FROM {pdim_incr(q)}"),
        "child_dim_incr_rules": lambda q: q.select(f"SELECT * FROM {cdim_incr(q)}"),
        "parent_dim_upsert": lambda q: q.select(f"SELECT * FROM {O.upserted_dim(q, 'parent')}"),
        "child_dim_upsert": lambda q: q.select(f"SELECT * FROM {O.upserted_dim(q, 'child')}"),
        "parent_dim_stream": lambda q: q.select(f"SELECT * FROM {O.upserted_dim(q, 'parent')}"),
        "child_dim_stream": lambda q: q.select(f"SELECT * FROM {O.upserted_dim(q, 'child')}"),
        "retry_history_parent": incr_hist("parent"),
        "retry_history_child": incr_hist("child"),
        "tenant_run_history_parent": tenant_hist("parent"),
        "tenant_run_history_child": tenant_hist("child"),
        "incremental_run_history_parent": incr_hist("parent"),
        "incremental_run_history_child": incr_hist("child"),
        "stream_history_parent": incr_hist("parent"),
        "stream_history_child": incr_hist("child"),
        "assembled_history_parent": incr_hist("parent"),
        "assembled_history_child": incr_hist("child"),
        "stream_late_rows": lambda q: q.select(f"SELECT {all_cols} FROM case_log WHERE day(fecha_registro) % 7 = 3"),
        "keyed_history_parent": lambda q: q.select(f"SELECT {O.P_COLS} FROM {O.compress(q, 'case_log', 'parent')}"),
        "keyed_history_child": lambda q: q.select(f"SELECT {O.C_COLS} FROM {O.compress(q, 'case_log', 'child')}"),
    }
    return {name: _sql(b) for name, b in builders.items()}
