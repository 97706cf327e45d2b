"""DuckDB oracle SQL for the registered queries.

Each query is built from named CTE fragments over the driver's tables
(``events``, ``orders``), mirroring the fixture derivation of FIXTURES.md.
NULL rules are written out explicitly: ``coalesce(a <> b, true)`` for N1,
``IS NOT DISTINCT FROM`` joins for N5, ``NULLS FIRST`` for N6.
"""

from __future__ import annotations

from tidemark import schemas as V

SUPP = f"'{V.SUPPRESSED}'"
NOT_ACCEPTED = "(" + ", ".join(f"'{v}'" for v in V.NOT_ACCEPTED) + ")"
STATIC = "cliente, folio_padre, fecha_asignacion, rut_paciente, nombre_paciente, intervencion_sanitaria, url_ficha"
BASE = "cliente, folio_padre, folio_hijo, intervencion_sanitaria, ppa_grd, monto_total, url_ficha"
P_COLS = "cliente, folio_padre, fecha_registro, estado_padre"
C_COLS = "cliente, folio_padre, folio_hijo, ppa_grd, fecha_registro, estado_padre, estado_hijo"
P_DIM = (STATIC + ", tipo_seguimiento, fecha_asignacion_aceptada, fecha_atencion, intervencion_sanitaria_ingreso, "
         "problema_salud, ultimo_estado_folio_padre, fecha_ultimo_estado_folio_padre")
C_DIM = (BASE + ", descripcion, estado_prestacion, tipo_seguimiento, ultimo_estado_folio_hijo, "
         "fecha_ultimo_estado_folio_hijo, primer_estado_folio_hijo, fecha_primer_estado_folio_hijo, grd")
NEWEST = "fecha_registro DESC NULLS FIRST, load_seq DESC NULLS FIRST"
ASC = "fecha_registro ASC NULLS LAST, load_seq ASC NULLS FIRST"

SEED = "TIMESTAMP '2024-01-20 00:00:00'"
SEED_DATE = "DATE '2024-01-20'"
AS_OF = "DATE '2024-01-30'"
DAY1 = "TIMESTAMP '2024-01-21 00:00:00'"


class Sql:
    """An ordered list of CTEs plus a final SELECT."""

    def __init__(self):
        self.ctes: list[tuple[str, str]] = []
        self._n = 0

    def add(self, name: str, body: str) -> str:
        if any(n == name for n, _ in self.ctes):
            return name
        self.ctes.append((name, body))
        return name

    def tmp(self, body: str) -> str:
        self._n += 1
        return self.add(f"t{self._n}", body)

    def select(self, body: str) -> str:
        return "WITH " + ",\n".join(f"{n} AS (\n{b}\n)" for n, b in self.ctes) + "\n" + body


def nse(a: str, b: str, cols) -> str:
    return " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in cols)


# ------------------------------------------------------------------ fixtures

def fixtures(q: Sql) -> None:
    q.add("ev_ranked", """
SELECT event_id, ts, user_id, event_type, value, CAST(ts AS DATE) AS d, event_id % 3 AS slot,
       first_value(event_type) OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS pst,
       row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE), event_id % 3 ORDER BY ts DESC, event_id DESC) AS rn
FROM events""")
    q.add("case_log", """
SELECT CAST(user_id % 5 AS VARCHAR) AS cliente,
       'P' || CAST(user_id AS VARCHAR) AS folio_padre,
       CASE WHEN slot = 0 THEN '' ELSE 'H' || CAST(user_id AS VARCHAR) || '-' || CAST(slot AS VARCHAR) END AS folio_hijo,
       CAST(d AS TIMESTAMP) AS fecha_registro,
       CASE pst WHEN 'signup' THEN 'Asignado' WHEN 'error' THEN 'No acepta tratamiento' ELSE pst END AS estado_padre,
       CASE WHEN event_id % 97 = 0 THEN NULL ELSE event_type END AS estado_hijo,
       CASE WHEN user_id % 2 = 0 THEN 'GRD' ELSE 'PPA' END AS ppa_grd,
       value AS monto_total,
       CASE WHEN user_id % 11 = 0 THEN NULL
            ELSE TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(user_id % 3 - 1 AS INTEGER)) END AS fecha_asignacion,
       'R' || CAST(user_id AS VARCHAR) AS rut_paciente,
       'N' || CAST(user_id AS VARCHAR) AS nombre_paciente,
       'I' || CAST(user_id % 7 AS VARCHAR) AS intervencion_sanitaria,
       'u/' || CAST(user_id AS VARCHAR) || CASE WHEN user_id % 10 = 0 THEN '/codificado' ELSE '' END AS url_ficha,
       event_id AS load_seq
FROM ev_ranked WHERE rn = 1""")
    q.add("case_log_staggered", """
SELECT * REPLACE (fecha_registro + to_minutes(CAST(cliente AS BIGINT) * 10) AS fecha_registro) FROM case_log""")
    q.add("case_details", """
SELECT 'u/' || CAST(o_custkey AS VARCHAR) AS url_ficha, CAST(o_orderdate AS TIMESTAMP) AS fecha_atencion,
       o_orderstatus AS intervencion_sanitaria_ingreso, o_orderpriority AS problema_salud, o_orderkey AS load_seq
FROM orders""")
    q.add("benefits", """
SELECT CAST(o_custkey % 5 AS VARCHAR) AS cliente,
       'H' || CAST(o_custkey AS VARCHAR) || '-' || CAST(1 + o_orderkey % 2 AS VARCHAR) AS folio,
       CASE WHEN o_orderkey % 7 = 0 THEN 'sin codigo'
            ELSE o_orderpriority || ': ' || CAST(o_orderkey * 100 AS VARCHAR) END AS descripcion,
       o_orderstatus AS estado, o_orderkey AS load_seq
FROM orders""")


def base_query() -> Sql:
    q = Sql()
    fixtures(q)
    return q


# ------------------------------------------------------------------- history

LEVELS = {
    "parent": dict(keys=["cliente", "folio_padre"], state="estado_padre", cols=P_COLS, blank=None),
    "child": dict(keys=["cliente", "folio_hijo"], state="estado_hijo", cols=C_COLS, blank="folio_hijo"),
}


def level_rows(q: Sql, src: str, level: str) -> str:
    lv = LEVELS[level]
    where = f"WHERE {lv['blank']} IS NOT NULL AND {lv['blank']} <> ''" if lv["blank"] else ""
    return q.add(f"{src}_{level}_rows", f"SELECT {lv['cols']}, load_seq FROM {src} {where}")


def null_key(keys) -> str:
    return " OR ".join(f"{k} IS NULL" for k in keys)


def compress(q: Sql, src: str, level: str) -> str:
    lv = LEVELS[level]
    rows = level_rows(q, src, level)
    k = ", ".join(lv["keys"])
    return q.add(f"{src}_{level}_changes", f"""
SELECT {lv['cols']}, load_seq FROM (
  SELECT *, lag({lv['state']}) OVER (PARTITION BY {k} ORDER BY {ASC}) AS prev_s FROM {rows})
WHERE {null_key(lv['keys'])} OR coalesce({lv['state']} <> prev_s, true)""")


def suppressed_batch(q: Sql, src: str, level: str, as_of: str, literal: bool = False) -> str:
    if level == "parent":
        return q.add(f"{src}_p_supp_batch", f"""
SELECT cliente, folio_padre, max(fecha_registro) AS fecha_registro, {SUPP} AS estado_padre, CAST(NULL AS BIGINT) AS load_seq
FROM {src} WHERE cliente IS NOT NULL AND folio_padre IS NOT NULL GROUP BY cliente, folio_padre
HAVING coalesce(CAST(max(fecha_registro) AS DATE) <> {as_of}, true)""")
    tail = (f"CAST(NULL AS VARCHAR) AS ppa_grd, fecha_registro, CAST(NULL AS VARCHAR) AS estado_padre, "
            f"{SUPP} AS estado_hijo, CAST(NULL AS BIGINT) AS load_seq")
    if literal:
        g = q.add(f"{src}_c_lit_groups", f"""
SELECT cliente, folio_padre, folio_hijo, max(fecha_registro) AS fecha_registro FROM {src}
WHERE cliente IS NOT NULL AND folio_padre IS NOT NULL AND folio_hijo IS NOT NULL
GROUP BY cliente, folio_padre, folio_hijo HAVING coalesce(CAST(max(fecha_registro) AS DATE) <> {as_of}, true)""")
        return q.add(f"{src}_c_supp_batch_lit", f"""
SELECT cliente, folio_padre, folio_hijo, {tail} FROM (
  SELECT *, row_number() OVER (PARTITION BY cliente, folio_hijo ORDER BY folio_padre, fecha_registro) AS rn FROM {g})
WHERE rn = 1""")
    return q.add(f"{src}_c_supp_batch", f"""
SELECT cliente, folio_padre, folio_hijo, {tail} FROM (
  SELECT cliente, folio_hijo, folio_padre,
         max(fecha_registro) OVER (PARTITION BY cliente, folio_hijo) AS fecha_registro,
         row_number() OVER (PARTITION BY cliente, folio_hijo
                            ORDER BY fecha_registro DESC NULLS LAST, load_seq DESC NULLS LAST) AS rn
  FROM {src} WHERE cliente IS NOT NULL AND folio_hijo IS NOT NULL AND folio_hijo <> '')
WHERE rn = 1 AND coalesce(CAST(fecha_registro AS DATE) <> {as_of}, true)""")


def history_table(q: Sql, src: str, level: str, as_of: str, literal: bool = False) -> str:
    ch = compress(q, src, level)
    sp = suppressed_batch(q, src, level, as_of, literal)
    return q.add(f"{src}_{level}_history", f"SELECT * FROM {ch} UNION ALL SELECT * FROM {sp}")


def latest_state(q: Sql, hist: str, level: str) -> str:
    k = ", ".join(LEVELS[level]["keys"])
    return q.add(f"{hist}_latest", f"""
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY {NEWEST}) AS rn FROM {hist})
WHERE rn = 1""")


def changes_vs_state(q: Sql, state: str, new_src: str, level: str) -> str:
    lv = LEVELS[level]
    rows = level_rows(q, new_src, level)
    k = ", ".join(lv["keys"])
    u = q.add(f"{state}_{new_src}_u", f"""
SELECT {lv['cols']}, load_seq, false AS is_new FROM {state}
UNION ALL SELECT {lv['cols']}, load_seq, true AS is_new FROM {rows}""")
    return q.add(f"{state}_{new_src}_changes", f"""
SELECT {lv['cols']}, load_seq FROM (
  SELECT *, lag({lv['state']}) OVER (PARTITION BY {k} ORDER BY fecha_registro ASC NULLS LAST, is_new,
                                     load_seq ASC NULLS FIRST) AS prev_s FROM {u})
WHERE is_new AND ({null_key(lv['keys'])} OR coalesce({lv['state']} <> prev_s, true))""")


def suppressed_incr(q: Sql, state: str, batch: str, level: str, scope: str = "global") -> str:
    lv = LEVELS[level]
    keys = lv["keys"]
    snap_rows = level_rows(q, batch, level)
    ctx = "folio_padre, ppa_grd, estado_padre" if level == "child" else None
    if scope == "global":
        snap = q.add(f"{batch}_snapshot", f"SELECT * FROM {batch} WHERE fecha_registro = (SELECT max(fecha_registro) FROM {batch})")
        snap_lv = q.add(f"{snap}_{level}_keys", f"SELECT * FROM {snap_rows} WHERE fecha_registro = (SELECT max(fecha_registro) FROM {batch})")
        ts = f"(SELECT max(fecha_registro) FROM {batch})"
        join = ""
    else:
        pt = q.add(f"{batch}_tenant_snap", f"SELECT cliente, max(fecha_registro) AS snap FROM {batch} GROUP BY cliente")
        snap_lv = q.add(f"{batch}_{level}_tsnap", f"""
SELECT r.* FROM {snap_rows} r JOIN {pt} p ON r.cliente = p.cliente AND r.fecha_registro = p.snap""")
        ts = "p.snap"
        join = f"JOIN {pt} p ON s.cliente IS NOT DISTINCT FROM p.cliente"
    if level == "parent":
        sel = f"s.cliente, s.folio_padre, {ts} AS fecha_registro, {SUPP} AS estado_padre"
    else:
        sel = (f"s.cliente, s.folio_padre, s.folio_hijo, s.ppa_grd, {ts} AS fecha_registro, s.estado_padre, "
               f"{SUPP} AS estado_hijo")
    return q.add(f"{state}_{batch}_{scope}_supp", f"""
SELECT {sel}, CAST(NULL AS BIGINT) AS load_seq FROM {state} s {join}
WHERE coalesce(s.{lv['state']} <> {SUPP}, true)
  AND NOT EXISTS (SELECT 1 FROM {snap_lv} x WHERE {nse('x', 's', keys)})
  AND {ts} IS NOT NULL""")


# ---------------------------------------------------------------- dimensions

def tenant_start(q: Sql, src: str) -> str:
    return q.add(f"{src}_starts", f"""
SELECT cliente, min(fecha_registro) AS fecha_primer_registro FROM {src} WHERE cliente IS NOT NULL GROUP BY cliente""")


def parent_static(q: Sql, src: str, rules: str) -> str:
    coded = "coalesce(NOT contains(url_ficha, 'codificado'), true)"
    if rules == "batch":
        return q.add(f"{src}_static_batch", f"""
SELECT {STATIC} FROM (SELECT *, row_number() OVER (PARTITION BY cliente, folio_padre ORDER BY load_seq ASC NULLS LAST) AS rn
                      FROM {src} WHERE {coded}) WHERE rn = 1""")
    return q.add(f"{src}_static_incr", f"""
SELECT {STATIC} FROM (SELECT *, row_number() OVER (PARTITION BY cliente, folio_padre ORDER BY {NEWEST}) AS rn FROM {src})
WHERE rn = 1 AND {coded}""")


def followup(q: Sql, static: str, starts: str) -> str:
    return q.add(f"{static}_class", f"""
SELECT * FROM (
  SELECT st.*, CASE WHEN st.fecha_asignacion >= s.fecha_primer_registro THEN 'current'
                    WHEN st.fecha_asignacion < s.fecha_primer_registro THEN 'legacy' END AS tipo_seguimiento
  FROM {static} st LEFT JOIN {starts} s ON st.cliente = s.cliente)
WHERE tipo_seguimiento IS NOT NULL""")


def acceptance_current(q: Sql, cls: str, hist: str) -> str:
    acc = q.add(f"{hist}_acc_cur", f"""
SELECT cliente, folio_padre, min(fecha_registro) AS fecha_asignacion_aceptada FROM {hist}
WHERE cliente IS NOT NULL AND folio_padre IS NOT NULL AND coalesce(estado_padre NOT IN {NOT_ACCEPTED}, true)
GROUP BY cliente, folio_padre""")
    return q.add(f"{cls}_{hist}_current", f"""
SELECT c.*, a.fecha_asignacion_aceptada FROM (SELECT * FROM {cls} WHERE tipo_seguimiento = 'current') c
LEFT JOIN {acc} a ON {nse('c', 'a', ['cliente', 'folio_padre'])}""")


def legacy_rows(q: Sql, cls: str, hist: str) -> tuple[str, str]:
    lg = q.add(f"{cls}_legacy", f"SELECT * FROM {cls} WHERE tipo_seguimiento = 'legacy'")
    hl = q.add(f"{cls}_{hist}_hl", f"""
SELECT h.* FROM {hist} h WHERE EXISTS (SELECT 1 FROM {lg} l WHERE {nse('l', 'h', ['cliente', 'folio_padre'])})""")
    return lg, hl


def acceptance_legacy_incr(q: Sql, cls: str, hist: str) -> str:
    lg, hl = legacy_rows(q, cls, hist)
    fo = q.add(f"{hl}_fo", f"""
SELECT cliente, folio_padre,
       min(CASE WHEN coalesce(estado_padre <> 'Asignado', true) THEN fecha_registro END) AS first_other,
       bool_or(coalesce(estado_padre = 'Asignado', false)) AS assigned
FROM {hl} WHERE cliente IS NOT NULL AND folio_padre IS NOT NULL GROUP BY cliente, folio_padre""")
    return q.add(f"{cls}_{hist}_legacy_incr", f"""
SELECT l.*, CASE WHEN coalesce(f.assigned, false) THEN f.first_other ELSE l.fecha_asignacion END AS fecha_asignacion_aceptada
FROM {lg} l LEFT JOIN {fo} f ON {nse('l', 'f', ['cliente', 'folio_padre'])}""")


def acceptance_legacy_batch(q: Sql, cls: str, hist: str) -> str:
    lg, hl = legacy_rows(q, cls, hist)
    ident = q.add(f"{hl}_ident", f"""
SELECT DISTINCT cliente, folio_padre FROM {hl} WHERE coalesce(estado_padre = 'Asignado', false)""")
    hi = q.add(f"{hl}_hi", f"""
SELECT h.* FROM {hl} h WHERE EXISTS (SELECT 1 FROM {ident} i WHERE {nse('i', 'h', ['cliente', 'folio_padre'])})""")
    fm = q.add(f"{hl}_fm", f"""
SELECT cliente, folio_padre, min(fecha_registro) AS gmin FROM {hi}
WHERE cliente IS NOT NULL AND folio_padre IS NOT NULL GROUP BY cliente, folio_padre""")
    hit = q.add(f"{hl}_hit", f"""
SELECT f.* FROM {fm} f WHERE EXISTS (
  SELECT 1 FROM {hi} h WHERE h.cliente = f.cliente AND h.folio_padre = f.folio_padre
     AND h.fecha_registro = f.gmin AND coalesce(h.estado_padre <> 'Asignado', true))""")
    return q.add(f"{cls}_{hist}_legacy_batch", f"""
SELECT l.*, coalesce(h.gmin, l.fecha_asignacion) AS fecha_asignacion_aceptada
FROM {lg} l LEFT JOIN {hit} h ON {nse('l', 'h', ['cliente', 'folio_padre'])}""")


def latest_details(q: Sql, src: str = "case_details") -> str:
    return q.add(f"{src}_latest", f"""
SELECT url_ficha, fecha_atencion, intervencion_sanitaria_ingreso, problema_salud FROM (
  SELECT *, row_number() OVER (PARTITION BY url_ficha ORDER BY load_seq DESC NULLS FIRST) AS rn FROM {src})
WHERE rn = 1""")


def first_last(q: Sql, hist: str, keys, state: str, skip_nulls: bool, first: bool, names: dict) -> str:
    k = ", ".join(keys)
    desc_o = "fecha_registro DESC NULLS FIRST, load_seq IS NULL DESC, load_seq DESC"
    asc_o = "fecha_registro ASC NULLS LAST, load_seq IS NULL, load_seq ASC"
    tag = "nn" if skip_nulls else "row"
    if not skip_nulls:
        parts = [f"max(CASE WHEN rl = 1 THEN {state} END) AS {names['last_state']}",
                 f"max(CASE WHEN rl = 1 THEN fecha_registro END) AS {names['last_ts']}"]
        if first:
            parts += [f"max(CASE WHEN rf = 1 THEN {state} END) AS {names['first_state']}",
                      f"max(CASE WHEN rf = 1 THEN fecha_registro END) AS {names['first_ts']}"]
        return q.add(f"{hist}_fl_{tag}_{int(first)}", f"""
SELECT {k}, {', '.join(parts)} FROM (
  SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY {desc_o}) AS rl,
            row_number() OVER (PARTITION BY {k} ORDER BY {asc_o}) AS rf FROM {hist})
GROUP BY {k}""")
    nn = " AND ".join(f"{c} IS NOT NULL" for c in keys)
    parts = [f"max(CASE WHEN rl = 1 THEN {state} END) AS {names['last_state']}",
             f"max(fecha_registro) AS {names['last_ts']}"]
    if first:
        parts += [f"max(CASE WHEN rf = 1 THEN {state} END) AS {names['first_state']}",
                  f"min(fecha_registro) AS {names['first_ts']}"]
    return q.add(f"{hist}_fl_{tag}_{int(first)}", f"""
SELECT {k}, {', '.join(parts)} FROM (
  SELECT *, CASE WHEN {state} IS NOT NULL THEN row_number() OVER (PARTITION BY {k}, {state} IS NULL ORDER BY {desc_o}) END AS rl,
            CASE WHEN {state} IS NOT NULL THEN row_number() OVER (PARTITION BY {k}, {state} IS NULL ORDER BY {asc_o}) END AS rf
  FROM {hist} WHERE {nn})
GROUP BY {k}""")


P_LAST = {"last_state": "ultimo_estado_folio_padre", "last_ts": "fecha_ultimo_estado_folio_padre"}
C_FL = {"last_state": "ultimo_estado_folio_hijo", "last_ts": "fecha_ultimo_estado_folio_hijo",
        "first_state": "primer_estado_folio_hijo", "first_ts": "fecha_primer_estado_folio_hijo"}


def parent_dim(q: Sql, src: str, hist: str, rules: str, starts_src: str | None = None) -> str:
    st = parent_static(q, src, rules)
    cls = followup(q, st, tenant_start(q, starts_src or src))
    cur = acceptance_current(q, cls, hist)
    leg = (acceptance_legacy_batch if rules == "batch" else acceptance_legacy_incr)(q, cls, hist)
    det = latest_details(q)
    last = first_last(q, hist, ["cliente", "folio_padre"], "estado_padre", rules == "incremental", False, P_LAST)
    return q.add(f"{src}_{hist}_pdim_{rules}", f"""
SELECT {', '.join('d.' + c.strip() for c in STATIC.split(','))}, d.tipo_seguimiento, d.fecha_asignacion_aceptada,
       x.fecha_atencion, x.intervencion_sanitaria_ingreso, x.problema_salud,
       l.ultimo_estado_folio_padre, l.fecha_ultimo_estado_folio_padre
FROM (SELECT * FROM {cur} UNION ALL BY NAME SELECT * FROM {leg}) d
LEFT JOIN {det} x ON d.url_ficha IS NOT DISTINCT FROM x.url_ficha
LEFT JOIN {last} l ON {nse('d', 'l', ['cliente', 'folio_padre'])}""")


def child_base(q: Sql, src: str, rules: str) -> str:
    order = "load_seq DESC NULLS FIRST" if rules == "batch" else NEWEST
    return q.add(f"{src}_cbase_{rules}", f"""
SELECT {BASE} FROM (
  SELECT *, row_number() OVER (PARTITION BY cliente, folio_padre, folio_hijo ORDER BY {order}) AS rn FROM {src})
WHERE rn = 1 AND folio_hijo IS NOT NULL AND folio_hijo <> ''""")


def latest_benefits(q: Sql, src: str = "benefits") -> str:
    return q.add(f"{src}_latest", f"""
SELECT cliente, folio, descripcion, estado AS estado_prestacion FROM (
  SELECT *, row_number() OVER (PARTITION BY cliente, folio ORDER BY load_seq DESC NULLS FIRST) AS rn FROM {src})
WHERE rn = 1""")


def benefit_enrichment(q: Sql, base: str) -> str:
    lb = latest_benefits(q)
    return q.add(f"{base}_ben", f"""
SELECT b.*, l.descripcion, l.estado_prestacion FROM {base} b
LEFT JOIN {lb} l ON b.cliente IS NOT DISTINCT FROM l.cliente AND b.folio_hijo IS NOT DISTINCT FROM l.folio""")


def grd_expr(descr: str = "descripcion", cls: str = "ppa_grd") -> str:
    ws = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    p = f"trim(CASE WHEN strpos({descr}, ':') > 0 THEN split_part({descr}, ':', 2) END, {ws})"
    return (f"CASE WHEN {cls} = 'GRD' THEN (CASE WHEN length({p}) >= 6 THEN {p} "
            f"WHEN left({p}, 1) IN ('-', '+') THEN left({p}, 1) || lpad(substr({p}, 2), 5, '0') "
            f"ELSE lpad({p}, 6, '0') END) END")


def child_dim(q: Sql, src: str, hist: str, pdim: str, rules: str) -> str:
    base = benefit_enrichment(q, child_base(q, src, rules))
    fl = first_last(q, hist, ["cliente", "folio_padre", "folio_hijo"], "estado_hijo", rules == "incremental",
                    True, C_FL)
    return q.add(f"{src}_{hist}_cdim_{rules}", f"""
SELECT {', '.join('b.' + c.strip() for c in BASE.split(','))}, b.descripcion, b.estado_prestacion, p.tipo_seguimiento,
       f.ultimo_estado_folio_hijo, f.fecha_ultimo_estado_folio_hijo, f.primer_estado_folio_hijo,
       f.fecha_primer_estado_folio_hijo, {grd_expr('b.descripcion', 'b.ppa_grd')} AS grd
FROM {base} b
LEFT JOIN {pdim} p ON {nse('b', 'p', ['cliente', 'folio_padre'])}
LEFT JOIN {fl} f ON {nse('b', 'f', ['cliente', 'folio_padre', 'folio_hijo'])}""")


# ------------------------------------------------------ incremental (closed form)

def seed_and_later(q: Sql, src: str = "case_log") -> tuple[str, str]:
    seed = q.add(f"{src}_seed", f"SELECT * FROM {src} WHERE fecha_registro < {DAY1}")
    later = q.add(f"{src}_later", f"SELECT * FROM {src} WHERE fecha_registro >= {DAY1}")
    return seed, later


def incremental_history(q: Sql, level: str, src: str = "case_log", per_tenant: bool = False) -> str:
    """History (with load_seq) after the seed rebuild and one run per later snapshot, in closed form.

    Per key, the raw rows are interleaved with a marker at the seed's
    last-seen time (when that day is not the seed day) and a marker at each
    later snapshot the key misses after its first appearance; run-length
    compression of that sequence is the history the runs append.  A child
    marker of a run carries the parent context of the newest emitted row.
    Snapshots are those with rows of the level; ``per_tenant``: each tenant's own.
    """
    lv = LEVELS[level]
    keys = lv["keys"]
    k = ", ".join(keys)
    seed, later = seed_and_later(q, src)
    rows = level_rows(q, src, level)
    own = "cliente, " if per_tenant else ""
    snaps = q.add(f"{level}_later_snaps", f"SELECT DISTINCT {own}fecha_registro AS t FROM {level_rows(q, later, level)}")
    same = "AND s.cliente IS NOT DISTINCT FROM x.cliente" if per_tenant else ""
    first_seen = q.add(f"{level}_first_seen", f"SELECT {k}, min(fecha_registro) AS f FROM {rows} GROUP BY {k}")
    seed_m = suppressed_batch(q, seed, level, SEED_DATE)
    if level == "parent":
        marker_cols = f"x.cliente, x.folio_padre, s.t AS fecha_registro, {SUPP} AS estado_padre"
    else:
        marker_cols = (f"x.cliente, CAST(NULL AS VARCHAR) AS folio_padre, x.folio_hijo, CAST(NULL AS VARCHAR) AS ppa_grd, "
                       f"s.t AS fecha_registro, CAST(NULL AS VARCHAR) AS estado_padre, {SUPP} AS estado_hijo")
    run_m = q.add(f"{level}_run_markers", f"""
SELECT {marker_cols}, CAST(NULL AS BIGINT) AS load_seq, 1 AS run_marker
FROM {snaps} s JOIN {first_seen} x ON x.f < s.t {same}
WHERE NOT EXISTS (SELECT 1 FROM {rows} r WHERE r.fecha_registro = s.t AND {nse('r', 'x', keys)})""")
    v = q.add(f"{level}_virtual", f"""
SELECT *, 0 AS run_marker FROM {rows}
UNION ALL SELECT *, 0 AS run_marker FROM {seed_m}
UNION ALL SELECT * FROM {run_m}""")
    order = "fecha_registro ASC NULLS LAST, load_seq IS NULL, load_seq ASC"
    flagged = q.add(f"{level}_virtual_flags", f"""
SELECT *, ({null_key(keys)} OR coalesce({lv['state']} <> lag({lv['state']}) OVER (PARTITION BY {k} ORDER BY {order}), true))
          AS changed,
       row_number() OVER (PARTITION BY {k} ORDER BY {order}) AS pos
FROM {v}""")
    if level == "parent":
        return q.add(f"{level}_incr_history", f"SELECT {P_COLS}, load_seq FROM {flagged} WHERE changed")
    ctx = q.add(f"{level}_virtual_ctx", f"""
SELECT *,
  last_value(CASE WHEN changed THEN folio_padre END IGNORE NULLS) OVER w AS c_fp,
  last_value(CASE WHEN changed THEN coalesce(ppa_grd, '\x01') END IGNORE NULLS) OVER w AS c_pg,
  last_value(CASE WHEN changed THEN coalesce(estado_padre, '\x01') END IGNORE NULLS) OVER w AS c_ep
FROM {flagged}
WINDOW w AS (PARTITION BY {k} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
    return q.add(f"{level}_incr_history", f"""
SELECT cliente,
       CASE WHEN run_marker = 1 THEN c_fp ELSE folio_padre END AS folio_padre, folio_hijo,
       CASE WHEN run_marker = 1 THEN nullif(c_pg, '\x01') ELSE ppa_grd END AS ppa_grd,
       fecha_registro,
       CASE WHEN run_marker = 1 THEN nullif(c_ep, '\x01') ELSE estado_padre END AS estado_padre,
       estado_hijo, load_seq
FROM {ctx} WHERE changed""")


def affected(q: Sql, level: str) -> str:
    """Keys that the runs after the seed touch: seen later, or given a marker."""
    keys = ", ".join(LEVELS[level]["keys"])
    _, later = seed_and_later(q)
    return q.add(f"{level}_affected", f"""
SELECT {keys} FROM {level_rows(q, later, level)}
UNION SELECT {keys} FROM {incremental_history(q, level)} WHERE {LEVELS[level]['state']} = {SUPP} AND fecha_registro >= {DAY1}""")


def upserted_dim(q: Sql, level: str) -> str:
    """A dimension after all runs: seed rows (batch rules) of untouched keys, and the touched
    keys' rows by the incremental rules over the whole log and the runs' history."""
    def of(src, name, aff, keys):
        return q.add(name, f"SELECT u.* FROM {src} u WHERE EXISTS (SELECT 1 FROM {aff} a WHERE {nse('a', 'u', keys)})")

    def put(old, new, name, aff, keys):
        return q.add(name, f"SELECT * FROM {old} d WHERE NOT EXISTS (SELECT 1 FROM {aff} a WHERE {nse('a', 'd', keys)}) UNION ALL SELECT * FROM {new}")

    seed, _ = seed_and_later(q)
    pk, ck = ["cliente", "folio_padre"], ["cliente", "folio_hijo"]
    aff = affected(q, "parent")
    pd0 = parent_dim(q, seed, history_table(q, seed, "parent", SEED_DATE), "batch")
    new = parent_dim(q, of("case_log", "log_of_parents", aff, pk), of(incremental_history(q, "parent"), "history_of_parents", aff, pk),
                     "incremental", starts_src="case_log")
    pd1 = put(pd0, new, "parents_after_runs", aff, pk)
    if level == "parent":
        return pd1
    aff = affected(q, "child")
    cd0 = child_dim(q, seed, history_table(q, seed, "child", SEED_DATE), pd0, "batch")
    new = child_dim(q, of("case_log", "log_of_children", aff, ck), of(incremental_history(q, "child"), "history_of_children", aff, ck), pd1, "incremental")
    return put(cd0, new, "children_after_runs", aff, ck)
