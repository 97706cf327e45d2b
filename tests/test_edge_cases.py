"""Literal edge rows (FIXTURES.md section 4), one per NULL rule / ledger entry."""

from pyspark.sql import functions as F

from conftest import raw_df, ts
from tidemark.operators import dims as D
from tidemark.operators.history import apply_snapshots, compress_history, detect_changes, suppressed_batch, suppressed_incremental
from tidemark.operators.latest import first_last_state, latest_per_key, latest_snapshot, latest_state
from tidemark.schemas import CHILD, PARENT, SUPPRESSED


def states(df, col="estado_padre"):
    return [r[col] for r in df.orderBy("fecha_registro", "load_seq").collect()]


def test_null_state_after_null_state_is_a_change(spark):  # N1
    raw = raw_df(spark, [dict(fecha_registro=ts(1), estado_padre=None),
                         dict(fecha_registro=ts(2), estado_padre=None)])
    assert compress_history(raw, PARENT).count() == 2


def test_equal_states_compress(spark):
    raw = raw_df(spark, [dict(fecha_registro=ts(d), estado_padre=s)
                         for d, s in [(1, "a"), (2, "a"), (3, "b"), (4, "b"), (5, "a")]])
    assert states(compress_history(raw, PARENT)) == ["a", "b", "a"]


def test_null_key_rows_are_all_changes_and_anti_join_matches_null(spark):  # N3, N5
    raw = raw_df(spark, [dict(cliente=None, fecha_registro=ts(1), estado_padre="a"),
                         dict(cliente=None, fecha_registro=ts(2), estado_padre="a")])
    assert compress_history(raw, PARENT).count() == 2
    hist = compress_history(raw, PARENT)
    snap = raw_df(spark, [dict(cliente=None, fecha_registro=ts(3))])
    assert suppressed_incremental(latest_state(hist, PARENT), snap, PARENT).count() == 0


def test_not_in_keeps_null(spark):  # N2
    hist = raw_df(spark, [dict(fecha_registro=ts(3), estado_padre=None),
                          dict(fecha_registro=ts(2), estado_padre="Asignado")])
    got = D.acceptance_current(hist).collect()
    assert got[0]["fecha_asignacion_aceptada"] == ts(3)


def test_null_timestamp_wins_newest_per_key(spark):  # N6
    raw = raw_df(spark, [dict(fecha_registro=ts(5), estado_padre="a"),
                         dict(fecha_registro=None, estado_padre="b")])
    assert latest_per_key(raw, ["cliente", "folio_padre"]).first()["estado_padre"] == "b"


def test_last_state_skips_null_but_date_is_newest(spark):  # N8
    hist = raw_df(spark, [dict(fecha_registro=ts(1), estado_padre="a"),
                          dict(fecha_registro=ts(2), estado_padre=None)])
    r = D.parent_latest_state(hist, "incremental").first()
    assert (r["ultimo_estado_folio_padre"], r["fecha_ultimo_estado_folio_padre"]) == ("a", ts(2))
    r = D.parent_latest_state(hist, "batch").first()
    assert (r["ultimo_estado_folio_padre"], r["fecha_ultimo_estado_folio_padre"]) == (None, ts(2))


def test_blank_and_null_children_removed(spark):  # N10
    raw = raw_df(spark, [dict(folio_hijo=""), dict(folio_hijo=None), dict(folio_hijo="H9")])
    assert [r["folio_hijo"] for r in compress_history(raw, CHILD).collect()] == ["H9"]


def test_null_assignment_date_drops_parent(spark):  # N9
    raw = raw_df(spark, [dict(folio_padre="P1", fecha_asignacion=None),
                         dict(folio_padre="P2", fecha_asignacion=ts(5))])
    cls = D.followup_class(D.parent_static(raw), D.tenant_start(raw))
    assert [r["folio_padre"] for r in cls.collect()] == ["P2"]


def test_suppressed_marker_counts_as_newest_at_same_time(spark):  # Q7
    raw = raw_df(spark, [dict(fecha_registro=ts(3), estado_padre="a")])
    hist = compress_history(raw, PARENT).unionByName(suppressed_batch(raw, PARENT, "2024-01-30"))
    assert latest_state(hist, PARENT).first()["estado_padre"] == SUPPRESSED


def test_vanish_then_return_with_same_state(spark):  # Q9, T6
    seed = raw_df(spark, [dict(folio_padre="P1", fecha_registro=ts(1), estado_padre="a"),
                          dict(folio_padre="P2", fecha_registro=ts(1), estado_padre="z")])
    hist = compress_history(seed, PARENT)
    batch2 = raw_df(spark, [dict(folio_padre="P2", fecha_registro=ts(2), estado_padre="z")])
    st = latest_state(hist, PARENT)
    markers = suppressed_incremental(st, latest_snapshot(batch2), PARENT)
    assert [r["folio_padre"] for r in markers.collect()] == ["P1"]
    hist = hist.unionByName(markers).unionByName(detect_changes(batch2, st, PARENT))
    batch3 = raw_df(spark, [dict(folio_padre="P1", fecha_registro=ts(3), estado_padre="a"),
                            dict(folio_padre="P2", fecha_registro=ts(3), estado_padre="z")])
    back = detect_changes(batch3, latest_state(hist, PARENT), PARENT)
    assert [(r["folio_padre"], r["estado_padre"]) for r in back.collect()] == [("P1", "a")]
    # The full history of the same rows has no row for the return.
    full = compress_history(seed.unionByName(batch2).unionByName(batch3), PARENT)
    assert full.filter(F.col("folio_padre") == "P1").count() == 1


def test_snapshot_scope(spark):  # Q3
    seed = raw_df(spark, [dict(cliente="1", folio_padre="A", fecha_registro=ts(1)),
                          dict(cliente="2", folio_padre="B", fecha_registro=ts(1))])
    st = latest_state(compress_history(seed, PARENT), PARENT)
    batch = raw_df(spark, [dict(cliente="1", folio_padre="A", fecha_registro=ts(2, 0)),
                           dict(cliente="2", folio_padre="B", fecha_registro=ts(2, 1))])
    glob = suppressed_incremental(st, latest_snapshot(batch, "global"), PARENT, scope="global")
    assert [r["folio_padre"] for r in glob.collect()] == ["A"]
    ten = suppressed_incremental(st, latest_snapshot(batch, "tenant"), PARENT, scope="tenant")
    assert ten.count() == 0


def test_coded_url_order(spark):  # Q4
    raw = raw_df(spark, [dict(fecha_registro=ts(1), url_ficha="u/1"),
                         dict(fecha_registro=ts(2), url_ficha="u/1/codificado")])
    assert D.parent_static(raw, "batch").count() == 1
    assert D.parent_static(raw, "incremental").count() == 0


def test_legacy_rules_differ_on_assigned_only(spark):  # Q5
    legacy = raw_df(spark, [dict(fecha_asignacion=ts(1))]).select(
        "cliente", "folio_padre", "fecha_asignacion")
    hist = raw_df(spark, [dict(fecha_registro=ts(3), estado_padre="Asignado")])
    incr = D.acceptance_legacy_incremental(legacy, hist).first()["fecha_asignacion_aceptada"]
    batch = D.acceptance_legacy_batch(legacy, hist).first()["fecha_asignacion_aceptada"]
    assert incr is None and batch == ts(1)
    hist2 = raw_df(spark, [dict(fecha_registro=ts(3), estado_padre="Asignado"),
                           dict(fecha_registro=ts(4), estado_padre="b")])
    assert D.acceptance_legacy_incremental(legacy, hist2).first()["fecha_asignacion_aceptada"] == ts(4)
    assert D.acceptance_legacy_batch(legacy, hist2).first()["fecha_asignacion_aceptada"] == ts(1)


def test_ties_at_minimum_give_one_row(spark):  # Q6
    hist = raw_df(spark, [dict(fecha_registro=ts(2), estado_padre="b"),
                          dict(fecha_registro=ts(2), estado_padre="c")])
    assert D.acceptance_current(hist).count() == 1


def test_child_under_two_parents(spark):  # Q8
    raw = raw_df(spark, [dict(folio_padre="P1", folio_hijo="H", fecha_registro=ts(1)),
                         dict(folio_padre="P2", folio_hijo="H", fecha_registro=ts(30))])
    assert suppressed_batch(raw, CHILD, "2024-01-30").count() == 0
    lit = suppressed_batch(raw, CHILD, "2024-01-30", literal=True).collect()
    assert [(r["folio_padre"], r["fecha_registro"]) for r in lit] == [("P1", ts(1))]


def test_same_folio_in_two_tenants(spark):  # Q10
    raw = raw_df(spark, [dict(cliente="1", fecha_registro=ts(1), estado_padre="a"),
                         dict(cliente="2", fecha_registro=ts(2), estado_padre="a")])
    assert compress_history(raw, PARENT).count() == 2


def test_replayed_batch_adds_nothing(spark):  # Q1, Q2
    seed = raw_df(spark, [dict(fecha_registro=ts(1), estado_padre="a")])
    batch = raw_df(spark, [dict(fecha_registro=ts(2), estado_padre="b")])
    hist = compress_history(seed, PARENT)
    hist = hist.unionByName(detect_changes(batch, latest_state(hist, PARENT), PARENT))
    assert detect_changes(batch, latest_state(hist, PARENT), PARENT).count() == 0


def test_child_change_without_parent_change(spark):
    seed = raw_df(spark, [dict(fecha_registro=ts(1), estado_padre="a", estado_hijo="x")])
    batch = raw_df(spark, [dict(fecha_registro=ts(2), estado_padre="a", estado_hijo="y")])
    assert detect_changes(batch, latest_state(compress_history(seed, PARENT), PARENT), PARENT).count() == 0
    assert detect_changes(batch, latest_state(compress_history(seed, CHILD), CHILD), CHILD).count() == 1


def test_empty_batch_and_batch_without_children(spark):  # section 7.5
    seed = raw_df(spark, [dict(fecha_registro=ts(1))])
    st = latest_state(compress_history(seed, CHILD), CHILD)
    empty = seed.limit(0)
    assert suppressed_incremental(st, latest_snapshot(empty), CHILD).count() == 0
    assert detect_changes(empty, st, CHILD).count() == 0
    no_children = raw_df(spark, [dict(fecha_registro=ts(2), folio_hijo="")])
    assert detect_changes(no_children, st, CHILD).count() == 0


def test_first_last_whole_rows_vs_non_null(spark):
    hist = raw_df(spark, [dict(fecha_registro=ts(1), estado_hijo=None),
                          dict(fecha_registro=ts(2), estado_hijo="x"),
                          dict(fecha_registro=ts(3), estado_hijo=None)])
    keys = ["cliente", "folio_padre", "folio_hijo"]
    r = first_last_state(hist, keys, "estado_hijo", skip_nulls=True).first()
    assert (r["first_state"], r["first_ts"], r["last_state"], r["last_ts"]) == ("x", ts(1), "x", ts(3))
    r = first_last_state(hist, keys, "estado_hijo", skip_nulls=False).first()
    assert (r["first_state"], r["first_ts"], r["last_state"], r["last_ts"]) == (None, ts(1), None, ts(3))


def plain_changes(rows, key, state, order):
    """Change flags by a loop over sorted rows."""
    out, last = {}, {}
    for r in sorted(rows, key=order):
        k = tuple(r[c] for c in key)
        known = None not in k and k in last
        out[r["load_seq"]] = not known or last[k] is None or r[state] is None or r[state] != last[k]
        if None not in k:
            last[k] = r[state]
    return out


def test_one_key_with_most_rows(spark):
    """Days, several rows a time, NULL states, unknown times and NULL keys in one path."""
    import tidemark.operators.history as H
    raw = raw_df(spark, [dict(fecha_registro=None if i % 17 == 0 else ts(1 + i // 25, (i // 5) % 24), folio_hijo=None if i % 13 == 0 else "H1",
                              estado_hijo=("x", "y", None)[i % 3 if i % 5 else 0]) for i in range(200)])
    changed = {r["load_seq"] for r in H.changed_rows(raw, ["cliente", "folio_hijo"], "estado_hijo").collect()}
    got = {r["load_seq"]: r["load_seq"] in changed for r in raw.collect()}
    order = lambda r: (r["fecha_registro"] is None, r["fecha_registro"] or ts(1), r["load_seq"])
    assert got == plain_changes([r.asDict() for r in raw.collect()], ["cliente", "folio_hijo"], "estado_hijo", order)


def test_string_tie_breaker(spark):
    import tidemark.operators.history as H
    raw = raw_df(spark, [dict(fecha_registro=ts(1 + i // 20), estado_hijo=("x", "y")[(i // 3) % 2]) for i in range(50)])
    texts = raw.withColumn("load_seq", F.lpad(F.col("load_seq").cast("string"), 8, "0"))
    a = [int(r["load_seq"]) for r in H.changed_rows(texts, ["cliente", "folio_hijo"], "estado_hijo").collect()]
    b = [r["load_seq"] for r in H.changed_rows(raw, ["cliente", "folio_hijo"], "estado_hijo").collect()]
    assert sorted(a) == sorted(b) and 0 < len(b) < 50


def test_snapshots_in_one_pass_equal_one_run_each(spark):
    """apply_snapshots against a loop of detect_changes and suppressed_incremental, both levels and scopes."""
    import itertools
    import random
    draw = random.Random(5)
    rows = [dict(cliente=c, folio_padre=f"P{p}", folio_hijo=draw.choice(["", f"H{p}", f"H{p}b"]), fecha_registro=ts(d), estado_padre=draw.choice(["a", "b", None, SUPPRESSED]),
                 estado_hijo=draw.choice(["x", "y", None]))
            for c, p, d in itertools.product(["1", "2", None], [1, 2, None], range(2, 8)) if draw.random() < 0.6]
    rows += [dict(fecha_registro=ts(9), folio_hijo="", folio_padre="P1"), dict(fecha_registro=ts(10), folio_padre="P9", folio_hijo="H9")]
    seed = raw_df(spark, [dict(cliente="1", folio_padre="P1", folio_hijo="H1"), dict(cliente="2", folio_padre="P7", folio_hijo="H7"), dict(cliente="4")])
    batch = raw_df(spark, rows)
    for level, scope in itertools.product((PARENT, CHILD), ("global", "tenant")):
        state = latest_state(compress_history(seed, level), level)
        once = apply_snapshots(batch, state, level, scope)
        history = compress_history(seed, level)
        out = []
        for d in (2, 3, 4, 5, 6, 7, 9, 10):
            now = latest_state(history, level)
            snap = batch.filter(F.dayofmonth("fecha_registro") == d)
            new = detect_changes(snap, now, level).unionByName(suppressed_incremental(now, snap, level, scope)).select(*history.columns)
            found = new.collect()
            out += map(tuple, found)
            history = spark.createDataFrame([*history.collect(), *found], history.schema)
        assert once.columns == history.columns
        assert sorted(map(tuple, once.collect()), key=str) == sorted(out, key=str), (level.name, scope)


def test_snapshot_without_children_suppresses_no_child(spark):  # C7, section 7.5
    seed = raw_df(spark, [dict(fecha_registro=ts(1)), dict(cliente="2", fecha_registro=ts(1))])
    state = latest_state(compress_history(seed, CHILD), CHILD)
    childless = raw_df(spark, [dict(fecha_registro=ts(2), folio_hijo=""), dict(cliente="2", fecha_registro=ts(2), folio_hijo=None)])
    for scope in ("global", "tenant"):
        assert suppressed_incremental(state, childless, CHILD, scope).count() == 0
        assert apply_snapshots(childless, state, CHILD, scope).count() == 0
    half = childless.unionByName(raw_df(spark, [dict(fecha_registro=ts(2), folio_hijo="H5")]))
    assert [r["cliente"] for r in suppressed_incremental(state, half, CHILD, "tenant").collect()] == ["1"]


def test_default_as_of_is_the_session_date(spark):  # X3
    today, before = spark.sql("SELECT CAST(current_date() AS TIMESTAMP_NTZ) AS t, CAST(current_date() - 1 AS TIMESTAMP_NTZ) AS y").first()
    raw = raw_df(spark, [dict(folio_padre="P1", fecha_registro=today), dict(folio_padre="P2", fecha_registro=before)])
    assert [r["folio_padre"] for r in suppressed_batch(raw, PARENT).collect()] == ["P2"]


def test_null_url_is_not_coded(spark):  # F4
    raw = raw_df(spark, [dict(url_ficha=None)])
    assert D.parent_static(raw, "batch").count() == 1
    assert D.parent_static(raw, "incremental").count() == 1


def test_tenant_start_ignores_null_tenant(spark):  # N4, C9
    raw = raw_df(spark, [dict(cliente=None, fecha_registro=ts(1)), dict(cliente="1", fecha_registro=ts(2))])
    assert [(r[0], r[1]) for r in D.tenant_start(raw).collect()] == [("1", ts(2))]
