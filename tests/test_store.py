"""Table store: append, replace, upsert by bucket, commits, conflicts, retention."""

import os

import pytest

from tidemark.session import scratch
from tidemark.sinks.store import BUCKET, CommitConflict, TableStore


def df(spark, rows):
    return spark.createDataFrame(rows, "k string, v long")


def rows(d):
    return sorted(tuple(r) for r in d.collect())


def test_append_replace_upsert(spark):
    store = TableStore(spark, scratch(spark, "store-test"))
    assert not store.exists("t")
    assert store.read("t") is None
    assert store.read("t", schema="k string, v long").count() == 0
    store.append(df(spark, [("a", 1), ("b", 2)]), "t", ["k"])
    store.append(df(spark, [("c", 3)]), "t", ["k"])
    assert rows(store.read("t")) == [("a", 1), ("b", 2), ("c", 3)]
    store.upsert(df(spark, [("b", 20), ("d", 4)]), df(spark, [("b", 0), ("d", 0)]), "t", ["k"])
    assert rows(store.read("t")) == [("a", 1), ("b", 20), ("c", 3), ("d", 4)]
    store.append(df(spark, [("e", 5)]), "t", ["k"])
    store.replace(store.read("t"), "t", ["k"])
    assert rows(store.read("t")) == [("a", 1), ("b", 20), ("c", 3), ("d", 4), ("e", 5)]
    store.replace(df(spark, [("z", 9)]), "t", ["k"])
    assert rows(store.read("t")) == [("z", 9)]
    store.append(df(spark, [("a", 1)]), "plain")
    store.append(df(spark, []), "plain")
    assert rows(store.read("plain")) == [("a", 1)]
    with pytest.raises(ValueError):
        store.append(df(spark, [("a", 1)]), "plain", ["k"])


def test_upsert_matches_null_keys(spark):
    store = TableStore(spark, scratch(spark, "store-null"))
    store.replace(df(spark, [(None, 1), ("a", 2)]), "t", ["k"])
    store.upsert(df(spark, [(None, 10)]), df(spark, [(None, 0)]), "t", ["k"])
    assert rows(store.read("t").fillna("~")) == [("a", 2), ("~", 10)]


def test_upsert_touches_only_its_buckets(spark):
    store = TableStore(spark, scratch(spark, "store-buckets"))
    store.replace(df(spark, [(f"k{i}", i) for i in range(100)]), "t", ["k"])
    before = store.manifest().tables["t"]["buckets"]
    files = {f: os.stat(f).st_mtime_ns for f in store.read("t").inputFiles() for f in [f.removeprefix("file://")]}
    store.upsert(df(spark, [("k7", 70)]), df(spark, [("k7", 0)]), "t", ["k"])
    after = store.manifest().tables["t"]["buckets"]
    changed = [b for b in before if before[b] != after[b]]
    assert len(changed) == 1
    read = {f.removeprefix("file://") for f in store.read("t").inputFiles()}
    kept = [f for f in files if f"{BUCKET}={changed[0]}/" not in f]
    assert set(kept) <= read and all(os.stat(f).st_mtime_ns == files[f] for f in kept)
    assert rows(store.read("t")) == sorted((f"k{i}", 70 if i == 7 else i) for i in range(100))
    gone = df(spark, [(f"k{i}", 0) for i in range(100)])
    store.upsert(df(spark, []), gone, "t", ["k"])  # every row deleted
    assert rows(store.read("t")) == []


def test_uncommitted_writes_are_invisible(spark):
    store = TableStore(spark, scratch(spark, "store-partial"))
    store.append(df(spark, [("a", 1)]), "t")
    tx = store.transaction()
    tx.append(df(spark, [("x", 9)]), "t")
    tx.append(df(spark, [("x", 9)]), "u")
    assert rows(tx.read("t")) == [("a", 1), ("x", 9)]
    assert rows(store.read("t")) == [("a", 1)] and not store.exists("u")
    store.append(df(spark, [("b", 2)]), "t")  # another writer commits first
    with pytest.raises(CommitConflict):
        tx.commit()
    assert rows(store.read("t")) == [("a", 1), ("b", 2)] and not store.exists("u")


def test_a_writer_that_is_slow_to_commit_loses_nothing(spark, monkeypatch):
    """Writer B commits while writer A stands between writing its manifest and publishing it: A conflicts, B's rows stay."""
    store = TableStore(spark, scratch(spark, "store-two"))
    store.append(df(spark, [("a", 1)]), "t")
    a, publish = store.transaction(), TableStore._publish
    a.append(df(spark, [("x", 9)]), "t")

    def late(self, state):
        monkeypatch.setattr(TableStore, "_publish", publish)
        store.append(df(spark, [("b", 2)]), "t")  # B, whole
        publish(self, state)
    monkeypatch.setattr(TableStore, "_publish", late)
    with pytest.raises(CommitConflict):
        a.commit()
    assert rows(store.read("t")) == [("a", 1), ("b", 2)] and store.manifest().number == 2
    store.append(df(spark, [("c", 3)]), "t")
    assert rows(store.read("t")) == [("a", 1), ("b", 2), ("c", 3)]


def test_a_manifest_being_written_is_not_seen(spark):
    root = scratch(spark, "store-torn")
    store = TableStore(spark, root)
    store.append(df(spark, [("a", 1)]), "t")
    folder = root.removeprefix("file:") + "/_manifest"
    with open(f"{folder}/.0123.new", "w") as f:  # its writer died
        f.write('{"number": 2, "tab')
    assert rows(store.read("t")) == [("a", 1)]
    store.append(df(spark, [("b", 2)]), "t")
    assert rows(store.read("t")) == [("a", 1), ("b", 2)] and store.manifest().number == 2


def test_buckets_stay_those_of_the_table(spark):
    root = scratch(spark, "store-recount")
    many = [(f"k{i}", i) for i in range(40)]
    TableStore(spark, root, buckets=8).replace(df(spark, many), "t", ["k"])
    other = TableStore(spark, root, buckets=5)
    other.upsert(df(spark, [(k, v + 100) for k, v in many]), df(spark, many), "t", ["k"])
    assert rows(other.read("t")) == sorted((k, v + 100) for k, v in many)
    other.append(df(spark, [("k1", 7)]), "t", ["k"])
    other.upsert(df(spark, []), df(spark, [("k1", 0)]), "t", ["k"])
    assert rows(other.read("t")) == sorted((k, v + 100) for k, v in many if k != "k1")
    other.replace(df(spark, many), "t", ["k"])  # a new version of the whole table takes the new number
    assert other.manifest().tables["t"]["n"] == 5 and rows(other.read("t")) == sorted(many)


def test_fold_merges_small_versions_only(spark, monkeypatch):
    from tidemark.sinks import store as S
    store = TableStore(spark, scratch(spark, "store-fold"))
    store.replace(df(spark, [(f"k{i}", i) for i in range(3000)]), "plain")
    store.replace(df(spark, [(f"k{i}", i) for i in range(3000)]), "keyed", ["k"])
    base = {t: set(S._versions(store.manifest().tables[t])) for t in ("plain", "keyed")}
    for k in range(3):
        store.append(df(spark, [("k1", -k)]), "plain")
        store.append(df(spark, [("k1", -k)]), "keyed", ["k"])
    monkeypatch.setattr(S, "SMALL_BYTES", 2000)
    assert store.fold({"plain": lambda d: d, "keyed": lambda d: d, "unknown": lambda d: d}, versions=4) == []
    before = rows(store.read("plain"))
    assert store.fold({"plain": lambda d: d, "keyed": lambda d: d, "unknown": lambda d: d}, versions=3) == ["keyed", "plain"]
    assert rows(store.read("plain")) == rows(store.read("keyed")) == before
    after = {t: S._versions(store.manifest().tables[t]) for t in base}
    assert all(base[t] <= set(after[t]) and len(after[t]) == 2 for t in base)


def test_retention_keeps_what_the_last_commits_name(spark):
    store = TableStore(spark, scratch(spark, "store-retain"))
    for k in range(4):
        store.replace(df(spark, [("a", k)]), "t", ["k"])
    open_run = store.transaction()
    open_run.append(df(spark, [("b", 9)]), "t", ["k"])
    assert store.retain(2) == 2  # two manifests; young versions may be an open run's
    open_run.commit()
    assert rows(store.read("t")) == [("a", 3), ("b", 9)]
    assert store.retain(2, hours=0) == 4  # a manifest and three versions
    assert rows(store.read("t")) == [("a", 3), ("b", 9)]
    assert len(os.listdir(store.root.removeprefix("file:") + "/t")) == 2


def test_read_source_path_and_catalog(spark):
    from tidemark.sources.tables import read_source
    path = scratch(spark, "src")
    df(spark, [("a", 1)]).write.parquet(path)
    assert rows(read_source(spark, path)) == [("a", 1)]
    df(spark, [("b", 2)]).createOrReplaceTempView("tm_src_view")
    assert rows(read_source(spark, "tm_src_view")) == [("b", 2)]


def test_work_dir_reads_session_setting(spark):
    from tidemark.session import work_dir
    d = work_dir(spark)
    conf = spark.conf.get("spark.checkpoint.dir", None)
    assert d and (conf is None or conf.rstrip("/") == d)
    assert work_dir(spark) == d


def test_require_columns(spark):
    import pytest
    from tidemark.schemas import MissingColumnsError, require_columns
    d = df(spark, [("a", 1)])
    assert require_columns(d, ["k"]) is d
    with pytest.raises(MissingColumnsError):
        require_columns(d, ["k", "estado_padre"])
