"""Table sinks on a shared folder: append (K1), replace (K2), keyed upsert (K3, K4).

Plain parquet has no MERGE and no transaction over several tables.  A store
therefore keeps immutable version folders and a manifest: one small file that
names, for every table, the versions that make up its rows, together with the
run log and the high-water marks.  All writes of a run go into a
:class:`Transaction`; they become visible together when its manifest is
written, and not at all if the run dies before.  Readers take what the newest
manifest lists, so a retry starts from the state before the failed run.

A manifest is written whole under a name of its own and then published as
number ``n`` by a step that fails if ``n`` exists (a hard link on local disks, a
rename without overwrite elsewhere; the file system must offer one of them).  Of two writers
that started from ``n - 1`` one commits, the other raises :class:`CommitConflict`
and can retry; a reader sees a manifest whole or not at all.  Version folders have
random names, so writers never touch each other's files.

* ``append`` adds the rows as one more version of the table (K1).
* ``replace`` makes one version the whole table (K2).
* ``upsert`` deletes the rows of the affected keys and inserts new ones (K3,
  K4).  Keyed tables are split into ``buckets`` folders by a hash of their
  keys, and only the buckets of the affected keys are read and rewritten.

* ``cluster`` makes a table without ``keys`` a bucketed Spark table: its versions are dealt by Spark's own hash of
  the cluster columns, and reading it tells Spark so.  A window or join on these columns takes the rows where they
  are, with no exchange.  The state tables, which every run compares whole with a snapshot, are such tables.

A keyed or clustered table keeps the number of buckets it was made with, whatever the setting of a later store.
``fold`` merges small versions into one; ``retain`` deletes old versions that the last manifests no longer name.  On a table
format with MERGE (Delta, Iceberg) the calls map to ``INSERT``, ``INSERT
OVERWRITE``, ``MERGE`` and ``VACUUM``.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.nulls import null_safe_join

_MANIFESTS = "_manifest"
BUCKET = "_b"
#: Buckets of a new keyed table; a large bucket is written by several tasks.
BUCKETS = 8
#: Bytes up to which a version (of a keyed table: its share of a bucket) counts as small.
SMALL_BYTES = 128 << 20
#: Age from which ``retain`` takes a version for no run's that is still open.
OPEN_HOURS = 24.0
#: Runs that a manifest remembers by id (a replayed trigger is among the last ones).
RUNS_KEPT = 1000


def together(*steps):
    """Results of steps that don't depend on each other, their jobs submitted at the same time.

    A run is many small jobs; side by side they fill the cluster.  If a step fails, its error is raised when all have ended."""
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        return [f.result() for f in [pool.submit(s) for s in steps]]


class CommitConflict(RuntimeError):
    """Another writer committed first."""


@dataclass
class Manifest:
    """What one commit made visible."""

    number: int = 0
    # name -> {"schema", "keys", "cluster", "n": number of buckets, "versions", "buckets": {bucket: [version, ...]}, "wrote": {version: buckets}, "bytes": {version: bytes}}
    tables: dict = field(default_factory=dict)
    runs: list = field(default_factory=list)  # [{"run_id", "mark", "rows", "late"}], newest last
    marks: dict = field(default_factory=dict)  # "" for all rows, and one for each tenant: newest processed timestamp (text)

    def copy(self) -> Manifest:
        return Manifest(self.number, json.loads(json.dumps(self.tables)), list(self.runs), dict(self.marks))


def bucket_of(keys, buckets: int) -> Column:
    """Bucket number of a row of a keyed table (NULL keys hash like any other)."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


@dataclass
class TableStore:
    """Tables under ``root`` (a folder every executor can reach)."""

    spark: SparkSession
    root: str
    buckets: int = BUCKETS

    # ------------------------------------------------------------ file system
    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        p, fs = self._fs(folder)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def _load(self, name: str) -> Manifest:
        p, fs = self._fs(f"{self.root}/{_MANIFESTS}/{name}")
        stream = fs.open(p)
        try:
            return Manifest(**json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        finally:
            stream.close()

    def _publish(self, state: Manifest) -> None:
        """Write the manifest beside the others and give it its number, which must be free."""
        jvm, folder = self.spark.sparkContext._jvm, f"{self.root}/{_MANIFESTS}"
        own, fs = self._fs(f"{folder}/.{uuid.uuid4().hex}.new")
        out = fs.create(own, False)
        out.write(bytearray(json.dumps(state.__dict__).encode()))
        out.close()
        target, _ = self._fs(f"{folder}/{state.number:010d}.json")
        try:
            if fs.getScheme() == "file":
                as_path = lambda p: jvm.java.nio.file.Paths.get(p.toUri().getPath(), self.spark.sparkContext._gateway.new_array(jvm.java.lang.String, 0))
                jvm.java.nio.file.Files.createLink(as_path(target), as_path(own))
            else:
                context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(own.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
                none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
                context.rename(own, target, none)
        except Exception as error:
            if fs.exists(target):
                raise CommitConflict(f"{target} was committed by another writer") from error
            raise
        finally:
            if fs.exists(own):
                fs.delete(own, False)

    def manifest(self) -> Manifest:
        """The newest committed manifest (an empty one for a new store)."""
        names = self._manifest_names()
        return self._load(max(names)) if names else Manifest()

    def _manifest_names(self) -> list[str]:
        return [n for n in self._names(f"{self.root}/{_MANIFESTS}") if n.endswith(".json") and not n.startswith(".")]

    # ---------------------------------------------------------------- reading
    def exists(self, table: str) -> bool:
        """Existence probe (S3): a table that no commit named does not exist."""
        return table in self.manifest().tables

    def read(self, table: str, schema: T.StructType | None = None) -> DataFrame | None:
        """Committed rows; an empty frame of ``schema`` (or None) when the table is absent."""
        return Transaction(self, self.manifest()).read(table, schema)

    # ---------------------------------------------------------------- writing
    def transaction(self) -> Transaction:
        return Transaction(self, self.manifest().copy())

    def append(self, df: DataFrame, table: str, keys=(), cluster=()) -> None:
        tx = self.transaction()
        tx.append(df, table, keys, cluster)
        tx.commit()

    def replace(self, df: DataFrame, table: str, keys=(), cluster=()) -> None:
        tx = self.transaction()
        tx.replace(df, table, keys, cluster)
        tx.commit()

    def upsert(self, new_rows: DataFrame, affected: DataFrame, table: str, keys) -> None:
        tx = self.transaction()
        tx.upsert(new_rows, affected, table, keys)
        tx.commit()

    def retain(self, manifests: int = 10, hours: float = OPEN_HOURS) -> int:
        """Delete versions and manifests that the newest ``manifests`` commits don't name; returns how many.

        Versions younger than ``hours`` stay: they may be those of a run that hasn't committed yet."""
        names = sorted(self._manifest_names())
        kept = [self._load(n) for n in names[-manifests:]]
        live = {v for m in kept for t in m.tables.values() for v in _versions(t)}
        before = (time.time() - hours * 3600) * 1000
        removed = 0
        for table in self._names(self.root):
            folder = f"{self.root}/{table}"
            stale = names[:-manifests] if table == _MANIFESTS else [n for n in self._names(folder) if f"{table}/{n}" not in live]
            for n in stale:
                p, fs = self._fs(f"{folder}/{n}")
                if table == _MANIFESTS or fs.getFileStatus(p).getModificationTime() <= before:
                    removed += bool(fs.delete(p, True))
        return removed

    def fold(self, tables: dict, versions: int = 2) -> list[str]:
        """Merge the small versions of each table that has at least ``versions`` of them; returns the tables folded.

        ``tables``: name -> function that folds the rows of any of its versions (identity for plain rows).  Of a keyed
        table only the buckets with so many small versions are rewritten.  Large versions, and tables that don't exist, stay as they are."""
        tx = self.transaction()
        due = {t: parts for t in tables if (parts := tx.small_versions(t, versions))}
        if due:
            together(*(lambda t=t, parts=parts: tx.fold(t, parts, tables[t]) for t, parts in due.items()))
            tx.commit()
        return sorted(due)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _passing_name() -> str:
    """A catalog name for the moment in which a bucketed table is written or read."""
    return f"tidemark_{uuid.uuid4().hex}"


def _versions(entry: dict) -> list[str]:
    return [*entry["versions"], *dict.fromkeys(v for vs in entry["buckets"].values() for v in vs)]


class Transaction:
    """Writes of one run, visible to it at once and to others when it commits.

    Different tables may be written from several threads (``together``)."""

    def __init__(self, store: TableStore, state: Manifest):
        self.store, self.state = store, state
        self.spark = store.spark
        self._lock = threading.Lock()

    # ---------------------------------------------------------------- reading
    def exists(self, table: str) -> bool:
        return table in self.state.tables

    def read(self, table: str, schema: T.StructType | None = None, buckets=None) -> DataFrame | None:
        """Current rows; with ``buckets``, those of some buckets of a keyed table (other folders aren't listed)."""
        entry = self.state.tables.get(table)
        if entry is None:
            return self.spark.createDataFrame([], schema) if schema is not None else None
        own = T.StructType.fromJson(entry["schema"])
        root = self.store.root
        if entry["cluster"] and entry["versions"]:
            return self._clustered(table, entry, own)
        if not entry["keys"]:
            return self._of([f"{root}/{v}" for v in entry["versions"]], own)
        wanted = entry["buckets"] if buckets is None else {str(b): entry["buckets"].get(str(b), []) for b in buckets}
        held: dict[str, list[str]] = {}
        for b, versions in wanted.items():
            for v in versions:
                held.setdefault(v, []).append(b)
        # a version that is wanted whole is one folder to list, else each of its buckets is
        whole = [f"{root}/{v}" for v, bs in held.items() if len(bs) == entry["wrote"][v]]
        parts = [f"{root}/{v}/{BUCKET}={b}" for v, bs in held.items() if len(bs) < entry["wrote"][v] for b in bs]
        return self._of(whole + parts, own)

    def _of(self, paths: list[str], schema: T.StructType) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*paths)

    def _clustered(self, table: str, entry: dict, schema: T.StructType) -> DataFrame:
        """The versions as one bucketed table.  Only a catalog entry tells Spark of buckets, so there is one while the frame is made."""
        names = [v.partition("/")[2] for v in entry["versions"]]
        folder = f"{self.store.root}/{table}/" + (names[0] if len(names) == 1 else "{" + ",".join(names) + "}")
        columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
        by = ", ".join(map(_quoted, entry["cluster"]))
        location = folder.replace("\\", "\\\\").replace("'", "\\'")
        name = _passing_name()
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {entry['n']} BUCKETS LOCATION '{location}'")
        try:
            return self.spark.table(name)
        finally:
            self.spark.sql(f"DROP TABLE {name}")  # external: its files stay

    def buckets_of(self, table: str) -> int | None:
        """The number of buckets that a clustered table is read in; None for other tables."""
        entry = self.state.tables.get(table)
        return entry["n"] if entry and entry["cluster"] and entry["versions"] else None

    def _buckets(self, table: str) -> int:
        entry = self.state.tables.get(table)
        return entry["n"] if entry else self.store.buckets

    def touched(self, affected: DataFrame, keys) -> Touched:
        """The buckets that some keys fall into, for any table with these keys."""
        return Touched(self, affected, list(keys))

    # ---------------------------------------------------------------- writing
    def _new_entry(self, df: DataFrame, keys, cluster=()) -> dict:
        if keys and cluster:
            raise ValueError("a table is keyed or clustered")
        return {"schema": df.schema.jsonValue(), "keys": list(keys), "cluster": list(cluster), "n": self.store.buckets, "versions": [], "buckets": {}, "wrote": {}, "bytes": {}}

    def _entry(self, df: DataFrame, table: str, keys, cluster) -> dict:
        old = self.state.tables.get(table)
        if old is not None and (old["keys"], old["cluster"]) != (list(keys), list(cluster)):
            raise ValueError(f"{table} is keyed by {old['keys']}, clustered by {old['cluster']}")
        return old or self._new_entry(df, keys, cluster)

    def _write(self, df: DataFrame, table: str, entry: dict) -> tuple[str, list[str], int]:
        version = f"{table}/{uuid.uuid4().hex}"
        path = f"{self.store.root}/{version}"
        if entry["keys"]:
            # rows of a bucket go together; a bucket beyond Spark's advisory size is dealt to several tasks, small ones share one
            df.withColumn(BUCKET, bucket_of(entry["keys"], entry["n"])).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(path)
        elif entry["cluster"]:
            by, name = entry["cluster"], _passing_name()
            df.repartition(entry["n"], *by).write.bucketBy(entry["n"], *by).sortBy(*by).option("path", path).saveAsTable(name, format="parquet")
            self.spark.sql(f"DROP TABLE {name}")
        else:
            df.write.parquet(path)
        p, fs = self.store._fs(path)
        return version, [n.partition("=")[2] for n in self.store._names(path) if n.startswith(BUCKET + "=")], fs.getContentSummary(p).getLength()

    def _put(self, df: DataFrame, table: str, entry: dict) -> DataFrame:
        version, buckets, size = self._write(df, table, entry)
        if not entry["keys"]:
            entry["versions"] = [*entry["versions"], version]
        for b in buckets:
            entry["buckets"][b] = [*entry["buckets"].get(b, []), version]
        live = set(_versions(entry))
        entry["wrote"] = {v: n for v, n in (entry["wrote"] | {version: len(buckets)}).items() if v in live}
        entry["bytes"] = {v: n for v, n in (entry["bytes"] | {version: size}).items() if v in live}
        with self._lock:
            self.state.tables[table] = entry
        return self._of([f"{self.store.root}/{version}"] if version in live else [], T.StructType.fromJson(entry["schema"]))

    def append(self, df: DataFrame, table: str, keys=(), cluster=()) -> DataFrame:
        """K1: add rows; earlier versions stay as they are.  Returns the rows as written."""
        return self._put(df, table, self._entry(df, table, keys, cluster))

    def replace(self, df: DataFrame, table: str, keys=(), cluster=()) -> DataFrame:
        """K2: the rows of ``df`` become the whole table."""
        return self._put(df, table, self._new_entry(df, keys, cluster))

    def upsert(self, new_rows: DataFrame, affected: DataFrame, table: str, keys, touched: Touched | None = None) -> None:
        """K3/K4: delete the rows whose ``keys`` appear in ``affected``, insert ``new_rows`` (rows of such keys only).

        ``touched``: the buckets of ``affected``, when the caller knows them."""
        keys = list(keys)
        if not self.exists(table):
            self.replace(new_rows, table, keys)
            return
        buckets = (touched or self.touched(affected, keys)).of(table)
        current = self.read(table, buckets=buckets)
        kept = null_safe_join(current, affected.select(*keys), keys, "left_anti")
        entry = self.state.tables[table]
        entry["buckets"] = {b: v for b, v in entry["buckets"].items() if int(b) not in set(buckets)}
        self._put(kept.unionByName(new_rows.select(*current.columns)), table, entry)

    # ---------------------------------------------------------------- folding
    def small_versions(self, table: str, fewest: int) -> dict[str, list[str]]:
        """bucket ("" for a table without keys) -> its small versions, where there are at least ``fewest``."""
        entry = self.state.tables.get(table)
        if entry is None:
            return {}
        small = {v for v, n in entry["bytes"].items() if n <= SMALL_BYTES * max(1, entry["wrote"].get(v, 1))}
        held = entry["buckets"] if entry["keys"] else {"": entry["versions"]}
        return {b: own for b, vs in held.items() if len(own := [v for v in vs if v in small]) >= fewest}

    def fold(self, table: str, parts: dict[str, list[str]], folded) -> None:
        """Put one version in place of the ``parts`` of each bucket."""
        entry, root = self.state.tables[table], self.store.root
        paths = [f"{root}/{v}/{BUCKET}={b}" if entry["keys"] else f"{root}/{v}" for b, vs in parts.items() for v in vs]
        rows = folded(self._of(paths, T.StructType.fromJson(entry["schema"])))
        if entry["keys"]:
            entry["buckets"] = {b: [v for v in vs if v not in parts.get(b, ())] for b, vs in entry["buckets"].items()}
        else:
            entry["versions"] = [v for v in entry["versions"] if v not in parts[""]]
        self._put(rows, table, entry)

    def commit(self, run: dict | None = None, marks: dict | None = None) -> int:
        """Make everything written here visible, or raise if another writer committed since this one began."""
        if run is not None:
            self.state.runs = [*self.state.runs, run][-RUNS_KEPT:]
        self.state.marks.update(marks or {})
        base = self.state.number
        if self.store.manifest().number != base:
            raise CommitConflict(f"{self.store.root}: a commit came after number {base}")
        self.state.number = base + 1
        self.store._publish(self.state)
        return self.state.number


class Touched:
    """Bucket numbers of some keys; tables with another number of buckets have their own (at most as many numbers reach the driver)."""

    def __init__(self, tx: Transaction, affected: DataFrame, keys: list[str]):
        self.tx, self.affected, self.keys = tx, affected, keys
        self._found: dict[int, list[int]] = {}

    def of(self, table: str) -> list[int]:
        n = self.tx._buckets(table)
        if n not in self._found:
            numbers = self.affected.select(bucket_of(self.keys, n).alias(BUCKET)).distinct().collect()
            self._found[n] = sorted(r[0] for r in numbers)
        return self._found[n]
