"""Session helpers: a local session for tests/bench and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import threading

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tidemark") -> SparkSession:
    """A local session configured the way the package expects a cluster to be.

    AQE stays on (runtime broadcast of small sides, partition coalescing, skew
    join splitting); the UI stays off.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and tables written by the plans.

    Read from ``spark.checkpoint.dir`` (or a checkpoint folder already set on
    the context).  Only a local-mode session without either gets a fresh
    folder of its own (tests, bench); on a cluster the setting is required,
    since a machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    conf = spark.conf.get(CHECKPOINT_CONF, None)
    if conf:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(conf)  # for DataFrame.checkpoint()
        return conf.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a shared folder before running plans")
    path = tempfile.mkdtemp(prefix="tidemark-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir().rstrip("/")


_scratch_lock = threading.Lock()
_issued: set = set()


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the work folder (unique across threads of this process)."""
    base = work_dir(spark)
    with _scratch_lock:
        i = 0
        while True:
            path = f"{base}/{name}-{os.getpid()}-{i}"
            if path not in _issued and not _exists(spark, path):
                _issued.add(path)
                return path
            i += 1


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jpath)
