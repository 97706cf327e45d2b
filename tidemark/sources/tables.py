"""Reading the raw log and the detail tables from where they live.

A catalog table, a file path (parquet by default) or a JDBC table.  Filters
and column selections applied afterwards reach the source: parquet gets
``PushedFilters``/``ReadSchema``, JDBC gets a ``WHERE`` clause and a column
list, so the incremental scan (``increment.incremental_scan``) reads only
rows newer than the mark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_source(spark: SparkSession, name: str, fmt: str | None = None, **options) -> DataFrame:
    """``name`` is a catalog table (``db.table``), a path, or a JDBC table when
    ``fmt == "jdbc"`` (then ``options`` carry ``url``, credentials, ...).

    A JDBC read of a large table should be split: pass ``partitionColumn``,
    ``lowerBound``, ``upperBound`` and ``numPartitions`` so that executors read
    ranges in parallel instead of one connection reading everything.
    """
    if fmt == "jdbc":
        return spark.read.format("jdbc").options(dbtable=name, **options).load()
    if fmt is None and "/" not in name and spark.catalog.tableExists(name):
        return spark.table(name)
    return spark.read.format(fmt or "parquet").options(**options).load(name)
