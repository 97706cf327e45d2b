"""Small DataFrame helpers of the operators: column names, schemas, checkpoints."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType


def named(name: str) -> Column:
    """The column of exactly this name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def spare(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def prefix(df: DataFrame, start: str) -> str:
    """``start``, with underscores added until no column of ``df`` begins so."""
    while any(c.lower().startswith(start.lower()) for c in df.columns):
        start += "_"
    return start


def schema_with(df: DataFrame, name: str, ddl: str) -> StructType:
    """The schema of ``df`` and one more column."""
    return StructType([*df.schema.fields, StructField(name, DataType.fromDDL(ddl))])


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package known to the Python workers, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="llm-code-")) / "llm_operators.zip"
    with zipfile.ZipFile(archive, "w") as z:
        z.write(package.parent / "__init__.py", f"{package.parent.name}/__init__.py")
        for f in sorted(package.glob("*.py")):
            z.write(f, f"{package.parent.name}/{package.name}/{f.name}")
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def _with_names(function, given: list[str], within: list[str]):
    """``function`` on batches named as ``given``, its batches named as ``within``."""
    def run(batches):
        named_batches = (pa.RecordBatch.from_arrays(b.columns, names=given) for b in batches)
        for out in function(named_batches):
            yield pa.RecordBatch.from_arrays(out.columns, names=within)
    return run


def python_map(df: DataFrame, function, schema) -> DataFrame:
    """``df.mapInArrow`` with this package known to the workers; ``function`` sees and returns the columns under their own names."""
    ship(df.sparkSession)
    # mapInArrow takes names with dots or backticks for fields, so such columns travel under other names
    odd = {c: f"{prefix(df, '_c')}{k}" for k, c in enumerate(df.columns) if "." in c or "`" in c}
    if not odd:
        return df.mapInArrow(function, schema)
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    within = StructType([StructField(odd.get(f.name, f.name), f.dataType, f.nullable) for f in schema.fields])
    renamed = df.toDF(*(odd.get(c, c) for c in df.columns))
    return renamed.mapInArrow(_with_names(function, df.columns, within.names), within).toDF(*schema.names)


def _shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; one of its own is set only where none is, on a local master."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder as a checkpoint."""
    _shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder as a Parquet table (compressed, columns read as needed) and read back."""
    path = f"{_shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
