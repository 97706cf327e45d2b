"""The case-log inputs, derived from the driver's tables (see FIXTURES.md).

``case_log`` turns the ``events`` table into daily snapshots of parent and
child cases; ``case_details`` and ``benefits`` come from ``orders``.  These
are views: they grow with the tables they read, and Spark plans them with the
queries that use them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import ASSIGNED


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def case_log(spark: SparkSession, sf_dir: str, staggered: bool = False) -> DataFrame:
    """Daily snapshots: one row per (user, slot, day), newest event wins.

    ``staggered`` shifts each tenant's snapshot time by (user_id % 5) x 10
    minutes, so tenants are recorded at different times.
    """
    ev = read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    ev = ev.withColumn("d", F.to_date("ts")).withColumn("slot", F.col("event_id") % 3)
    newest_first = [F.col("ts").desc(), F.col("event_id").desc()]
    # Newest event per (user, day, slot) first: planned as a WindowGroupLimit
    # before the shuffle, so a busy user-day ships at most 3 rows per map
    # task.  The day's newest event - the parent state - is the newest of
    # those <= 3 rows.
    per_slot = Window.partitionBy("user_id", "d", "slot").orderBy(*newest_first)
    per_day = Window.partitionBy("user_id", "d").orderBy(*newest_first)
    ev = ev.withColumn("_rn", F.row_number().over(per_slot)).filter(F.col("_rn") == 1)
    ev = ev.withColumn("pst", F.first("event_type").over(per_day))

    uid = F.col("user_id")
    snap = F.col("d").cast("timestamp_ntz")
    if staggered:
        snap = snap + F.make_dt_interval(F.lit(0), F.lit(0), ((uid % 5) * 10).cast("int"))
    return ev.select(
        (uid % 5).cast("string").alias("cliente"),
        F.concat(F.lit("P"), uid.cast("string")).alias("folio_padre"),
        F.when(F.col("slot") == 0, F.lit(""))
        .otherwise(F.concat(F.lit("H"), uid.cast("string"), F.lit("-"), F.col("slot").cast("string")))
        .alias("folio_hijo"),
        snap.alias("fecha_registro"),
        F.when(F.col("pst") == "signup", F.lit(ASSIGNED))
        .when(F.col("pst") == "error", F.lit("No acepta tratamiento"))
        .otherwise(F.col("pst")).alias("estado_padre"),
        F.when(F.col("event_id") % 97 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("event_type")).alias("estado_hijo"),
        F.when(uid % 2 == 0, F.lit("GRD")).otherwise(F.lit("PPA")).alias("ppa_grd"),
        F.col("value").alias("monto_total"),
        F.when(uid % 11 == 0, F.lit(None).cast("timestamp_ntz"))
        .otherwise(F.lit("2024-01-01").cast("timestamp_ntz")
                   + F.make_dt_interval((uid % 3 - 1).cast("int")))
        .alias("fecha_asignacion"),
        F.concat(F.lit("R"), uid.cast("string")).alias("rut_paciente"),
        F.concat(F.lit("N"), uid.cast("string")).alias("nombre_paciente"),
        F.concat(F.lit("I"), (uid % 7).cast("string")).alias("intervencion_sanitaria"),
        F.concat(F.lit("u/"), uid.cast("string"),
                 F.when(uid % 10 == 0, F.lit("/codificado")).otherwise(F.lit(""))).alias("url_ficha"),
        F.col("event_id").alias("load_seq"),
    )


def case_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    return o.select(
        F.concat(F.lit("u/"), F.col("o_custkey").cast("string")).alias("url_ficha"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("fecha_atencion"),
        F.col("o_orderstatus").alias("intervencion_sanitaria_ingreso"),
        F.col("o_orderpriority").alias("problema_salud"),
        F.col("o_orderkey").alias("load_seq"),
    )


def benefits(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    return o.select(
        (F.col("o_custkey") % 5).cast("string").alias("cliente"),
        F.concat(F.lit("H"), F.col("o_custkey").cast("string"), F.lit("-"),
                 (1 + key % 2).cast("string")).alias("folio"),
        F.when(key % 7 == 0, F.lit("sin codigo"))
        .otherwise(F.concat(F.col("o_orderpriority"), F.lit(": "), (key * 100).cast("string")))
        .alias("descripcion"),
        F.col("o_orderstatus").alias("estado"),
        key.alias("load_seq"),
    )
