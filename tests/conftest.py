import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from tidemark.schemas import RAW_COLUMNS  # noqa: E402

SF001 = "/root/testdata/sf0.001"

RAW_SCHEMA = ("cliente string, folio_padre string, folio_hijo string, fecha_registro timestamp_ntz, "
              "estado_padre string, estado_hijo string, ppa_grd string, monto_total double, "
              "fecha_asignacion timestamp_ntz, rut_paciente string, nombre_paciente string, "
              "intervencion_sanitaria string, url_ficha string, load_seq bigint")


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[4]").appName("tidemark-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


def ts(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


_seq = [0]


def raw_df(spark, rows):
    """Raw-log rows from dicts; unspecified columns get neutral defaults."""
    out = []
    for r in rows:
        _seq[0] += 1
        d = dict(cliente="1", folio_padre="P1", folio_hijo="H1", fecha_registro=ts(1), estado_padre="a",
                 estado_hijo="x", ppa_grd="GRD", monto_total=1.0, fecha_asignacion=ts(2),
                 rut_paciente="R", nombre_paciente="N", intervencion_sanitaria="I", url_ficha="u/1",
                 load_seq=_seq[0])
        d.update(r)
        out.append(tuple(d[c] for c in RAW_COLUMNS))
    return spark.createDataFrame(out, RAW_SCHEMA)
