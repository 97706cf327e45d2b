"""Branch counts of FIXTURES.md section 3 at sf0.001."""

from pyspark.sql import functions as F

from conftest import SF001
from tidemark.operators import dims as D
from tidemark.operators.history import compress_history, suppressed_batch
from tidemark.operators.latest import latest_snapshot
from tidemark.schemas import CHILD, PARENT
from tidemark.sources import fixtures as fx


def test_case_log_counts(spark):
    raw = fx.case_log(spark, SF001)
    assert raw.count() == 715
    assert compress_history(raw, PARENT).count() == 314
    assert compress_history(raw, CHILD).count() == 386
    assert raw.filter(F.col("folio_hijo") == "").count() == 250
    assert raw.filter(F.col("estado_hijo").isNull()).count() == 7
    assert latest_snapshot(raw).count() == 24
    assert suppressed_batch(raw, PARENT, "2024-01-30").count() == 1
    assert suppressed_batch(raw, CHILD, "2024-01-30").count() == 14
    assert raw.filter(F.col("fecha_registro") <= F.lit("2024-01-20").cast("timestamp_ntz")).count() == 497


def test_schema_is_timestamp_ntz(spark):
    raw = fx.case_log(spark, SF001)
    assert raw.schema["fecha_registro"].dataType.typeName() == "timestamp_ntz"


def test_dimension_branches(spark):
    raw = fx.case_log(spark, SF001)
    cls = D.followup_class(D.parent_static(raw), D.tenant_start(raw))
    counts = {r[0]: r[1] for r in cls.groupBy("tipo_seguimiento").count().collect()}
    assert counts == {"current": 8, "legacy": 4}
    assert D.parent_static(raw).filter(F.col("fecha_asignacion").isNull()).count() == 1
    enriched = D.detail_enrichment(D.parent_static(raw), fx.case_details(spark, SF001))
    assert enriched.filter(F.col("fecha_atencion").isNotNull()).count() == 13
    ben = D.benefit_enrichment(D.child_base(raw), fx.benefits(spark, SF001))
    assert ben.filter(F.col("descripcion").isNotNull()).count() == 30
