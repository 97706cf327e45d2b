"""Registered queries against their SQL, as the driver compares them."""

import pytest
from conftest import SF001
from test_oracle import con, rows_of_spark, rows_of_sql  # noqa: F401

from tidemark.llm import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_matches_sql(spark, con, name):  # noqa: F811
    columns, rows = rows_of_spark(registry.QUERIES[name](spark, SF001))
    assert (columns, rows) == rows_of_sql(con, registry.ORACLE_SQL[name])


def test_queries_without_sql_return_whole_tables(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").count()
    for name in ("op4_quality_rules", "op7_ngram_jaccard_join", "op10_substring_dedup"):
        assert registry.QUERIES[name](spark, SF001).count() == docs
