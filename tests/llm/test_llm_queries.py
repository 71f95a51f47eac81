"""Registered queries against their checking SQL, and their columns on empty tables."""

from __future__ import annotations

import pytest

from compare import differences
from tickloom.llm import queries as registry


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_rows_as_sql(spark, tables, name):
    assert differences(spark, tables, name, registry) == []


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_empty_tables(spark, tables, tmp_path, name):
    for table in ("documents", "benchmark", "labels", "pages", "conversations"):
        spark.read.parquet(f"{tables}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert registry.queries()[name](spark, str(tmp_path)).count() == 0
