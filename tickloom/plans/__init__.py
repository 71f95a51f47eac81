"""Queries over the test tables."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from tickloom.plans import file_queries, model_queries, regression_queries, table_queries  # noqa: F401  (each registers its queries)
from tickloom.plans.registry import ORACLES, QUERIES, Query


def _in_utc(run: Query) -> Query:
    @functools.wraps(run)
    def call(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return run(spark, folder)

    return call


def queries() -> dict[str, Query]:
    return {name: _in_utc(run) for name, run in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
