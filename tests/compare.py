"""Runs a query and its checking SQL on the same folder and compares the rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb

from pyspark.sql import SparkSession

from tickloom import plans


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def normalised(rows: list[tuple]) -> list[tuple]:
    def cell(value: object) -> object:
        if isinstance(value, float):
            return "NaN" if math.isnan(value) else repr(value + 0.0)
        return repr(value)

    return sorted(tuple(cell(v) for v in row) for row in rows)


def differences(spark: SparkSession, folder: str, name: str, registry=plans) -> list[str]:
    """Empty when names, types of the columns and all values agree."""
    result = registry.queries()[name](spark, folder)
    columns = sorted(result.columns)
    actual = normalised([tuple(row) for row in result.select(*[f"`{c}`" for c in columns]).collect()])
    connection = oracle_connection(folder)
    relation = connection.sql(registry.oracle_sql()[name])
    if sorted(relation.columns) != columns:
        return [f"columns {columns} against {sorted(relation.columns)}"]
    expected = normalised(relation.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall())
    problems = []
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
             "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP"}
    types = dict(zip(relation.columns, map(str, relation.types)))
    for column, kind in result.dtypes:
        if kinds.get(kind, kind) != types[column]:
            problems.append(f"type of {column}: {kind} against {types[column]}")
    if len(actual) != len(expected):
        problems.append(f"{len(actual)} rows against {len(expected)}")
    different = [(a, b) for a, b in zip(actual, expected) if a != b]
    if different:
        problems.append(f"{len(different)} rows differ, first: {different[0][0]} against {different[0][1]}")
    return problems
