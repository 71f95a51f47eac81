"""Every registered query runs; those with checking SQL give the same rows."""

from __future__ import annotations

import pytest

from compare import differences
from tickloom import plans

CHECKED = sorted(plans.oracle_sql())
# made of queries that are checked by themselves
LONG = {"per_symbol_report", "model_comparison"}
UNCHECKED = sorted(set(plans.queries()) - set(CHECKED) - LONG)


def test_checking_sql_belongs_to_queries():
    assert set(CHECKED) <= set(plans.queries())


@pytest.mark.parametrize("name", CHECKED)
def test_same_rows_as_sql(spark, tables, name):
    assert differences(spark, tables, name) == []


@pytest.mark.parametrize("name", UNCHECKED)
def test_runs(spark, tables, name):
    result = plans.queries()[name](spark, tables)
    assert result.columns and result.count() > 0


def test_all_models_for_every_symbol(spark, tables):
    table = plans.queries()["model_comparison"](spark, tables).toPandas()
    symbols = {row[0] for row in spark.read.parquet(f"{tables}/events.parquet").select("event_type").distinct().collect()}
    assert set(table["symbol"]) == symbols
    assert table["streaming"].all()
    assert (table[["elastic_net", "knn", "boosted_trees"]] > 0).all(axis=None)


def test_report_of_every_symbol(spark, tables):
    """Each model has its errors for each symbol, and those of the linear model are the checked query's."""
    table = plans.queries()["per_symbol_report"](spark, tables).toPandas()
    assert table.groupby("symbol")["model"].agg(set).map(sorted).map(tuple).nunique() == 1
    assert {"elastic_net", "knn", "boosted_trees", "sequence"} <= set(table["model"])
    own = ["symbol", "metric", "param"]
    line = plans.queries()["elastic_net_close"](spark, tables).toPandas().set_index(own)["value"].sort_index()
    assert (table[table["model"] == "elastic_net"].set_index(own)["value"].sort_index() == line).all()


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() == 25
    assert set(contract.oracle_sql()) <= set(contract.queries())
