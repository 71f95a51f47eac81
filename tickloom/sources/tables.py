"""Bars and per-region tables derived from event, order and supplier tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

PRICE_COLUMNS = ["open", "high", "low", "close", "volume"]


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bars_from_ticks(
    ticks: DataFrame,
    symbol: str,
    moment: str,
    value: str,
    tie_break: str,
    interval: str = "hour",
) -> DataFrame:
    """Open, high, low, close and volume per symbol and interval, in one map-side combined pass.

    Volume is rounded to six digits because the order of a distributed sum is not fixed.
    """
    arrival = F.struct(moment, tie_break)
    start = F.date_trunc(interval, F.col(moment)).cast("timestamp_ntz")
    return ticks.groupBy(F.col(symbol).alias("symbol"), start.alias("date")).agg(
        F.min_by(value, arrival).alias("open"),
        F.max(value).alias("high"),
        F.min(value).alias("low"),
        F.max_by(value, arrival).alias("close"),
        F.round(F.sum(value), 6).alias("volume"),
    )


def event_bars(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly bars of the events table, one symbol per event type."""
    return bars_from_ticks(read_table(spark, folder, "events"), "event_type", "ts", "value", "event_id")


def minute_bars(spark: SparkSession, folder: str) -> DataFrame:
    """Bars by the minute, which the models are fitted on."""
    return bars_from_ticks(read_table(spark, folder, "events"), "event_type", "ts", "value", "event_id", "minute")


def hour_number(date: str = "date") -> Column:
    return F.expr(f"unix_seconds(cast({date} as timestamp)) div 3600")


def minute_number(date: str = "date") -> Column:
    return F.expr(f"unix_seconds(cast({date} as timestamp)) div 60")




INDICATORS = ["y1", "y2", "y3", "y4", "y5"]
PREDICTORS = ["x1", "x2"]


def order_indicators(spark: SparkSession, folder: str) -> DataFrame:
    """Five 0/1 answers per order, with the customer as respondent."""
    orders = read_table(spark, folder, "orders")

    def flag(condition: Column) -> Column:
        return F.when(condition, 1.0).otherwise(0.0)

    return orders.select(
        "o_orderkey",
        "o_custkey",
        flag(F.col("o_orderstatus") == "F").alias("y1"),
        flag(F.col("o_orderstatus") == "P").alias("y2"),
        flag(F.col("o_orderpriority").startswith("1")).alias("y3"),
        flag(F.col("o_orderpriority").startswith("2")).alias("y4"),
        flag(F.col("o_totalprice") > 150000).alias("y5"),
    )


def survey_means(spark: SparkSession, folder: str) -> DataFrame:
    """Mean of each indicator per nation.

    Orders are summed per customer before the join, so neither a customer nor a nation with a
    large share of the orders makes a heavy task.
    """
    per_customer = (
        order_indicators(spark, folder)
        .groupBy("o_custkey")
        .agg(*[F.sum(y).alias(y) for y in INDICATORS], F.count("*").alias("answers"))
    )
    customer = read_table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    return (
        customer.join(per_customer, F.col("c_custkey") == F.col("o_custkey"))
        .groupBy(F.col("c_nationkey").alias("k"))
        .agg(*[(F.sum(y) / F.sum("answers")).alias(y) for y in INDICATORS])
    )


def supplier_rate(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers per customer by nation."""
    people = read_table(spark, folder, "customer").groupBy(F.col("c_nationkey").alias("k")).agg(
        F.count("*").alias("pop")
    )
    staff = read_table(spark, folder, "supplier").groupBy(F.col("s_nationkey").alias("k")).agg(
        F.count("*").alias("staff")
    )
    return people.join(staff, "k").select("k", (F.col("staff") / F.col("pop")).alias("x1"))


def survey_table(spark: SparkSession, folder: str) -> DataFrame:
    """Indicators and both per-customer rates per nation, from one pass over each table.

    Line items are summed per order, orders per customer, customers per nation, so each join meets
    rows that are already reduced to one per key.
    """
    returned = (
        read_table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("returned"))
    )
    per_customer = (
        order_indicators(spark, folder)
        .join(returned, "o_orderkey", "left")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(*[F.sum(y).alias(y) for y in INDICATORS], F.count("*").alias("answers"), F.sum("returned").alias("returned"))
    )
    per_nation = (
        read_table(spark, folder, "customer")
        .select("c_custkey", "c_nationkey")
        .join(per_customer, "c_custkey", "left")
        .groupBy(F.col("c_nationkey").alias("k"))
        .agg(
            *[(F.sum(y) / F.sum("answers")).alias(y) for y in INDICATORS],
            F.count("*").alias("pop"),
            F.coalesce(F.sum("returned"), F.lit(0)).alias("returned"),
            F.sum("answers").alias("answers"),
        )
        .filter("answers > 0")
    )
    staff = read_table(spark, folder, "supplier").groupBy(F.col("s_nationkey").alias("k")).agg(
        F.count("*").alias("staff")
    )
    return per_nation.join(staff, "k").select(
        "k",
        *INDICATORS,
        (F.col("staff") / F.col("pop")).alias("x1"),
        (F.col("returned").cast("double") / F.col("pop")).alias("x2"),
    )


def fit_pairs(
    table: DataFrame,
    key: str = "k",
    responses: Sequence[str] = INDICATORS,
    predictors: Sequence[str] = PREDICTORS,
) -> DataFrame:
    """Long form ``(pair, row_key, x, y)`` of every response against every predictor."""
    cases = [f"'{y}~{x}', {x}, {y}" for y in responses for x in predictors]
    return table.selectExpr(f"{key} as row_key", f"stack({len(cases)}, {', '.join(cases)}) as (pair, x, y)").select(
        "pair", "row_key", "x", "y"
    )
