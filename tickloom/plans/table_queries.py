"""Scans, projections, filters, null handling, aggregates, joins, positions."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.functions.values import (
    day_month_year,
    file_extension,
    padded_tag,
    ratio,
    rounded,
    strip_thousands,
    to_int,
)
from tickloom.operators import aggregate, features, joins, rows
from tickloom.plans.checking_sql import BARS, HOUR, INDEXED, PARTED, PRICES, SURVEY, r
from tickloom.plans.registry import query
from tickloom.session import stage
from tickloom.sources.tables import (
    INDICATORS,
    PRICE_COLUMNS,
    event_bars,
    hour_number,
    order_indicators,
    read_table,
    supplier_rate,
    survey_means,
    survey_table,
)

_PRICES_SQL = ", ".join(PRICES)


@query("bars", f"with {BARS} select * from bars")
def bars(spark: SparkSession, folder: str) -> DataFrame:
    return event_bars(spark, folder)


# --- projections, filters, row access -------------------------------------------------------


@query("project", "select event_id, event_type, value from events")
def project(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "events").select("event_id", "event_type", "value")


@query("drop_columns", f"with {BARS} select symbol, {_PRICES_SQL} from bars")
def drop_columns(spark: SparkSession, folder: str) -> DataFrame:
    return event_bars(spark, folder).drop("date")


@query("rename_positional", "select n_nationkey as k, n_name as state, n_regionkey as region from nation")
def rename_positional(spark: SparkSession, folder: str) -> DataFrame:
    return rows.rename_positional(read_table(spark, folder, "nation"), ["k", "state", "region"])


@query("column_by_position", f"with {BARS} select symbol, date, close as label from bars")
def column_by_position(spark: SparkSession, folder: str) -> DataFrame:
    table = event_bars(spark, folder)
    label = rows.column_by_position(table.drop("symbol", "date"), 3)
    return table.select("symbol", "date", F.col(label).alias("label"))


@query("slice_rows", f"with {INDEXED} select * exclude (row_idx) from indexed where row_idx < 51")
def slice_rows(spark: SparkSession, folder: str) -> DataFrame:
    return rows.slice_rows(event_bars(spark, folder), ["date"], 0, 51, ["symbol"])


@query(
    "strip_thousands",
    "select o_orderkey, cast(round(o_totalprice + 1e-4) as bigint) as amount from orders",
)
def strip_thousands_query(spark: SparkSession, folder: str) -> DataFrame:
    text = F.format_number(F.col("o_totalprice") + 1e-4, 0)
    return read_table(spark, folder, "orders").select(
        "o_orderkey", strip_thousands(text).cast("bigint").alias("amount")
    )


@query(
    "cast_int",
    "select o_orderkey, cast(round(o_totalprice + 1e-4) as integer) as amount from orders",
)
def cast_int(spark: SparkSession, folder: str) -> DataFrame:
    text = F.format_number(F.col("o_totalprice") + 1e-4, 0)
    return read_table(spark, folder, "orders").select("o_orderkey", to_int(text).alias("amount"))


@query(
    "derive_ratio",
    f"select l_orderkey, l_linenumber, {r('l_extendedprice / nullif(l_quantity, 0)')} as unit_price from lineitem",
)
def derive_ratio(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        rounded(ratio("l_extendedprice", "l_quantity")).alias("unit_price"),
    )


@query("filter_threshold", f"with {BARS} select symbol, date, close from bars where close > 30 or close < -30")
def filter_threshold(spark: SparkSession, folder: str) -> DataFrame:
    return rows.filter_threshold(event_bars(spark, folder).select("symbol", "date", "close"), "close", 30.0)


@query(
    "filter_isin",
    "select c_custkey, c_nationkey from customer where c_nationkey in (select s_nationkey from supplier where s_acctbal < 0)",
)
def filter_isin(spark: SparkSession, folder: str) -> DataFrame:
    wanted = read_table(spark, folder, "supplier").filter("s_acctbal < 0")
    customer = read_table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    return rows.filter_isin(customer, wanted.withColumnRenamed("s_nationkey", "c_nationkey"), ["c_nationkey"])


@query(
    "semi_filter",
    "select o_orderkey, o_custkey from orders where o_orderkey in (select l_orderkey from lineitem where l_quantity > 49)",
)
def semi_filter(spark: SparkSession, folder: str) -> DataFrame:
    wanted = read_table(spark, folder, "lineitem").filter("l_quantity > 49")
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return rows.filter_isin(orders, wanted.withColumnRenamed("l_orderkey", "o_orderkey"), ["o_orderkey"])


@query("add_constant", f"with {SURVEY} select k, {r('x1')} as x1, 1e0 as const from st")
def add_constant(spark: SparkSession, folder: str) -> DataFrame:
    return rows.add_constant(supplier_rate(spark, folder).select("k", rounded("x1").alias("x1")))


@query(
    "row_number_display",
    f"with {INDEXED} select row_idx + 1 as row_number, * exclude (row_idx) from indexed",
)
def row_number_display(spark: SparkSession, folder: str) -> DataFrame:
    return rows.row_number_display(event_bars(spark, folder), ["date"], ["symbol"])


@query(
    "page_rows",
    f"with {INDEXED} select row_idx // 5 as page, row_idx % 5 as place, * exclude (row_idx) from indexed",
)
def page_rows(spark: SparkSession, folder: str) -> DataFrame:
    return rows.page_rows(event_bars(spark, folder), ["date"], ["symbol"])


@query("page_after", "select o_orderkey, o_totalprice from orders where o_orderkey > 100 order by o_orderkey limit 5")
def page_after(spark: SparkSession, folder: str) -> DataFrame:
    return rows.page_after(read_table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 100)


@query("show_head", f"with {INDEXED} select symbol, date, close from indexed where row_idx < 5")
def show_head(spark: SparkSession, folder: str) -> DataFrame:
    return rows.show_head(event_bars(spark, folder).select("symbol", "date", "close"), ["date"], ["symbol"])


# --- nulls ----------------------------------------------------------------------------------


def _with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Events with a null type for errors and a null value for small values."""
    return read_table(spark, folder, "events").select(
        "event_id",
        F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.when(F.col("value") >= 10, F.col("value")).alias("value"),
    )


_GAPS = """gaps as (select event_id, nullif(event_type, 'error') as event_type,
  case when value >= 10 then value end as value from events)"""


@query(
    "dropna_thresh",
    f"with {_GAPS} select event_type, value from gaps where event_type is not null or value is not null",
)
def dropna_thresh(spark: SparkSession, folder: str) -> DataFrame:
    return rows.dropna_thresh(_with_gaps(spark, folder).drop("event_id"), 1)


@query("fill_zero", f"with {_GAPS} select event_id, coalesce(value, 0) as value from gaps")
def fill_zero(spark: SparkSession, folder: str) -> DataFrame:
    return rows.fill_zero(_with_gaps(spark, folder).select("event_id", "value"))


@query(
    "skipna_mean",
    f"with {_GAPS} select event_type, {r('avg(value)')} as value from gaps where event_type is not null group by 1",
)
def skipna_mean(spark: SparkSession, folder: str) -> DataFrame:
    means = aggregate.group_mean(_with_gaps(spark, folder), "event_type", ["value"])
    return means.select("event_type", rounded("value").alias("value"))


# --- aggregates -----------------------------------------------------------------------------


@query(
    "group_mean",
    f"with {SURVEY} select k, " + ", ".join(f"{r(y)} as {y}" for y in INDICATORS) + " from v",
)
def group_mean(spark: SparkSession, folder: str) -> DataFrame:
    return survey_means(spark, folder).select("k", *[rounded(y).alias(y) for y in INDICATORS])


@query(
    "group_mean_bars",
    f"with {BARS} select symbol, " + ", ".join(f"{r(f'avg({c})')} as {c}" for c in PRICES) + " from bars group by 1",
)
def group_mean_bars(spark: SparkSession, folder: str) -> DataFrame:
    means = aggregate.group_mean(event_bars(spark, folder), "symbol", PRICE_COLUMNS)
    return means.select("symbol", *[rounded(c).alias(c) for c in PRICE_COLUMNS])


_STATS_SQL = """select symbol, '{c}' as "column", count({c}) as "count", {mean} as mean, {dev} as stddev,
  min({c}) as "min", quantile_disc({c}, 0.25) as p25, quantile_disc({c}, 0.5) as p50,
  quantile_disc({c}, 0.75) as p75, max({c}) as "max" from bars group by 1"""


@query(
    "describe_bars",
    f"with {BARS} "
    + " union all ".join(
        _STATS_SQL.format(c=c, mean=r(f"avg({c})"), dev=r(f"stddev_samp({c})")) for c in PRICES
    ),
)
def describe_bars(spark: SparkSession, folder: str) -> DataFrame:
    table = aggregate.describe_columns(event_bars(spark, folder), ["symbol"], PRICE_COLUMNS)
    return table.withColumns({c: rounded(c) for c in ("mean", "stddev")})


@query("count_by_date", "select cast(ts as date) as date, count(*) as count from events group by 1")
def count_by_date(spark: SparkSession, folder: str) -> DataFrame:
    return aggregate.count_by(read_table(spark, folder, "events"), F.to_date("ts"), "date")


@query(
    "mse",
    f"with {INDEXED}, p as (select *, lag(close) over (partition by symbol order by date) as previous from indexed) "
    f"select symbol, {r('avg((close - previous) * (close - previous))')} as mse from p group by 1",
)
def mse(spark: SparkSession, folder: str) -> DataFrame:
    """Error of the previous close as prediction."""
    lagged = features.lag_window_features(event_bars(spark, folder), ["symbol"], ["date"], "close", lags=1)
    error = aggregate.mse(F.col("close"), F.col("window")[0])
    return lagged.groupBy("symbol").agg(rounded(error).alias("mse"))


def _constant_errors(spark: SparkSession, folder: str) -> DataFrame:
    """Error of three constant predictions of close per symbol: 10, 20 and 30."""
    cases = event_bars(spark, folder).select("symbol", "close", F.explode(F.array(*map(F.lit, (1, 2, 3)))).alias("k"))
    error = aggregate.mse(F.col("close"), F.col("k") * 10.0)
    return cases.groupBy("symbol", "k").agg(F.round(error, 6).alias("mse"))


_CONSTANT_ERRORS = f"""{BARS}, errors as (
  select symbol, k, round(avg((close - k * 1e1) * (close - k * 1e1)), 6) as mse
  from bars, (values (1), (2), (3)) as c(k) group by 1, 2)"""


@query(
    "argmin_k",
    f"with {_CONSTANT_ERRORS} select symbol, k, {r('mse', 4)} as mse from errors "
    "qualify row_number() over (partition by symbol order by mse, k) = 1",
)
def argmin_k(spark: SparkSession, folder: str) -> DataFrame:
    best = aggregate.argmin_first(_constant_errors(spark, folder), ["symbol"], "k", "mse")
    return best.select("symbol", "k", rounded("mse", 4).alias("mse"))


@query(
    "sort_by_error",
    f"with {_CONSTANT_ERRORS} select symbol, k, {r('mse', 4)} as mse, "
    "cast(row_number() over (partition by symbol order by mse, k) as integer) as rank from errors",
)
def sort_by_error(spark: SparkSession, folder: str) -> DataFrame:
    ranked = aggregate.rank_by_error(_constant_errors(spark, folder), ["symbol"], "k", "mse")
    return ranked.select("symbol", "k", rounded("mse", 4).alias("mse"), "rank")


@query(
    "mean_abs_cv_score",
    f"with {BARS}, per_fold as (select symbol, {HOUR} % 5 as fold, -avg((close - 20) * (close - 20)) as score "
    f"from bars group by 1, 2) select symbol, {r('abs(avg(score))')} as cv_error from per_fold group by 1",
)
def mean_abs_cv_score(spark: SparkSession, folder: str) -> DataFrame:
    folds = rows.kfold(event_bars(spark, folder), hour_number(), 5)
    score = -aggregate.mse(F.col("close"), F.lit(20.0))
    scores = aggregate.cv_score(folds.groupBy("symbol", "fold").agg(score.alias("score")), ["symbol"], "score")
    return scores.select("symbol", rounded("cv_error").alias("cv_error"))


@query("row_count", f"with {BARS} select symbol, count(*) as n from bars group by 1")
def row_count(spark: SparkSession, folder: str) -> DataFrame:
    return event_bars(spark, folder).groupBy("symbol").agg(F.count("*").alias("n"))


# --- joins, unions --------------------------------------------------------------------------


@query(
    "positional_concat",
    """with a as (select row_number() over (order by c_custkey) - 1 as row_idx, c_custkey, c_acctbal from customer),
  b as (select row_number() over (order by s_suppkey) - 1 as row_idx, s_suppkey, s_acctbal from supplier)
  select row_idx, c_custkey, c_acctbal, s_suppkey, s_acctbal from a full join b using (row_idx)""",
)
def positional_concat(spark: SparkSession, folder: str) -> DataFrame:
    return joins.positional_concat(
        read_table(spark, folder, "customer").select("c_custkey", "c_acctbal"),
        ["c_custkey"],
        read_table(spark, folder, "supplier").select("s_suppkey", "s_acctbal"),
        ["s_suppkey"],
    )


@query(
    "keyed_state_join",
    f"with {SURVEY} select n_name as state, k, "
    + ", ".join(f"{r(c)} as {c}" for c in [*INDICATORS, "x1", "x2"])
    + " from st join nation on k = n_nationkey",
)
def keyed_state_join(spark: SparkSession, folder: str) -> DataFrame:
    crosswalk = read_table(spark, folder, "nation").select(F.col("n_name").alias("state"), F.col("n_nationkey").alias("k"))
    # one pass over each table; the three parts are joined as separate tables would be
    survey = stage(survey_table(spark, folder), "survey")
    means = survey.join(crosswalk, "k").select("state", *INDICATORS)
    joined = joins.keyed_state_join(means, "state", [survey.select("k", "x1"), survey.select("k", "x2")], crosswalk, "k")
    return joined.select("state", "k", *[rounded(c).alias(c) for c in [*INDICATORS, "x1", "x2"]])


@query(
    "survey_indicators",
    """select o_orderkey, case when o_orderstatus = 'F' then 1e0 else 0e0 end as y1,
  case when o_orderstatus = 'P' then 1e0 else 0e0 end as y2,
  case when o_orderpriority like '1%' then 1e0 else 0e0 end as y3,
  case when o_orderpriority like '2%' then 1e0 else 0e0 end as y4,
  case when o_totalprice > 150000 then 1e0 else 0e0 end as y5 from orders""",
)
def survey_indicators(spark: SparkSession, folder: str) -> DataFrame:
    return order_indicators(spark, folder).drop("o_custkey")


@query(
    "union_all",
    f"with {BARS} select symbol, date, close, {HOUR} % 10 >= 7 as is_test from bars",
)
def union_all(spark: SparkSession, folder: str) -> DataFrame:
    parts = rows.split_holdout(event_bars(spark, folder).select("symbol", "date", "close"), hour_number() % 10)
    return joins.union_all(parts.filter(~F.col("is_test")), parts.filter("is_test"))


@query("sorted_output", f"with {BARS} select symbol, {r('avg(close)')} as close from bars group by 1 order by 1")
def sorted_output(spark: SparkSession, folder: str) -> DataFrame:
    means = event_bars(spark, folder).groupBy("symbol").agg(rounded(F.avg("close")).alias("close"))
    return means.orderBy("symbol")


# --- splits, scaling, lag windows -----------------------------------------------------------


@query(
    "split_random",
    """with hashed as (select event_id, event_type, ('0x' || substr(md5('42:' || event_id), 1, 12))::bigint as h from events)
 select event_id, event_type, row_number() over (partition by event_type order by h, event_id)
   <= ceil(3e-1 * count(*) over (partition by event_type)) as is_test from hashed""",
)
def split_random(spark: SparkSession, folder: str) -> DataFrame:
    """Three tenths of the events of every type, drawn by a hash of their id."""
    return rows.split_exact(read_table(spark, folder, "events").select("event_id", "event_type"), ["event_id"], 0.3, ["event_type"])


@query("split_holdout", f"with {BARS} select symbol, date, {HOUR} % 10 >= 7 as is_test from bars")
def split_holdout(spark: SparkSession, folder: str) -> DataFrame:
    return rows.split_holdout(event_bars(spark, folder).select("symbol", "date"), hour_number() % 10)


@query("split_temporal", f"with {PARTED} select symbol, date, close, row_idx, is_test from parted")
def split_temporal(spark: SparkSession, folder: str) -> DataFrame:
    parts = features.split_temporal(event_bars(spark, folder).select("symbol", "date", "close"), ["symbol"], ["date"])
    return parts.select("symbol", "date", "close", "row_idx", "is_test")


@query("kfold", "select event_id, cast(event_id % 5 as integer) as fold from events")
def kfold(spark: SparkSession, folder: str) -> DataFrame:
    return rows.kfold(read_table(spark, folder, "events").select("event_id"), F.col("event_id"))


_SCALED = f"""{BARS}, fit as (
  select symbol, {", ".join(f"min({c}) as {c}__lo, max({c}) as {c}__hi" for c in PRICES)}
  from bars where {HOUR} % 10 < 7 group by 1),
 scaled as (select symbol, date, {", ".join(
     f"coalesce(({c} - {c}__lo) / nullif({c}__hi - {c}__lo, 0), 0) as {c}_scaled, {c}__lo, {c}__hi" for c in PRICES)}
  from bars join fit using (symbol))"""


def _scaled(spark: SparkSession, folder: str) -> DataFrame:
    table = event_bars(spark, folder)
    fit = features.fit_minmax(table, ["symbol"], PRICE_COLUMNS, where=hour_number() % 10 < 7)
    return features.apply_minmax(table, fit, ["symbol"], PRICE_COLUMNS)


@query(
    "minmax_scale",
    f"with {_SCALED} select symbol, date, " + ", ".join(f"{r(c + '_scaled')} as {c}_scaled" for c in PRICES) + " from scaled",
)
def minmax_scale(spark: SparkSession, folder: str) -> DataFrame:
    return _scaled(spark, folder).select("symbol", "date", *[rounded(f"{c}_scaled").alias(f"{c}_scaled") for c in PRICES])


@query(
    "minmax_inverse",
    f"with {_SCALED} select symbol, date, "
    + ", ".join(f"{r(f'{c}_scaled * ({c}__hi - {c}__lo) + {c}__lo', 4)} as {c}_restored" for c in PRICES)
    + " from scaled",
)
def minmax_inverse(spark: SparkSession, folder: str) -> DataFrame:
    restored = features.invert_minmax(_scaled(spark, folder), PRICE_COLUMNS)
    return restored.select("symbol", "date", *[rounded(f"{c}_restored", 4).alias(f"{c}_restored") for c in PRICES])


def _window_columns(column: str = "window", lags: int = 60) -> list[Column]:
    return [F.col(column)[i].alias(f"lag_{lags - i}") for i in range(lags)]


def _lag_sql(lags: int = 60) -> str:
    return ", ".join(f"lag(close, {n}) over w as lag_{n}" for n in range(1, lags + 1))


@query(
    "lag_window_features",
    f"with {INDEXED}, lagged as (select symbol, date, close, row_idx, {_lag_sql()} from indexed "
    "window w as (partition by symbol order by date)) select * exclude (row_idx) from lagged where row_idx >= 60",
)
def lag_window_features(spark: SparkSession, folder: str) -> DataFrame:
    lagged = features.lag_window_features(event_bars(spark, folder), ["symbol"], ["date"], "close")
    return lagged.select("symbol", "date", "close", *_window_columns())


@query(
    "tail_with_context",
    f"with {PARTED}, lagged as (select symbol, date, close, row_idx, first_test, {_lag_sql()} from parted "
    "window w as (partition by symbol order by date)) select * exclude (row_idx, first_test) from lagged "
    "where row_idx >= greatest(first_test, 60) and row_idx < first_test + 20",
)
def tail_with_context(spark: SparkSession, folder: str) -> DataFrame:
    tail = features.tail_with_context(event_bars(spark, folder), ["symbol"], ["date"], "close")
    return tail.select("symbol", "date", "close", *_window_columns())


@query("assemble", f"with {BARS} select symbol, date, open, high, low, volume, 4 as width from bars")
def assemble(spark: SparkSession, folder: str) -> DataFrame:
    """The four features as one vector, shown as columns again."""
    names = ["open", "high", "low", "volume"]
    table = features.assemble(event_bars(spark, folder), names)
    values = table.select("symbol", "date", vector_to_array("features").alias("v"))
    return values.select("symbol", "date", *[F.col("v")[i].alias(c) for i, c in enumerate(names)], F.size("v").alias("width"))


# --- scalar functions -----------------------------------------------------------------------


@query(
    "scalar_text",
    r"""select page_id, coalesce(list_extract(regexp_extract_all(url, '[^/.](\.[^./]*)$', 1), 1), '') as extension,
  trim(split_part(url, '/', 3)) as host, len(string_split(url, '/')) as parts,
  concat(rpad('page', 25, ' '), ': ', url) as line, decode(encode(html)) as decoded, trim(url, 'htps:/') as bare from pages""",
)
def scalar_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = read_table(spark, folder, "pages")
    parts = F.split("url", "/", -1)
    return pages.select(
        "page_id",
        file_extension("url").alias("extension"),
        F.coalesce(F.trim(F.get(parts, F.lit(2))), F.lit("")).alias("host"),
        F.size(parts).cast("bigint").alias("parts"),
        padded_tag(F.lit("page"), F.col("url")).alias("line"),
        F.decode(F.encode("html", "UTF-8"), "UTF-8").alias("decoded"),
        F.btrim("url", F.lit("htps:/")).alias("bare"),
    )


@query(
    "scalar_time",
    "select event_id, strftime(ts, '%d/%m/%Y %H:%M:%S') as shown, event_id // 7 as whole, event_id % 7 as rest, "
    f"{r('pow(1e1, event_id % 5)')} as power, abs(value - 20) as distance from events",
)
def scalar_time(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "events").select(
        "event_id",
        day_month_year("ts").alias("shown"),
        F.expr("event_id div 7").alias("whole"),
        (F.col("event_id") % 7).alias("rest"),
        rounded(F.pow(F.lit(10.0), F.col("event_id") % 5)).alias("power"),
        F.abs(F.col("value") - 20).alias("distance"),
    )
