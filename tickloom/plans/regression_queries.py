"""Simple regression, outliers and smoothing, on the survey table and on whole line items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.functions.values import rounded
from tickloom.operators import lowess, ols
from tickloom.plans.checking_sql import PAIRS, r
from tickloom.plans.registry import query
from tickloom.session import stage
from tickloom.sources.tables import fit_pairs, read_table, survey_table

SPANS = (1 / 3, 2 / 3, 1 / 5)
SUMMARY = [
    "n", "slope", "intercept", "se_slope", "se_intercept", "t_slope", "t_intercept", "r2", "adj_r2",
    "f_value", "log_likelihood", "aic", "bic", "skew", "kurtosis", "jarque_bera", "prob_jarque_bera",
    "omnibus", "prob_omnibus", "durbin_watson", "condition_number",
]


# The checking SQL is written out by itself and takes other routes than the operators where there are any.


def _fit_sql(rows: str, keys: str) -> str:
    return (
        f"(select {keys}, count(*) as n, regr_slope(y, x) as slope, regr_intercept(y, x) as intercept, "
        f"regr_r2(y, x) as r2 from {rows} group by all)"
    )


def survey_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """The long table of all ten cases; staged, as fit and residual passes both read it."""
    return stage(fit_pairs(survey_table(spark, folder)), "survey-pairs")


def line_items(spark: SparkSession, folder: str) -> DataFrame:
    """Extended price against quantity, one case per return flag, over the whole table."""
    return read_table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("pair"),
        "l_orderkey",
        "l_linenumber",
        F.col("l_quantity").alias("x"),
        F.col("l_extendedprice").alias("y"),
    )


_LINES = """lines as (select l_returnflag as pair, l_orderkey, l_linenumber, l_quantity as x,
  l_extendedprice as y, l_tax from lineitem)"""
_FITTED = f"with {PAIRS}, fit as (select * from {_fit_sql('pairs', 'pair')} s)"
_LINE_FITTED = f"with {_LINES}, fit as (select * from {_fit_sql('lines', 'pair')} s)"


@query("fit_pairs", f"with {PAIRS} select pair, row_key, {r('x')} as x, {r('y')} as y from pairs")
def pairs(spark: SparkSession, folder: str) -> DataFrame:
    table = fit_pairs(survey_table(spark, folder))
    return table.select("pair", "row_key", rounded("x").alias("x"), rounded("y").alias("y"))


@query("ols_fit", f"{_FITTED} select pair, n, {r('slope')} as slope, {r('intercept')} as intercept, {r('r2')} as r2 from fit")
def ols_fit(spark: SparkSession, folder: str) -> DataFrame:
    fit = ols.ols_fit(fit_pairs(survey_table(spark, folder)), ["pair"])
    return fit.select("pair", "n", *[rounded(c).alias(c) for c in ("slope", "intercept", "r2")])


@query(
    "ols_fit_lineitem",
    f"{_LINE_FITTED} select pair, n, {r('slope', 4)} as slope, {r('intercept', 4)} as intercept, {r('r2')} as r2 from fit",
)
def ols_fit_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    fit = ols.ols_fit(line_items(spark, folder), ["pair"])
    return fit.select(
        "pair", "n", rounded("slope", 4).alias("slope"), rounded("intercept", 4).alias("intercept"), rounded("r2").alias("r2")
    )


# errors by the textbook forms from raw sums; condition number from the eigenvalues of [[n, Sx], [Sx, Sxx]]
_SUMMARY_SQL = """, e as (
  select pair, row_key, x, y, y - (intercept + slope * x) as e from pairs join fit using (pair)),
 steps as (select pair, sum(power(d, 2)) as steps from (
   select pair, e - lag(e) over (partition by pair order by row_key) as d from e) q group by 1),
 s as (
  select pair, count(*) as cases, sum(x) as sx, sum(x * x) as sx2, var_pop(x) * count(*) as dx, var_pop(y) * count(*) as dy,
    sum(e * e) as ss, sqrt(count(*)) * sum(power(e, 3)) / power(sum(e * e), 15e-1) as skew,
    count(*) * sum(power(e, 4)) / power(sum(e * e), 2) as kurtosis from e group by 1),
 a as (
  select *, sqrt(ss / (n - 2) / dx) as se_slope, sqrt(ss / (n - 2) / dx) * sqrt(sx2 / n) as se_intercept,
    1 - (ss / (n - 2)) / (dy / (n - 1)) as adj_r2, (dy - ss) / (ss / (n - 2)) as f_value,
    -n / 2e0 * ln(2 * pi()) - n / 2e0 * ln(ss / n) - n / 2e0 as log_likelihood, steps / ss as durbin_watson,
    n + sx2 as diagonal, sqrt(power(n - sx2, 2) + 4 * sx * sx) as apart
  from fit join s using (pair) join steps using (pair)),
 k as (
  select *, slope / se_slope as t_slope, intercept / se_intercept as t_intercept,
    2 * 2 - 2 * log_likelihood as aic, 2 * ln(n) - 2 * log_likelihood as bic,
    sqrt((diagonal + apart) / (diagonal - apart)) as condition_number,
    n * (power(skew, 2) / 6 + power(kurtosis - 3, 2) / 24) as jarque_bera,
    -- skewness test: normal score through an inverse hyperbolic sine
    sqrt(-1 + sqrt(2 * (3e0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2e0) * (n + 5) * (n + 7) * (n + 9)) - 1))) as w,
    skew * sqrt((n + 1e0) * (n + 3) / (6e0 * (n - 2))) as score,
    -- kurtosis test: normal score through a cube root of a chi-squared with ``free`` degrees of freedom
    (kurtosis - 3e0 * (n - 1) / (n + 1)) / sqrt(24e0 * n * (n - 2) * (n - 3) / (power(n + 1e0, 2) * (n + 3) * (n + 5))) as excess,
    6e0 * (n * n - 5 * n + 2) / ((n + 7e0) * (n + 9)) * sqrt(6e0 * (n + 3) * (n + 5) / (n * (n - 2e0) * (n - 3))) as beta
  from a),
 z as (
  select *, asinh(score * sqrt((w * w - 1) / 2)) / sqrt(ln(w)) as z1, 6 + 8 / beta * (2 / beta + sqrt(1 + 4 / power(beta, 2))) as free from k),
 tested as (
  select *, exp(-jarque_bera / 2) as prob_jarque_bera, exp(-omnibus / 2) as prob_omnibus from (
   select *, z1 * z1 + power((1 - 2 / (9 * free) - cbrt((1 - 2 / free) / (1 + excess * sqrt(2 / (free - 4))))) * sqrt(9 * free / 2), 2) as omnibus from z) q)"""


@query(
    "ols_summary",
    f"{_FITTED}{_SUMMARY_SQL} select pair, n, " + ", ".join(f"{r(c, 4)} as {c}" for c in SUMMARY[1:]) + " from tested",
)
def ols_summary(spark: SparkSession, folder: str) -> DataFrame:
    rows = survey_pairs(spark, folder)
    table = ols.ols_summary(rows, ols.ols_fit(rows, ["pair"]), ["pair"], ["row_key"])
    return table.select("pair", "n", *[rounded(c, 4).alias(c) for c in SUMMARY[1:]])


def _p_value_sql(t: str, odd: str, even: str) -> str:
    """Two-sided p-value of Student's t by its finite series, from the sums over the cosine powers."""
    angle, sine = f"atan({t} / sqrt(df))", f"{t} / sqrt(df + {t} * {t})"
    odd_form = f"2 / pi() * (abs({angle}) + abs({sine}) * {odd})"
    return f"1 - case when df % 2 = 1 then {odd_form} else abs({sine}) * {even} end"


def _series(t: str, kind: str) -> str:
    power = "2 * j + 1" if kind == "odd" else "2 * j"
    last = "(df - 3) / 2e0" if kind == "odd" else "(df - 2) / 2e0"
    return f"coalesce(sum(case when j <= {last} then {kind}_weight * pow(sqrt(df / (df + {t} * {t})), {power}) end), 0)"


_P_SERIES = f"""weights as (
   select j, exp(sum(case when j = 0 then 0 else ln(2e0 * j / (2 * j + 1)) end) over (order by j)) as odd_weight,
     exp(sum(case when j = 0 then 0 else ln((2e0 * j - 1) / (2 * j)) end) over (order by j)) as even_weight
   from generate_series(0, 200) as g(j)),
 series as (select pair, df, t_slope, t_intercept,
   {_series('t_slope', 'odd')} as odd_slope, {_series('t_slope', 'even')} as even_slope,
   {_series('t_intercept', 'odd')} as odd_intercept, {_series('t_intercept', 'even')} as even_intercept
   from (select pair, n - 2 as df, t_slope, t_intercept from k) f, weights group by all)"""


@query(
    "ols_p_values",
    f"{_FITTED}{_SUMMARY_SQL}, {_P_SERIES} select pair, df, {r(_p_value_sql('t_slope', 'odd_slope', 'even_slope'))} as p_slope, "
    f"{r(_p_value_sql('t_intercept', 'odd_intercept', 'even_intercept'))} as p_intercept from series",
)
def ols_p_values(spark: SparkSession, folder: str) -> DataFrame:
    table = ols.ols_inference(ols.ols_fit(fit_pairs(survey_table(spark, folder)), ["pair"]), ["pair"])
    return table.select("pair", "df", rounded("p_slope").alias("p_slope"), rounded("p_intercept").alias("p_intercept"))


@query("ols_inference")
def ols_inference(spark: SparkSession, folder: str) -> DataFrame:
    """p-values and 95 % limits; the limits are checked in the tests."""
    return ols.ols_inference(ols.ols_fit(fit_pairs(survey_table(spark, folder)), ["pair"]), ["pair"])


@query(
    "ols_predict",
    f"{_FITTED} select pair, row_key, {r('intercept + slope * x')} as fitted, "
    f"{r('y - (intercept + slope * x)')} as residual from pairs join fit using (pair)",
)
def ols_predict(spark: SparkSession, folder: str) -> DataFrame:
    rows = survey_pairs(spark, folder)
    table = ols.ols_predict(rows, ols.ols_fit(rows, ["pair"]), ["pair"])
    return table.select("pair", "row_key", rounded("fitted").alias("fitted"), rounded("residual").alias("residual"))


def _left_out_sql(rows: str) -> str:
    """``t`` of every row by fitting the line without it: its sums are the whole sums less its own, about the means."""
    return f"""(
  select *, gap / sqrt(left_sse / (m - 2) * (1 + 1e0 / m + power(u - left_u, 2) / left_uu)) as t from (
   select *, (v - left_v) - left_uv / left_uu * (u - left_u) as gap, left_vv - left_uv * left_uv / left_uu as left_sse from (
    select *, -u / m as left_u, -v / m as left_v, suu - u * u - u * u / m as left_uu,
      svv - v * v - v * v / m as left_vv, suv - u * v - u * v / m as left_uv
    from (select d.*, c.n - 1 as m, x - mx as u, y - my as v, suu, svv, suv from {rows} d join (
      select pair, count(*) as n, avg(x) as mx, avg(y) as my, regr_sxx(y, x) as suu, regr_syy(y, x) as svv, regr_sxy(y, x) as suv
      from {rows} group by 1) c using (pair)) a) b) e)"""


@query("studentized_residuals", f"with {PAIRS} select pair, row_key, {r('t')} as t from {_left_out_sql('pairs')} s")
def studentized_residuals(spark: SparkSession, folder: str) -> DataFrame:
    rows = survey_pairs(spark, folder)
    table = ols.studentized_residuals(rows, ols.ols_fit(rows, ["pair"]), ["pair"])
    return table.select("pair", "row_key", rounded("t").alias("t"))


@query(
    "studentized_outliers",
    f"with {PAIRS} select pair, row_key, {r('x')} as x, {r('y')} as y, {r('t')} as t from {_left_out_sql('pairs')} s where abs(t) > 3",
)
def studentized_outliers(spark: SparkSession, folder: str) -> DataFrame:
    rows = survey_pairs(spark, folder)
    table = ols.studentized_outliers(rows, ols.ols_fit(rows, ["pair"]), ["pair"])
    return table.select("pair", "row_key", *[rounded(c).alias(c) for c in ("x", "y", "t")])


@query(
    "studentized_outliers_lineitem",
    f"""with {_LINES}, taxed as (select pair, l_orderkey, l_linenumber, x, y * l_tax as y from lines)
 select pair, l_orderkey, l_linenumber, {r('t', 4)} as t from {_left_out_sql('taxed')} s where abs(t) > 3""",
)
def studentized_outliers_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    """Line items whose tax amount lies far off the line over quantity; about one in two hundred does."""
    rows = read_table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("pair"),
        "l_orderkey",
        "l_linenumber",
        F.col("l_quantity").alias("x"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("y"),
    )
    fit = stage(ols.ols_fit(rows, ["pair"]), "line-fit")
    table = ols.studentized_outliers(rows, fit, ["pair"])
    return table.select("pair", "l_orderkey", "l_linenumber", rounded("t", 4).alias("t"))


def _lowess_sql(rows: str, spans: tuple[float, ...], ident: str, iterations: int = 3) -> str:
    """LOWESS written out pass by pass; anchors are the distinct x of a case.

    ``ident`` names the columns that identify a row of ``rows`` besides ``pair``.
    """
    span_values = ", ".join(f"(cast({s!r} as double))" for s in spans)
    parts = [
        f"spans(frac) as (values {span_values})",
        f"""base as materialized (select pair, {ident}, frac, x, y from {rows}, spans)""",
        f"""points as materialized (select pair, frac, x, count(*) as n from base group by 1, 2, 3)""",
        """need as (select pair, frac, cast(floor(frac * sum(n) + 1e-10) as bigint) as k from points group by 1, 2)""",
        """reach as materialized (
  select pair, frac, anchor, min(d) as h from (
    select a.pair, a.frac, a.x as anchor, abs(b.x - a.x) as d,
      sum(b.n) over (partition by a.pair, a.frac, a.x order by abs(b.x - a.x)) as seen
    from points a join points b using (pair, frac)) q join need using (pair, frac)
  where seen >= k group by 1, 2, 3)""",
        """near as materialized (
  select r.pair, r.frac, anchor, b.x, b.x - anchor as dx,
    case when abs(b.x - anchor) <= 1e-3 * h then 1e0
         else pow(1e0 - pow(abs(b.x - anchor) / h, 3), 3) end as w
  from reach r join points b using (pair, frac) where abs(b.x - anchor) <= 999e-3 * h or b.x = anchor)""",
    ]
    parts.append(f"robust0 as (select pair, frac, {ident}, x, y, 1e0 as rw from base)")
    for p in range(iterations + 1):
        parts.append(f"""fit{p} as materialized (
  select pair, frac, anchor as x,
    case when s0 * s2 - s1 * s1 > 1e-12 * s0 * s2 then (s2 * t0 - s1 * t1) / (s0 * s2 - s1 * s1) else t0 / s0 end as fitted
  from (select pair, frac, anchor, sum(w * rw) as s0, sum(w * rw * dx) as s1, sum(w * rw * dx * dx) as s2,
          sum(w * rwy) as t0, sum(w * rwy * dx) as t1
        from near join (select pair, frac, x, sum(rw) as rw, sum(rw * y) as rwy from robust{p} group by 1, 2, 3) v
          using (pair, frac, x) group by 1, 2, 3) s)""")
        if p < iterations:
            parts.append(f"""error{p} as materialized (
  select pair, frac, {ident}, x, y, abs(y - fitted) as e from base join fit{p} using (pair, frac, x))""")
            parts.append(f"""scale{p} as (select pair, frac, 6 * median(e) as s from error{p} group by 1, 2)""")
            parts.append(f"""robust{p + 1} as (
  select pair, frac, {ident}, x, y, case when e / s > 999e-3 then 0e0 when e / s < 1e-3 then 1e0
    else pow(1 - (e / s) * (e / s), 2) end as rw from error{p} join scale{p} using (pair, frac))""")
    return ", ".join(parts)


_LOWESS = f"with {PAIRS}, {_lowess_sql('pairs', SPANS, 'row_key')}"


def _smoothed(spark: SparkSession, folder: str) -> DataFrame:
    return lowess.lowess_smooth(survey_pairs(spark, folder), ["pair"], SPANS)


@query(
    "lowess_smooth",
    f"{_LOWESS} select pair, row_key, {r('frac')} as frac, {r('x')} as x, {r('fitted')} as fitted "
    "from base join fit3 using (pair, frac, x)",
)
def lowess_smooth(spark: SparkSession, folder: str) -> DataFrame:
    table = _smoothed(spark, folder).select(
        "pair", "row_key", *[rounded(c).alias(c) for c in ("frac", "x", "fitted")]
    )
    return table.orderBy("pair", "frac", "x", "row_key")


@query(
    "lowess_lineitem",
    f"with {_LINES}, {_lowess_sql('lines', (1 / 3,), 'l_orderkey, l_linenumber')} "
    f"select pair, x, {r('fitted', 4)} as fitted, n from points join fit3 using (pair, frac, x)",
)
def lowess_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    """Smooths every line item; shown once per distinct quantity."""
    smooth = lowess.lowess_smooth(line_items(spark, folder), ["pair"], (1 / 3,))
    return smooth.groupBy("pair", "x").agg(
        rounded(F.min("fitted"), 4).alias("fitted"), F.count("*").alias("n")
    )


_ORDERS = "lines as (select o_orderstatus as pair, o_orderkey, epoch(o_orderdate) + o_orderkey % 86400 as x, o_totalprice as y from orders)"


@query(
    "lowess_orders",
    f"with {_ORDERS}, {_lowess_sql('lines', (1 / 3,), 'o_orderkey')} "
    f"select pair, o_orderkey, x, {r('fitted', 2)} as fitted from base join fit3 using (pair, frac, x)",
)
def lowess_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Total price against time for every order, nearly all with their own x."""
    orders = read_table(spark, folder, "orders").select(
        F.col("o_orderstatus").alias("pair"),
        "o_orderkey",
        F.unix_seconds(F.col("o_orderdate").cast("timestamp")).cast("double").alias("seconds"),
        F.col("o_totalprice").alias("y"),
    )
    # the order key spreads the orders of one day over that day
    rows = orders.withColumn("x", F.col("seconds") + F.col("o_orderkey") % 86400).drop("seconds")
    smooth = lowess.lowess_smooth(rows, ["pair"], (1 / 3,))
    return smooth.select("pair", "o_orderkey", "x", rounded("fitted", 2).alias("fitted"))


@query(
    "scatter_series",
    f"""{_LOWESS}, fit as (select * from {_fit_sql('pairs', 'pair')} s)
 select pair, 'points' as series, {r('x')} as x, {r('y')} as y from pairs
 union all select pair, 'line', {r('x')}, {r('intercept + slope * x')} from pairs join fit using (pair)
 union all select pair, case when frac > 5e-1 then 'lowess 2/3' else 'lowess 1/3' end, {r('x')}, {r('fitted')}
   from base join fit3 using (pair, frac, x) where frac > 3e-1""",
)
def scatter_series(spark: SparkSession, folder: str) -> DataFrame:
    rows = survey_pairs(spark, folder)
    line = ols.ols_predict(rows, ols.ols_fit(rows, ["pair"]), ["pair"])
    smooth = stage(lowess.lowess_smooth(rows, ["pair"], SPANS[:2]), "curves")
    curves = [
        ("line", line),
        ("lowess 1/3", smooth.filter(F.col("frac") < 0.5)),
        ("lowess 2/3", smooth.filter(F.col("frac") > 0.5)),
    ]
    table = ols.scatter_series(rows, curves, ["pair"])
    return table.select("pair", "series", rounded("x").alias("x"), rounded("y").alias("y"))
