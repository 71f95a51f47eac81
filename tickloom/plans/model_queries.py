"""Regressors of the closing price, fitted per symbol on the bars by the minute."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.functions.values import rounded
from tickloom.operators import aggregate, features, knn, linear, rows, trees
from tickloom.operators.reservoir import Reservoir
from tickloom.operators.skew import attach
from tickloom.plans.checking_sql import MINUTE, MINUTE_BARS, MINUTE_PARTED, r
from tickloom.plans.file_queries import event_stream
from tickloom.plans.registry import query
from tickloom.session import stage
from tickloom.sources.tables import PRICE_COLUMNS, minute_bars, minute_number
from tickloom.streaming.bars import count_by_date

FEATURES = ["open", "high", "low", "volume"]
NEIGHBOURS = 3


def split_bars(spark: SparkSession, folder: str) -> DataFrame:
    """Bars with the 30 % hold-out mark; written once, as every model reads them repeatedly."""
    return stage(rows.split_holdout(minute_bars(spark, folder), minute_number() % 10), "bars")


# --- nearest neighbours ---------------------------------------------------------------------

_RANGES = ", ".join(
    f"case when max({f}) > min({f}) then max({f}) - min({f}) else 1e0 end as {f}_range" for f in FEATURES
)
_DISTANCE = " + ".join(f"((q.{f} - t.{f}) / {f}_range) * ((q.{f} - t.{f}) / {f}_range)" for f in FEATURES)


def _neighbour_sql(train: str, asked: str) -> str:
    return f"""ranges as (select symbol, {_RANGES} from {train} group by 1),
 nearest as materialized (
  select q.symbol, q.date, q.close, t.close as label,
    row_number() over (partition by q.symbol, q.date order by {_DISTANCE}, t.date) as rank
  from {asked} q join {train} t using (symbol) join ranges using (symbol) qualify rank <= {NEIGHBOURS}),
 predicted as (
  select symbol, date, close, k, avg(label) filter (where rank <= k) as pred
  from nearest, (values (1), (2), (3)) as ks(k) group by 1, 2, 3, 4)"""


_PARTS = f"""{MINUTE_BARS}, train as materialized (select * from bars where {MINUTE} % 10 < 7),
 test as materialized (select * from bars where {MINUTE} % 10 >= 7),
 fitting as materialized (select * from train where {MINUTE} % 10 < 5),
 validation as materialized (select * from train where {MINUTE} % 10 >= 5)"""


def _predicted(train: DataFrame, asked: DataFrame) -> DataFrame:
    return knn.knn_predict(train, asked, ["symbol"], FEATURES, "date", "close", NEIGHBOURS)


@query(
    "knn_regress",
    f"with {_PARTS}, {_neighbour_sql('train', 'test')} "
    f"select symbol, date, {r('close')} as close, {r('pred')} as prediction from predicted where k = {NEIGHBOURS}",
)
def knn_regress(spark: SparkSession, folder: str) -> DataFrame:
    parts = split_bars(spark, folder)
    table = _predicted(parts.filter(~F.col("is_test")), parts.filter("is_test"))
    return table.select(
        "symbol", "date", rounded("close").alias("close"), rounded(f"pred_{NEIGHBOURS}").alias("prediction")
    )


@query(
    "nearest_neighbour_join",
    f"""with {_PARTS}, ranges as (select symbol, {_RANGES} from train group by 1)
 select q.symbol, q.date, t.date as neighbour, {r('t.close')} as label, {r(_DISTANCE)} as distance_sq,
   cast(row_number() over (partition by q.symbol, q.date order by {_DISTANCE}, t.date) as integer) as rank
 from test q join train t using (symbol) join ranges using (symbol) qualify rank <= {NEIGHBOURS}""",
)
def nearest_neighbour_join(spark: SparkSession, folder: str) -> DataFrame:
    """The three nearest training bars of every test bar."""
    parts = split_bars(spark, folder)
    test = parts.filter("is_test")
    hits = knn.nearest_neighbours(
        parts.filter(~F.col("is_test")), test, ["symbol"], FEATURES, "date", "close", NEIGHBOURS
    ).withColumnRenamed("id", "neighbour")
    return attach(test.select("symbol", "date", *FEATURES), hits, ["symbol", *FEATURES], salts=1).select(
        "symbol", "date", "neighbour", rounded("label").alias("label"), rounded("d2").alias("distance_sq"), "rank"
    )


@query(
    "knn_errors",
    f"with {_PARTS}, {_neighbour_sql('train', 'test')} select symbol, k, {r('avg((close - pred) * (close - pred))', 4)} as mse "
    "from predicted group by 1, 2",
)
def knn_errors(spark: SparkSession, folder: str) -> DataFrame:
    """Test error of every neighbour count."""
    parts = split_bars(spark, folder)
    table = _predicted(parts.filter(~F.col("is_test")), parts.filter("is_test"))
    return knn.knn_errors(table, ["symbol"], "close", NEIGHBOURS).select("symbol", "k", rounded("mse", 4).alias("mse"))


@query(
    "knn_select_k",
    f"""with {_PARTS}, test_errors as (select * from (with {_neighbour_sql('train', 'test')}
   select symbol, k, avg((close - pred) * (close - pred)) as mse from predicted group by 1, 2)),
 validation_errors as (select * from (with {_neighbour_sql('fitting', 'validation')}
   select symbol, k, avg((close - pred) * (close - pred)) as mse from predicted group by 1, 2)),
 chosen as (select symbol, 'validation' as chosen_on, k from validation_errors
   qualify row_number() over (partition by symbol order by mse, k) = 1
   union all select symbol, 'test', k from test_errors
   qualify row_number() over (partition by symbol order by mse, k) = 1)
 select symbol, chosen_on, k, {r('mse', 4)} as test_mse from chosen join test_errors using (symbol, k)""",
)
def knn_select_k(spark: SparkSession, folder: str) -> DataFrame:
    """Neighbour count with the least error, chosen on a validation part or on the test part."""
    return knn_choice(split_bars(spark, folder)).select(
        "symbol", "chosen_on", "k", rounded("test_mse", 4).alias("test_mse")
    )


def knn_choice(parts: DataFrame, predicted: DataFrame | None = None) -> DataFrame:
    """``predicted`` are the test bars with the predictions from all training bars, where these are at hand."""
    train, test = parts.filter(~F.col("is_test")), parts.filter("is_test")
    in_fitting = minute_number() % 10 < 5
    predicted = _predicted(train, test) if predicted is None else predicted
    on_test = stage(knn.knn_errors(predicted, ["symbol"], "close", NEIGHBOURS), "knn-errors")
    on_validation = knn.knn_errors(
        _predicted(train.filter(in_fitting), train.filter(~in_fitting)), ["symbol"], "close", NEIGHBOURS
    )
    chosen = None
    for name, errors in (("validation", on_validation), ("test", on_test)):
        best = aggregate.argmin_first(errors, ["symbol"], "k", "mse").select("symbol", F.lit(name).alias("chosen_on"), "k")
        chosen = best if chosen is None else chosen.unionByName(best)
    return chosen.join(on_test.withColumnRenamed("mse", "test_mse"), ["symbol", "k"])


# --- linear models, components, sequence ----------------------------------------------------


def _rounded_metrics(metrics: DataFrame, digits: int = 4) -> DataFrame:
    return metrics.select("symbol", "model", "metric", "param", rounded("value", digits).alias("value"))


_COLUMNS = [*FEATURES, "close"]
_NO_HELD = -1


def _descent_sql(train: str, keys: str, penalty: str, mix: float, rounds: int = 3000) -> str:
    """Coordinate descent written as a recursive query; ``train`` has the key columns and the bars' columns."""
    p = len(FEATURES)
    size = range(1, p + 2)
    moments = ", ".join(
        [f"avg({c}) as m{i}" for i, c in enumerate(_COLUMNS, 1)]
        + [f"covar_pop({_COLUMNS[i - 1]}, {_COLUMNS[j - 1]}) as c{i}_{j}" for i in size for j in size if i <= j]
    )

    def c(i: int, j: int) -> str:
        return f"c{min(i, j)}_{max(i, j)}"

    unit = ", ".join(
        [f"{c(i, j)} / sqrt({c(i, i)} * {c(j, j)}) as a{i}_{j}" for i in size for j in size if i != j]
        + [f"sqrt({c(i, i)}) as s{i}" for i in size]
    )
    source = "(select * from descent join unit using (" + keys + ") where step < " + str(rounds) + ")"
    for i in range(1, p + 1):
        others = " - ".join(f"a{i}_{j} * {'n' if j < i else 'b'}{j}" for j in range(1, p + 1) if j != i)
        pull = f"(a{i}_{p + 1} - {others})"
        source = (
            f"(select *, sign({pull}) * greatest(abs({pull}) - {penalty} * {mix!r}::double / s{p + 1}, 0) "
            f"/ (1 + {penalty} * {1 - mix!r}::double / s{p + 1}) as n{i} from {source} q{i})"
        )
    new = ", ".join(f"n{i} as b{i}" for i in range(1, p + 1))
    slopes = ", ".join(f"b{i} * s{p + 1} / s{i} as w{i}" for i in range(1, p + 1))
    return f"""moments as materialized (select {keys}, count(*) as n, {moments} from {train} group by all),
 unit as materialized (select *, {unit} from moments),
 descent as (select {keys}, 0 as step, {", ".join(f"0e0 as b{i}" for i in range(1, p + 1))} from unit
   union all select {keys}, step + 1, {new} from {source} q),
 slopes as (select {keys}, m1, m2, m3, m4, m5, {slopes} from descent join unit using ({keys}) where step = {rounds}),
 line as materialized (select *, m5 - {" - ".join(f"w{i} * m{i}" for i in range(1, p + 1))} as w0 from slopes)"""


_ERROR = f"(close - w0 - {' - '.join(f'w{i} * {f}' for i, f in enumerate(FEATURES, 1))})"
_MARKED = f"""{MINUTE_BARS}, marked as materialized (
  select *, {MINUTE} % 10 >= 7 as is_test, ({MINUTE} // 10) % 5 as fold from bars)"""


def _line_rows_sql(model: str, line: str, train: str, test: str) -> str:
    """Metric rows of a fitted line per symbol."""
    parts = [
        f"select symbol, '{model}' as model, 'coefficient' as metric, '{f}' as param, {r(f'w{i}', 4)} as value from {line}"
        for i, f in enumerate(FEATURES, 1)
    ]
    parts.append(f"select symbol, '{model}', 'intercept', '', {r('w0', 4)} from {line}")
    parts.append(f"select symbol, '{model}', 'train_mse', '', {r(f'avg({_ERROR} * {_ERROR})', 4)} from {train} join {line} using (symbol) group by 1")
    parts.append(
        f"select symbol, '{model}', 'train_r2', '', {r(f'1 - avg({_ERROR} * {_ERROR}) / var_pop(close)', 4)} "
        f"from {train} join {line} using (symbol) group by 1"
    )
    parts.append(f"select symbol, '{model}', 'test_mse', '', {r(f'avg({_ERROR} * {_ERROR})', 4)} from {test} join {line} using (symbol) group by 1")
    return " union all ".join(parts)


@query(
    "elastic_net_close",
    f"""with recursive {_MARKED}, train as (select * from marked where not is_test),
 test as (select * from marked where is_test),
 {_descent_sql("train", "symbol", repr(linear.ELASTIC_NET_PENALTY) + "::double", linear.ELASTIC_NET_MIX)}
 {_line_rows_sql("elastic_net", "line", "train", "test")}""",
)
def elastic_net_close(spark: SparkSession, folder: str) -> DataFrame:
    parts = rows.split_holdout(minute_bars(spark, folder), minute_number() % 10)
    return _rounded_metrics(linear.elastic_net(parts, ["symbol"], FEATURES, "close"))


@query(
    "predict",
    f"""with recursive {_MARKED}, train as (select * from marked where not is_test),
 {_descent_sql("train", "symbol", repr(linear.ELASTIC_NET_PENALTY) + "::double", linear.ELASTIC_NET_MIX)}
 select symbol, date, {r('close')} as close, {r(f'close - {_ERROR}', 4)} as prediction
 from marked join line using (symbol) where is_test""",
)
def predict(spark: SparkSession, folder: str) -> DataFrame:
    """Elastic-net predictions of the test bars."""
    parts = split_bars(spark, folder)
    fitted = linear.elastic_net(parts, ["symbol"], FEATURES, "close")
    table = linear.predict(parts.filter("is_test"), fitted, ["symbol"], FEATURES)
    return table.select("symbol", "date", rounded("close").alias("close"), rounded("prediction", 4).alias("prediction"))


_PENALTIES_SQL = ", ".join(f"({p!r}::double, '{p:.0e}')" for p in linear.PENALTIES)


@query(
    "l1_path_cv",
    f"""with recursive {_MARKED}, tried(penalty, label) as (values {_PENALTIES_SQL}),
 held(held) as (values ({_NO_HELD}), (0), (1), (2), (3), (4)),
 train as (select penalty, held, marked.* from marked, tried, held where not is_test and fold <> held),
 {_descent_sql("train", "symbol, penalty, held", "penalty", 1.0, 30_000)},
 fold_errors as (select symbol, penalty, held, avg({_ERROR} * {_ERROR}) as mse
   from marked join line using (symbol) where not is_test and fold = held group by all),
 scores as materialized (select symbol, penalty, abs(avg(mse)) as cv_error from fold_errors group by all),
 best as materialized (select symbol, penalty from scores
   qualify row_number() over (partition by symbol order by round(cv_error, 6), penalty) = 1),
 chosen as materialized (select line.* from line join best using (symbol, penalty) where held = {_NO_HELD}),
 all_train as (select * from marked where not is_test), test as (select * from marked where is_test)
 select symbol, 'l1_path' as model, 'cv_error' as metric, label as param, {r('cv_error', 4)} as value from scores join tried using (penalty)
 union all select symbol, 'l1_path', 'best_penalty', '', {r('penalty', 4)} from best
 union all {_line_rows_sql("l1_path", "chosen", "all_train", "test")}""",
)
def l1_path_cv(spark: SparkSession, folder: str) -> DataFrame:
    parts = rows.split_holdout(minute_bars(spark, folder), minute_number() % 10)
    folds = rows.kfold(parts, F.floor(minute_number() / 10), 5)
    return _rounded_metrics(linear.l1_path_cv(folds, ["symbol"], FEATURES, "close"))


@query(
    "pca_covariance",
    f"with {MINUTE_BARS} "
    + " union all ".join(
        f"select symbol, '{a}' as a, '{b}' as b, {r(f'covar_samp({a}, {b})', 4)} as covariance, "
        f"{r(f'corr({a}, {b})')} as correlation from bars group by 1"
        for i, a in enumerate(PRICE_COLUMNS)
        for b in PRICE_COLUMNS[i:]
    ),
)
def pca_covariance(spark: SparkSession, folder: str) -> DataFrame:
    table = linear.covariance(minute_bars(spark, folder), ["symbol"], PRICE_COLUMNS)
    return table.select(
        "symbol", "a", "b", rounded("covariance", 4).alias("covariance"), rounded("correlation").alias("correlation")
    )


def _power_sql(components: int = 2, rounds: int = 2000) -> str:
    """Leading eigenvectors of the correlation matrix by power iteration, taking each off the matrix in turn."""
    size = range(len(PRICE_COLUMNS))

    def cell(i: int, j: int) -> str:
        return f"a{min(i, j)}_{max(i, j)}"

    cells = [(i, j) for i in size for j in size if i <= j]
    parts = [
        "m1 as materialized (select symbol, "
        + ", ".join(f"corr({PRICE_COLUMNS[i]}, {PRICE_COLUMNS[j]}) as a{i}_{j}" for i, j in cells)
        + " from bars group by 1)"
    ]
    for c in range(1, components + 1):
        times = [" + ".join(f"{cell(i, j)} * v{j}" for j in size) for i in size]
        step = ", ".join(f"{t} as w{i}" for i, t in enumerate(times))
        norm = "sqrt(" + " + ".join(f"w{i} * w{i}" for i in size) + ")"
        start = ", ".join(f"{1.0 + i}::double as v{i}" for i in size)
        parts.append(
            f"p{c} as (select symbol, 0 as step, {start} from m{c} union all "
            f"select symbol, step + 1, {', '.join(f'w{i} / {norm} as v{i}' for i in size)} "
            f"from (select symbol, step, {step} from p{c} join m{c} using (symbol) where step < {rounds}) q)"
        )
        largest = f"greatest({', '.join(f'abs(v{i})' for i in size)})"
        sign = "case " + " ".join(f"when abs(v{i}) = {largest} then sign(v{i})" for i in size) + " end"
        value = " + ".join(f"v{i} * ({t})" for i, t in enumerate(times))
        parts.append(
            f"e{c} as materialized (select symbol, {', '.join(f'v{i} * ({sign}) as v{i}' for i in size)}, {value} as eigenvalue "
            f"from p{c} join m{c} using (symbol) where step = {rounds})"
        )
        rest = ", ".join(f"a{i}_{j} - eigenvalue * v{i} * v{j} as a{i}_{j}" for i, j in cells)
        parts.append(f"m{c + 1} as materialized (select symbol, {rest} from m{c} join e{c} using (symbol))")
    return ", ".join(parts)


def _scores_sql() -> str:
    units = ", ".join(f"avg({c}) as mean_{c}, stddev_samp({c}) as sd_{c}" for c in PRICE_COLUMNS)
    score = " + ".join(f"({c} - mean_{c}) / sd_{c} * v{i}" for i, c in enumerate(PRICE_COLUMNS))
    first = f"one as (select symbol, date, {score} as pc_1 from bars join units using (symbol) join e1 using (symbol))"
    second = f"two as (select symbol, date, {score} as pc_2 from bars join units using (symbol) join e2 using (symbol))"
    return (
        f"units as (select symbol, {units} from bars group by 1), {first}, {second} "
        f"select symbol, date, {r('pc_1', 4)} as pc_1, {r('pc_2', 4)} as pc_2 from one join two using (symbol, date)"
    )


@query("pca_features", f"with recursive {MINUTE_BARS}, {_power_sql()}, {_scores_sql()}")
def pca_features(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of every bar on the first two components."""
    table = stage(minute_bars(spark, folder), "bars")
    fit = stage(linear.pca_fit(table, ["symbol"], PRICE_COLUMNS, 2), "pca")
    scores = linear.pca_scores(table, fit, ["symbol"], PRICE_COLUMNS, 2)
    return scores.select("symbol", "date", *[rounded(c, 4).alias(c) for c in ("pc_1", "pc_2")])


@query(
    "pca_loadings",
    f"with recursive {MINUTE_BARS}, {_power_sql()} "
    + " union all ".join(
        f"select symbol, {c} as component, '{name}' as price, {r(f'v{i}', 4)} as loading, "
        f"{r(f'eigenvalue / {len(PRICE_COLUMNS)}', 4)} as explained from e{c}"
        for c in (1, 2)
        for i, name in enumerate(PRICE_COLUMNS)
    ),
)
def pca_loadings(spark: SparkSession, folder: str) -> DataFrame:
    fit = linear.pca_fit(minute_bars(spark, folder), ["symbol"], PRICE_COLUMNS, 2)
    names = F.array(*[F.lit(c) for c in PRICE_COLUMNS])
    long = fit.select("symbol", "component", "explained", F.explode(F.arrays_zip(names.alias("price"), "loading")).alias("z"))
    return long.select(
        "symbol",
        "component",
        F.col("z.price").alias("price"),
        rounded("z.loading", 4).alias("loading"),
        rounded("explained", 4).alias("explained"),
    )


@query("sequence_forecast")
def sequence_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """The recurrent model of the last 60 closes: 50 units, a fitted read-out."""
    forecast = linear.sequence_forecast(minute_bars(spark, folder), ["symbol"], ["date"], "close", reservoir=Reservoir())
    return _rounded_metrics(linear.forecast_errors(forecast, ["symbol"], "close"))


def _line_sql(lags: int, rounds: int = 400) -> str:
    """Least squares on the last values by conjugate gradients, written as a recursive query."""
    size = lags + 2
    window = "[1e0] || list_transform(list(u) over (partition by symbol order by row_idx rows between " + str(lags) + " preceding and current row), lambda x: x::double)"

    def times(vector: str) -> str:
        return f"list_transform(a, lambda line: list_dot_product(line, {vector}))"

    def plus(left: str, factor: str, right: str) -> str:
        return f"list_transform(list_zip({left}, {right}), lambda z: z[1] + ({factor}) * z[2])"

    return f"""bounds as (select symbol, min(close) as lo, max(close) as hi from parted where not is_test group by 1),
 scaled as (select parted.*, lo, hi, (close - lo) / (hi - lo) as u from parted join bounds using (symbol)),
 windows as materialized (select symbol, row_idx, first_test, is_test, close, lo, hi, {window} as w from scaled),
 sums as (select symbol, i, j, sum(w[i] * w[j]) as p from windows, range(1, {size + 1}) ri(i), range(1, {size + 1}) rj(j)
   where row_idx >= {lags} and not is_test group by 1, 2, 3),
 lines as (select symbol, i, list(p order by j) as line from sums group by 1, 2),
 system as materialized (select symbol, list(line[1:{size - 1}] order by i) filter (where i < {size}) as a,
   list(line[{size}] order by i) filter (where i < {size}) as b from lines group by 1),
 steps as (
  select symbol, 0 as step, list_transform(b, lambda x: 0e0) as x, b as r, b as d, list_dot_product(b, b) as rr from system
  union all
  select symbol, step + 1, {plus('x', 'al', 'd')}, r2, {plus('r2', 'rr2 / rr', 'd')}, rr2 from (
   select *, list_dot_product(r2, r2) as rr2 from (
    select *, {plus('r', '-al', 'ad')} as r2 from (
     select *, rr / list_dot_product(d, ad) as al from (
      select steps.*, {times('d')} as ad from steps join system using (symbol) where step < {rounds} and rr > 1e-26) q1) q2) q3) q4),
 solved as (select symbol, max_by(x, step) as x from steps group by 1),
 scored as (select symbol, row_idx - first_test as step, close - (list_dot_product(x, w[1:{size - 1}]) * (hi - lo) + lo) as e,
   close - (w[{size - 1}] * (hi - lo) + lo) as p from windows join solved using (symbol) where is_test)"""


@query(
    "sequence_line",
    f"""with recursive {MINUTE_PARTED}, {_line_sql(60)}
 select symbol, 'sequence_line' as model, 'test_mse' as metric, '' as param, {r('avg(e * e) filter (where step < 20)', 4)} as value from scored group by 1
 union all select symbol, 'sequence_line', 'test_mse_all', '', {r('avg(e * e)', 4)} from scored group by 1
 union all select symbol, 'persistence', 'test_mse', '', {r('avg(p * p) filter (where step < 20)', 4)} from scored group by 1
 union all select symbol, 'persistence', 'test_mse_all', '', {r('avg(p * p)', 4)} from scored group by 1""",
)
def sequence_line(spark: SparkSession, folder: str) -> DataFrame:
    """The forecast that is linear in the last 60 closes."""
    forecast = linear.sequence_forecast(minute_bars(spark, folder), ["symbol"], ["date"], "close")
    return _rounded_metrics(linear.forecast_errors(forecast, ["symbol"], "close", model="sequence_line"))


@query(
    "sequence_forecast_one_lag",
    f"""with {MINUTE_PARTED}, lagged as (select *, lag(close) over (partition by symbol order by date) as previous from parted),
 line as (select symbol, regr_slope(close, previous) as b, regr_intercept(close, previous) as a
   from lagged where not is_test and row_idx >= 1 group by 1),
 scored as (select symbol, row_idx - first_test as step, close - (a + b * previous) as e, close - previous as p
   from lagged join line using (symbol) where is_test)
 select symbol, 'sequence' as model, 'test_mse' as metric, '' as param, {r('avg(e * e) filter (where step < 20)', 4)} as value from scored group by 1
 union all select symbol, 'sequence', 'test_mse_all', '', {r('avg(e * e)', 4)} from scored group by 1
 union all select symbol, 'persistence', 'test_mse', '', {r('avg(p * p) filter (where step < 20)', 4)} from scored group by 1
 union all select symbol, 'persistence', 'test_mse_all', '', {r('avg(p * p)', 4)} from scored group by 1""",
)
def sequence_forecast_one_lag(spark: SparkSession, folder: str) -> DataFrame:
    """The forecast with one lag, which has a closed form to check against."""
    forecast = linear.sequence_forecast(minute_bars(spark, folder), ["symbol"], ["date"], "close", lags=1)
    return _rounded_metrics(linear.forecast_errors(forecast, ["symbol"], "close"))


@query("elastic_net_ten_steps")
def elastic_net_ten_steps(spark: SparkSession, folder: str) -> DataFrame:
    """The fit stopped after ten steps."""
    parts = rows.split_holdout(minute_bars(spark, folder), minute_number() % 10)
    return _rounded_metrics(linear.elastic_net_stopped(parts, ["symbol"], FEATURES, "close"))


# --- boosted trees --------------------------------------------------------------------------


def folded_bars(spark: SparkSession, folder: str) -> DataFrame:
    return rows.kfold(split_bars(spark, folder), F.floor(minute_number() / 10), 5)


@query("boosted_trees_l1")
def boosted_trees_l1(spark: SparkSession, folder: str) -> DataFrame:
    """All 21 leaf penalties and five folds, 100 trees of depth 6 each."""
    return _rounded_metrics(trees.boosted_trees_l1(folded_bars(spark, folder), ["symbol"], FEATURES, "close"))


@query("boosted_trees_cv")
def boosted_trees_cv(spark: SparkSession, folder: str) -> DataFrame:
    """The search over the least gain of a split, also with 100 trees of depth 6."""
    return _rounded_metrics(trees.boosted_trees_cv(folded_bars(spark, folder), ["symbol"], FEATURES, "close"))


# --- all models together --------------------------------------------------------------------


def all_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Metric rows of the four model families for every symbol, from one written bar table."""
    parts = folded_bars(spark, folder)
    linear_rows = linear.elastic_net(parts, ["symbol"], FEATURES, "close")
    neighbour = knn_choice(parts).filter("chosen_on = 'validation'").selectExpr(
        "symbol", "'knn' as model", "stack(2, 'best_k', double(k), 'test_mse', test_mse) as (metric, value)"
    ).selectExpr("symbol", "model", "metric", "'' as param", "value")
    boosted = trees.boosted_trees_l1(parts, ["symbol"], FEATURES, "close")
    sequence = linear.forecast_errors(
        linear.sequence_forecast(parts, ["symbol"], ["date"], "close", reservoir=Reservoir()), ["symbol"], "close"
    )
    return linear_rows.unionByName(neighbour).unionByName(boosted).unionByName(sequence)


@query("per_symbol_report")
def per_symbol_report(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded_metrics(all_metrics(spark, folder))


def later_bars(spark: SparkSession, folder: str) -> DataFrame:
    """Bars with the last 30 % of each symbol for testing and the earlier ones in folds, written once."""
    parted = features.split_temporal(minute_bars(spark, folder), ["symbol"], ["date"])
    return stage(rows.kfold(parted, F.floor(minute_number() / 10), 5), "later-bars")


def _linear_and_near(parts: DataFrame, near: DataFrame, k: DataFrame | int) -> DataFrame:
    """Test bars with the predictions of the elastic net and, from those in ``near``, of the nearest neighbours."""
    test = parts.filter("is_test")
    fitted = linear.elastic_net(parts, ["symbol"], FEATURES, "close")
    line = linear.predict(test.select("symbol", "date", "close", *FEATURES), fitted, ["symbol"], FEATURES)
    near = attach(near, k, ["symbol"], salts=1) if isinstance(k, DataFrame) else near.withColumn("k", F.lit(k))
    chosen = near.selectExpr("symbol", "date", f"element_at(array({', '.join(f'pred_{i}' for i in range(1, NEIGHBOURS + 1))}), k) as knn")
    return line.selectExpr("symbol", "date", "close", "prediction as elastic_net").join(chosen, ["symbol", "date"])


def _compared(table: DataFrame, models: list[str]) -> DataFrame:
    found = aggregate.compare_predictions(table, ["symbol"], "close", models)
    return found.select("symbol", "n", *[rounded(m, 4).alias(m) for m in models], "best", "second", rounded("t", 3).alias("t"))


_SIMPLE = ["elastic_net", "knn", "persistence"]
_LATER = f"""{MINUTE_PARTED}, train as materialized (select * from parted where not is_test),
 lagged as (select *, lag(close) over (partition by symbol order by date) as previous from parted),
 test as materialized (select * from lagged where is_test)"""


@query(
    "paired_comparison",
    f"""with recursive {_LATER}, {_descent_sql("train", "symbol", repr(linear.ELASTIC_NET_PENALTY) + "::double", linear.ELASTIC_NET_MIX)},
 {_neighbour_sql('train', 'test')},
 squares as materialized (
  select symbol, power({_ERROR}, 2) as elastic_net, power(close - pred, 2) as knn, power(close - previous, 2) as persistence
  from test join line using (symbol) join predicted using (symbol, date, close) where k = {NEIGHBOURS}),
 errors as (select symbol, count(*) as n, {', '.join(f'avg({m}) as {m}' for m in _SIMPLE)} from squares group by 1),
 ranked as (select symbol, model, mse, row_number() over (partition by symbol order by mse) as place
  from (unpivot errors on {', '.join(_SIMPLE)} into name model value mse)),
 picked as (select symbol, max(model) filter (where place = 1) as best, max(model) filter (where place = 2) as second from ranked group by 1),
 paired as (select symbol, best, second, {' + '.join(f"{m} * ((second = '{m}')::int - (best = '{m}')::int)" for m in _SIMPLE)} as d
  from squares join picked using (symbol)),
 tested as (select symbol, avg(d) / (stddev_samp(d) / sqrt(count(*))) as t from paired group by 1)
 select symbol, n, {', '.join(f'{r(m, 4)} as {m}' for m in _SIMPLE)}, best, second, {r('t', 3)} as t
 from errors join picked using (symbol) join tested using (symbol)""",
)
def paired_comparison(spark: SparkSession, folder: str) -> DataFrame:
    """Elastic net, three nearest neighbours and the previous close on the same later bars."""
    parts = later_bars(spark, folder)
    indexed = parts.select("symbol", "row_idx", "is_test", "date", "close")
    previous = indexed.selectExpr("symbol", "row_idx + 1 as row_idx", "close as persistence")
    near = _predicted(parts.filter(~F.col("is_test")), parts.filter("is_test"))
    table = _linear_and_near(parts, near, NEIGHBOURS).join(
        indexed.filter("is_test").select("symbol", "row_idx", "date").join(previous, ["symbol", "row_idx"]), ["symbol", "date"]
    )
    return _compared(table, _SIMPLE)


@query("model_comparison")
def model_comparison(spark: SparkSession, folder: str) -> DataFrame:
    """All models on the same later bars: errors, the best and how sure it is, and whether the counts are streamed."""
    parts = later_bars(spark, folder)
    # the errors of the choice and the table take the same predictions
    near = stage(_predicted(parts.filter(~F.col("is_test")), parts.filter("is_test")), "knn-predicted")
    choice = knn_choice(parts, near).filter("chosen_on = 'validation'").select("symbol", "k")
    boosted, _ = trees.boosted_predictions(parts.select("symbol", "date", "is_test", "fold", *FEATURES, "close"), ["symbol"], FEATURES, "close")
    forecast = linear.sequence_forecast(parts, ["symbol"], ["date"], "close", reservoir=Reservoir())
    table = (
        _linear_and_near(parts, near, stage(choice, "chosen-k"))
        .join(boosted.selectExpr("symbol", "date", "prediction as boosted_trees"), ["symbol", "date"])
        .join(forecast.selectExpr("symbol", "date", "forecast as sequence", "persistence"), ["symbol", "date"])
    )
    streamed = count_by_date(event_stream(spark, folder), "ts").isStreaming
    models = ["elastic_net", "knn", "boosted_trees", "sequence", "persistence"]
    return _compared(table, models).withColumn("streaming", F.lit(streamed))
