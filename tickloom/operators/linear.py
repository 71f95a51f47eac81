"""Linear models of many groups from one aggregation of second moments.

Spark reduces the rows to means and cross products per (group, part); the solvers then see one
small table per group, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from tickloom.operators.features import apply_minmax, fit_minmax, lag_window_features, mark_temporal
from tickloom.operators.reservoir import Reservoir, read_out
from tickloom.operators.skew import attach, windowed_blocks, with_row_index
from tickloom.session import stage

METRIC_FIELDS = [
    T.StructField("model", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("param", T.StringType()),
    T.StructField("value", T.DoubleType()),
]

# fixed values: the settings of the linear fit and the penalty search
ELASTIC_NET_PENALTY = 0.3
ELASTIC_NET_MIX = 0.8
PENALTIES = [10.0**i for i in range(-10, 11)]


def second_moments(rows: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Count, means and centred cross products per key: ``n, mean (array), cross (array, row-major)``."""
    complete = rows.dropna(subset=list(columns))
    means = [f"avg(`{c}`) as mean_{i}" for i, c in enumerate(columns)]
    crosses = [
        f"count(*) * covar_pop(`{a}`, `{b}`) as cross_{i}_{j}"
        for i, a in enumerate(columns)
        for j, b in enumerate(columns)
        if i <= j
    ]
    size = range(len(columns))
    wide = complete.groupBy(*keys).agg(F.count("*").alias("n"), *[F.expr(e) for e in means + crosses])
    mean = ", ".join(f"mean_{i}" for i in size)
    cross = ", ".join(f"cross_{min(i, j)}_{max(i, j)}" for i in size for j in size)
    return wide.selectExpr(*keys, "n", f"array({mean}) as mean", f"array({cross}) as cross")


@dataclass
class Moments:
    """Count, means and centred cross products of features followed by the label."""

    n: float
    mean: np.ndarray
    cross: np.ndarray

    @classmethod
    def of(cls, row: pd.Series) -> Moments:
        mean = np.asarray(row["mean"], dtype=float)
        return cls(float(row["n"]), mean, np.asarray(row["cross"], dtype=float).reshape(len(mean), -1))

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        gap = other.mean - self.mean
        return Moments(
            n,
            self.mean + gap * other.n / n,
            self.cross + other.cross + np.outer(gap, gap) * self.n * other.n / n,
        )

    def error(self, coefficients: np.ndarray, intercept: float) -> float:
        """Mean squared error of a linear predictor on these rows."""
        direction = np.append(-coefficients, 1.0)
        bias = self.mean @ direction - intercept
        return float(direction @ self.cross @ direction / self.n + bias * bias)


def pooled(parts: Iterable[Moments]) -> Moments:
    return reduce(lambda a, b: a + b, parts)


def _sparse_minimum(gram: np.ndarray, target: np.ndarray, soft: float) -> np.ndarray:
    """Minimum of ``b G b / 2 - t b + soft * |b|`` by feature-sign search (Lee et al. 2007).

    Solves for the current set of signed coefficients, stops at the best zero crossing on the way,
    and adds the coefficient whose slope exceeds the penalty most, until none does.
    """
    beta = np.zeros(len(target))

    def cost(b: np.ndarray) -> float:
        return float(b @ gram @ b / 2 - target @ b + soft * np.abs(b).sum())

    for _ in range(100 * (len(beta) + 1)):
        slope = gram @ beta - target
        excess = np.where(beta == 0, np.abs(slope) - soft, 0.0)
        if excess.max(initial=0.0) <= 1e-13:
            break
        entering = int(np.argmax(excess))
        signs = np.sign(beta)
        signs[entering] = -np.sign(slope[entering])
        while True:
            active = np.flatnonzero(signs)
            wanted = np.zeros(len(beta))
            wanted[active] = np.linalg.lstsq(
                gram[np.ix_(active, active)], target[active] - soft * signs[active], rcond=1e-14
            )[0]
            if (np.sign(wanted[active]) == signs[active]).all():
                beta = wanted
                break
            move = wanted - beta
            crossing = [j for j in active if beta[j] != 0 and np.sign(wanted[j]) != np.sign(beta[j])]
            steps = [np.where(np.arange(len(beta)) == j, 0.0, beta - beta[j] / move[j] * move) for j in crossing]
            moved = min([*steps, wanted], key=cost)
            if cost(moved) >= cost(beta):
                return beta
            beta, signs = moved, np.sign(moved)
    return beta


def penalised_line(data: Moments, penalty: float, mix: float) -> tuple[np.ndarray, float]:
    """Elastic net on features and label in units of their deviation.

    Minimises half the mean squared error plus ``penalty * (mix * |b| + (1 - mix) / 2 * b^2)``,
    with the penalty in units of the label, as Spark's own linear regression states it.
    """
    deviation = np.sqrt(np.diag(data.cross) / data.n)
    label_sd = deviation[-1]
    features = deviation[:-1]
    coefficients = np.zeros(len(features))
    if label_sd > 0:
        used = np.flatnonzero(features > 0)
        scale = features[used]
        gram = data.cross[np.ix_(used, used)] / data.n / np.outer(scale, scale)
        target = data.cross[used, -1] / data.n / (scale * label_sd)
        soft, ridge = penalty * mix / label_sd, penalty * (1.0 - mix) / label_sd
        coefficients[used] = _sparse_minimum(gram + ridge * np.eye(len(used)), target, soft) * label_sd / scale
    return coefficients, float(data.mean[-1] - coefficients @ data.mean[:-1])


def _stopped_minimum(gram: np.ndarray, target: np.ndarray, soft: float, spread: float, steps: int) -> np.ndarray:
    """Orthant-wise quasi-Newton steps (Andrew and Gao 2007) from zero towards the minimum of
    ``spread / 2 + b G b / 2 - t b + soft * |b|``, ten pairs of memory, step lengths by the strong Wolfe conditions.

    Squared loss needs nothing but the moments, so a step reads no rows.
    """
    beta, memory, failed = np.zeros(len(target)), [], False

    def slope(b: np.ndarray) -> np.ndarray:
        """Gradient where the penalty is smooth, else its least one-sided part."""
        g = gram @ b - target
        at_zero = np.sign(g) * np.maximum(np.abs(g) - soft, 0.0)
        return np.where(b != 0, g + np.sign(b) * soft, at_zero)

    def cost(b: np.ndarray) -> float:
        return float(spread / 2 + b @ gram @ b / 2 - target @ b + soft * np.abs(b).sum())

    done = 0
    while done < steps:
        down = slope(beta)
        if np.linalg.norm(down) <= max(1e-6 * abs(cost(beta)), 1e-8):
            break
        aim, taken = down.copy(), []
        for step, change in memory:
            taken.append((step @ aim) / (step @ change))
            aim -= taken[-1] * change
        if memory:
            step, change = memory[0]
            aim *= (step @ change) / (change @ change)
        for (step, change), part in zip(reversed(memory), reversed(taken)):
            aim += (part - (change @ aim) / (step @ change)) * step
        aim = np.where(aim * down > 0, -aim, 0.0)
        orthant = np.where(beta != 0, np.sign(beta), -np.sign(down))

        def moved(length: float) -> np.ndarray:
            b = beta + length * aim
            return np.where(np.sign(b) == orthant, b, 0.0)

        start, fall = cost(beta), down @ aim
        length, shorter = (0.05 / np.linalg.norm(gram @ beta - target), 0.1) if done == 0 else (1.0, 0.5)
        for _ in range(20):
            there = moved(length)
            rate = slope(there) @ aim
            if cost(there) > start + 1e-4 * length * fall:
                length *= shorter
            elif rate < 0.9 * fall:
                length *= 2.1
            elif rate > -0.9 * fall:
                length *= shorter
            else:
                step = there - beta
                memory = [(step, gram @ step), *memory[:9]]
                beta, done = there, done + 1
                break
        else:
            if failed:
                break
            failed, memory = True, []
    return beta


def stopped_line(data: Moments, penalty: float, mix: float, steps: int) -> tuple[np.ndarray, float]:
    """The problem of ``penalised_line`` after so many steps."""
    deviation = np.sqrt(np.diag(data.cross) / data.n)
    label_sd, coefficients = deviation[-1], np.zeros(len(deviation) - 1)
    if label_sd > 0:
        used = np.flatnonzero(deviation[:-1] > 0)
        scale = deviation[used]
        gram = data.cross[np.ix_(used, used)] / data.n / np.outer(scale, scale)
        target = data.cross[used, -1] / data.n / (scale * label_sd)
        ridge = penalty * (1.0 - mix) / label_sd * np.eye(len(used))
        coefficients[used] = _stopped_minimum(gram + ridge, target, penalty * mix / label_sd, 1.0, steps) * label_sd / scale
    return coefficients, float(data.mean[-1] - coefficients @ data.mean[:-1])


def _per_group(parts: DataFrame, keys: Sequence[str], solve) -> DataFrame:
    """Run ``solve`` on the moment rows of each group (one per part) and emit metric rows."""
    key_fields = [parts.schema[k] for k in keys]

    def run(group: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame(solve(group), columns=[f.name for f in METRIC_FIELDS])
        for position, key in enumerate(keys):
            out.insert(position, key, group[key].iloc[0])
        return out

    return parts.groupBy(*keys).applyInPandas(run, T.StructType(key_fields + METRIC_FIELDS))


def _line_metrics(
    model: str, features: Sequence[str], line: tuple[np.ndarray, float], train: Moments, test: Moments | None
) -> list[tuple]:
    coefficients, intercept = line
    train_mse = train.error(coefficients, intercept)
    spread = train.cross[-1, -1] / train.n
    rows = [(model, "coefficient", f, float(c)) for f, c in zip(features, coefficients)]
    rows.append((model, "intercept", "", intercept))
    rows.append((model, "train_mse", "", train_mse))
    rows.append((model, "train_r2", "", 1.0 - train_mse / spread if spread > 0 else float("nan")))
    if test is not None:
        rows.append((model, "test_mse", "", test.error(coefficients, intercept)))
    return rows


def _fitted(rows: DataFrame, keys: Sequence[str], features: Sequence[str], label: str, model: str, fit) -> DataFrame:
    """Metric rows of a line fitted to the training moments of each key."""
    parts = second_moments(rows, [*keys, "is_test"], [*features, label])

    def solve(group: pd.DataFrame) -> list[tuple]:
        by_part = {bool(row["is_test"]): Moments.of(row) for _, row in group.iterrows()}
        if False not in by_part:
            return []
        return _line_metrics(model, features, fit(by_part[False]), by_part[False], by_part.get(True))

    return _per_group(parts, keys, solve)


def elastic_net(
    rows: DataFrame,
    keys: Sequence[str],
    features: Sequence[str],
    label: str,
    penalty: float = ELASTIC_NET_PENALTY,
    mix: float = ELASTIC_NET_MIX,
) -> DataFrame:
    """Converged elastic net per key, for rows marked ``is_test``; long metric rows.

    Both errors are reported: ``train_mse`` and ``test_mse``.
    """
    return _fitted(rows, keys, features, label, "elastic_net", lambda data: penalised_line(data, penalty, mix))


def elastic_net_stopped(
    rows: DataFrame,
    keys: Sequence[str],
    features: Sequence[str],
    label: str,
    penalty: float = ELASTIC_NET_PENALTY,
    mix: float = ELASTIC_NET_MIX,
    steps: int = 10,
) -> DataFrame:
    """The same problem after ``steps`` quasi-Newton steps, which is what MLlib gives for ``maxIter``; all keys in one job."""
    return _fitted(rows, keys, features, label, f"elastic_net_{steps}", lambda data: stopped_line(data, penalty, mix, steps))


def predict(rows: DataFrame, metrics: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Adds ``prediction`` of a linear model given by its metric rows."""

    def pick(metric: str, param: str) -> str:
        return f"max(case when metric = '{metric}' and param = '{param}' then value end)"

    line = metrics.groupBy(*keys).agg(
        F.expr(pick("intercept", "")).alias("__intercept"),
        *[F.expr(pick("coefficient", f)).alias(f"__weight_{i}") for i, f in enumerate(features)],
    )
    terms = " + ".join(["__intercept", *[f"__weight_{i} * `{f}`" for i, f in enumerate(features)]])
    return attach(rows, stage(line, "line"), keys).selectExpr(
        *[f"`{c}`" for c in rows.columns], f"{terms} as prediction"
    )


def l1_path_cv(
    rows: DataFrame,
    keys: Sequence[str],
    features: Sequence[str],
    label: str,
    penalties: Sequence[float] = PENALTIES,
) -> DataFrame:
    """Choice of the L1 penalty by cross-validation over ``fold``, then a refit on all training rows.

    The moments of a training set are the sum over the other folds, so all penalties and folds come
    from one pass over the data.
    """
    parts = second_moments(rows, [*keys, "is_test", "fold"], [*features, label])

    def solve(group: pd.DataFrame) -> list[tuple]:
        folds = [Moments.of(row) for _, row in group[~group["is_test"]].iterrows()]
        tests = [Moments.of(row) for _, row in group[group["is_test"]].iterrows()]
        if len(folds) < 2:
            return []
        scores = []
        for penalty in penalties:
            errors = []
            for held, fold in enumerate(folds):
                others = pooled(f for i, f in enumerate(folds) if i != held)
                errors.append(fold.error(*penalised_line(others, penalty, 1.0)))
            scores.append(abs(float(np.mean(errors))))
        # errors that agree to six digits are equal, and then the first penalty is kept
        best = int(np.argmin(np.round(scores, 6)))
        train = pooled(folds)
        line = penalised_line(train, penalties[best], 1.0)
        out = [("l1_path", "cv_error", f"{p:.0e}", s) for p, s in zip(penalties, scores)]
        out.append(("l1_path", "best_penalty", "", float(penalties[best])))
        return out + _line_metrics("l1_path", features, line, train, pooled(tests) if tests else None)

    return _per_group(parts, keys, solve)


# --- principal components -------------------------------------------------------------------


def covariance(rows: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Sample covariance and correlation of every pair of columns: ``(*keys, a, b, covariance, correlation)``."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    wide = rows.groupBy(*keys).agg(
        *[F.covar_samp(a, b).alias(f"cov_{i}") for i, (a, b) in enumerate(pairs)],
        *[F.corr(a, b).alias(f"corr_{i}") for i, (a, b) in enumerate(pairs)],
    )
    cases = ", ".join(f"'{a}', '{b}', cov_{i}, corr_{i}" for i, (a, b) in enumerate(pairs))
    return wide.selectExpr(*keys, f"stack({len(pairs)}, {cases}) as (a, b, covariance, correlation)")


def pca_fit(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], k: int) -> DataFrame:
    """First ``k`` principal components of the standardised columns, per key.

    One row per key and component: ``component, explained, mean, sd, loading`` (arrays in the order
    of ``columns``); the largest loading of a component is positive.
    """
    parts = second_moments(rows, keys, columns)
    arrays = [T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("mean", "sd", "loading")]
    schema = T.StructType(
        [parts.schema[c] for c in keys]
        + [T.StructField("component", T.IntegerType()), T.StructField("explained", T.DoubleType())]
        + arrays
    )

    def decompose(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for batch in batches:
            out = []
            for _, row in batch.iterrows():
                data = Moments.of(row)
                sd = np.sqrt(np.diag(data.cross) / max(data.n - 1.0, 1.0))
                unit = np.where(sd > 0, sd, 1.0)
                correlation = data.cross / max(data.n - 1.0, 1.0) / np.outer(unit, unit)
                values, vectors = np.linalg.eigh(correlation)
                order = np.argsort(values)[::-1][:k]
                for place, i in enumerate(order, start=1):
                    loading = vectors[:, i]
                    loading = loading * (np.sign(loading[np.argmax(np.abs(loading))]) or 1.0)
                    share = values[i] / values.sum() if values.sum() > 0 else 0.0
                    out.append([*(row[c] for c in keys), place, share, data.mean, unit, loading])
            yield pd.DataFrame(out, columns=schema.fieldNames())

    return parts.mapInPandas(decompose, schema)


def pca_scores(rows: DataFrame, fit: DataFrame, keys: Sequence[str], columns: Sequence[str], k: int) -> DataFrame:
    """Adds ``pc_1`` ... ``pc_k``."""
    wide = fit.groupBy(*keys).agg(
        *[F.max(F.when(F.col("component") == i, F.struct("mean", "sd", "loading"))).alias(f"axis_{i}") for i in range(1, k + 1)]
    )
    scores = [
        " + ".join(f"(`{c}` - axis_{i}.mean[{j}]) / axis_{i}.sd[{j}] * axis_{i}.loading[{j}]" for j, c in enumerate(columns))
        + f" as pc_{i}"
        for i in range(1, k + 1)
    ]
    return attach(rows, wide, keys).selectExpr(*[f"`{c}`" for c in rows.columns], *scores)


# --- lag-window autoregression --------------------------------------------------------------


def _window_products(blocks: DataFrame, keys: Sequence[str], value: str, lags: int, reservoir: Reservoir | None = None) -> DataFrame:
    """Sum of products of (1, lagged values or states, value) over the training windows of each group."""
    width = (reservoir.units if reservoir else lags) + 2
    schema = T.StructType(
        [blocks.schema[k] for k in keys] + [T.StructField("products", T.ArrayType(T.DoubleType()))]
    )

    def multiply(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("row_idx")
        values, index = block[value].to_numpy(float), block["row_idx"].to_numpy()
        total = np.zeros((width, width))
        if len(values) > lags:
            windows = np.lib.stride_tricks.sliding_window_view(values, lags + 1)
            target = index[lags:]
            own = ~block["is_halo"].to_numpy()[lags:] & (target < block["first_test"].to_numpy()[lags:])
            windows = windows[own]
            windows = windows[np.isfinite(windows).all(axis=1)]
            inputs = reservoir.states(windows[:, :-1]) if reservoir else windows[:, :-1]
            rows = np.column_stack([np.ones(len(windows)), inputs, windows[:, -1]])
            total = rows.T @ rows
        return pd.DataFrame([[*(block[k].iloc[0] for k in keys), total.ravel()]], columns=schema.fieldNames())

    partial = blocks.groupBy(*keys, "block").applyInPandas(multiply, schema)
    cells = partial.select(*keys, F.posexplode("products").alias("place", "product"))
    return (
        cells.groupBy(*keys, "place")
        .agg(F.sum("product").alias("product"))
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list(F.struct("place", "product")))["product"].alias("products"))
    )


def _solve_products(products: DataFrame, keys: Sequence[str], inputs: int, ridge: float = 0.0) -> DataFrame:
    """Least-squares weights per group: ``intercept`` and ``weights`` in the order of the inputs.

    ``ridge`` is a penalty on the squared weights for each row.
    """
    schema = T.StructType(
        [products.schema[k] for k in keys]
        + [T.StructField("intercept", T.DoubleType()), T.StructField("weights", T.ArrayType(T.DoubleType()))]
    )

    def solve(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for batch in batches:
            out = []
            for _, row in batch.iterrows():
                total = np.asarray(row["products"], dtype=float).reshape(inputs + 2, inputs + 2)
                penalty = np.diag([0.0] + [ridge * total[0, 0]] * inputs)
                weights = np.linalg.pinv(total[:-1, :-1] + penalty, rcond=1e-10, hermitian=True) @ total[:-1, -1]
                out.append([*(row[k] for k in keys), float(weights[0]), weights[1:]])
            yield pd.DataFrame(out, columns=schema.fieldNames())

    return products.mapInPandas(solve, schema)


def sequence_forecast(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    value: str,
    lags: int = 60,
    block_rows: int = 50_000,
    reservoir: Reservoir | None = None,
    ridge: float = 1e-4,
) -> DataFrame:
    """One-step forecast of the later 30 % of each series from its last ``lags`` values.

    With a ``reservoir`` the values run through its recurrent network and a ridge regression reads the last
    state; without one the forecast is linear in the values. Values are scaled to 0..1 by the
    training range, forecasts scaled back. Returns the test rows with ``forecast`` and ``persistence`` (the previous value) and ``step``
    (0 for the first test row).
    """
    parted = stage(
        mark_temporal(with_row_index(df.select(*keys, *order_by, value), order_by, keys), keys), "series"
    )
    fit = fit_minmax(parted, keys, [value], where=~F.col("is_test"))
    scaled = stage(apply_minmax(parted, fit, keys, [value]), "series-scaled")
    target = f"{value}_scaled"
    blocks = windowed_blocks(scaled, lags, block_rows)
    products = _window_products(blocks, keys, target, lags, reservoir)
    solved = _solve_products(products, keys, reservoir.units, ridge) if reservoir else _solve_products(products, keys, lags)
    weights = stage(solved, "series-weights")
    late = scaled.filter(F.col("row_idx") >= F.col("first_test") - lags)
    windows = lag_window_features(late, keys, order_by, target, lags, block_rows).filter("is_test")
    back = f"* (`{value}__hi` - `{value}__lo`) + `{value}__lo`"
    found = attach(windows, weights, keys)
    if reservoir:
        scaled_forecast = read_out(reservoir, F.col("window"), F.col("intercept"), F.col("weights"))
    else:
        scaled_forecast = F.expr("intercept + aggregate(zip_with(window, weights, (v, w) -> v * w), 0e0, (s, v) -> s + v)")
    return found.withColumn("__forecast", scaled_forecast).selectExpr(
        *[f"`{c}`" for c in [*keys, *order_by, value]],
        "row_idx - first_test as step",
        f"__forecast {back} as forecast",
        f"window[{lags - 1}] {back} as persistence",
    )


def forecast_errors(forecast: DataFrame, keys: Sequence[str], value: str, head: int = 20, model: str = "sequence") -> DataFrame:
    """Errors on the first ``head`` test rows (``test_mse``) and on all of them, beside persistence."""

    def error(column: str, first_only: bool) -> str:
        square = f"power(`{value}` - {column}, 2)"
        return f"avg(case when step < {head} then {square} end)" if first_only else f"avg({square})"

    measures = [
        (model, "test_mse", "forecast", True),
        (model, "test_mse_all", "forecast", False),
        ("persistence", "test_mse", "persistence", True),
        ("persistence", "test_mse_all", "persistence", False),
    ]
    wide = forecast.groupBy(*keys).agg(*[F.expr(error(c, h)).alias(f"e{i}") for i, (_, _, c, h) in enumerate(measures)])
    cases = ", ".join(f"'{m}', '{n}', '', e{i}" for i, (m, n, _, _) in enumerate(measures))
    return wide.selectExpr(*keys, f"stack({len(measures)}, {cases}) as (model, metric, param, value)")
