"""Nearest neighbours, linear models, trees and forecasts against brute force."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tickloom.operators import knn, linear, trees
from tickloom.operators.reservoir import Reservoir

FEATURES = ["w", "x", "y", "z"]


def _points(n: int, first_id: int, seed: int) -> pd.DataFrame:
    """Half of the rows in one group, a third of all rows copies of one point, one column with a heavy value."""
    rng = np.random.default_rng(seed)
    values = rng.normal(size=(n, 4))
    values[:, 1] = np.round(values[:, 1], 1)
    values[:, 3] = np.where(rng.random(n) < 0.4, 7.0, rng.exponential(size=n) * 10)
    values[rng.random(n) < 0.33] = [1.0, 2.0, 3.0, 4.0]
    data = pd.DataFrame(values, columns=FEATURES)
    data["g"] = rng.choice(["a", "b", "c"], n, p=[0.5, 0.4, 0.1])
    data["id"] = np.arange(n) + first_id
    data["label"] = rng.normal(size=n)
    return data


def _brute(train: pd.DataFrame, point: np.ndarray, k: int) -> list[int]:
    values = train[FEATURES].to_numpy()
    span = values.max(axis=0) - values.min(axis=0)
    gap = (point - values) / np.where(span > 0, span, 1.0)
    distance = ((gap[:, 0] ** 2 + gap[:, 1] ** 2) + gap[:, 2] ** 2) + gap[:, 3] ** 2
    return train["id"].to_numpy()[np.lexsort((train["id"].to_numpy(), distance))[:k]].tolist()


@pytest.mark.parametrize("cell_rows", [24, 400])
def test_neighbours_equal_brute_force(spark, cell_rows):
    train, asked = _points(1500, 0, 1), _points(300, 10_000, 2)
    found = knn.nearest_neighbours(
        spark.createDataFrame(train), spark.createDataFrame(asked), ["g"], FEATURES, "id", "label", 3, cell_rows
    ).toPandas()
    mine = {key: part.sort_values("rank")["id"].tolist() for key, part in found.groupby(["g", *FEATURES])}
    assert len(mine) == len(asked.drop_duplicates(["g", *FEATURES]))
    for (group, *point), ids in mine.items():
        assert ids == _brute(train[train["g"] == group], np.array(point), 3)


def test_cell_that_no_cut_divides(spark):
    """Many rows of two far points, more of them than fit a cell after copies are reduced."""
    train = pd.DataFrame({"g": "a", "w": [0.0, 1.0] * 20, "id": range(40), "label": np.arange(40.0)})
    asked = pd.DataFrame({"g": ["a", "b"], "w": [0.2, 0.2]})
    table = knn.knn_predict(
        spark.createDataFrame(train), spark.createDataFrame(asked), ["g"], ["w"], "id", "label", 5, cell_rows=2
    ).toPandas().set_index("g")
    assert table.loc["a", "pred_1"] == 0.0
    assert table.loc["a", "pred_5"] == np.mean([0, 2, 4, 6, 8])
    assert pd.isna(table.loc["b", "pred_1"])


def test_nearest_on_itself(spark):
    train = _points(200, 0, 4).drop_duplicates(FEATURES)
    rows = spark.createDataFrame(train)
    table = knn.knn_predict(rows, rows, ["g"], FEATURES, "id", "label", 1).toPandas()
    assert np.allclose(table["pred_1"], table["label"])


def _linear_rows(spark):
    rng = np.random.default_rng(8)
    n = 600
    data = pd.DataFrame(rng.normal(size=(n, 4)), columns=FEATURES)
    data["x"] = data["w"] * 0.9 + data["x"] * 0.1
    data["label"] = 3 * data["w"] - 2 * data["y"] + rng.normal(size=n) * 2 + 5
    data["g"] = rng.choice(["a", "b"], n, p=[0.8, 0.2])
    data["is_test"] = np.arange(n) % 10 >= 7
    data["fold"] = (np.arange(n) // 10) % 5
    return data, spark.createDataFrame(data)


@pytest.mark.parametrize("penalty", [0.3, 2.0, 1e6])
def test_elastic_net_equals_converged_mllib(spark, penalty):
    data, rows = _linear_rows(spark)
    table = linear.elastic_net(rows, ["g"], FEATURES, "label", penalty=penalty).toPandas()
    for group in ("a", "b"):
        part = rows.filter(f"g = '{group}' and not is_test")
        model = LinearRegression(
            featuresCol="v", labelCol="label", maxIter=2000, tol=1e-13, regParam=penalty, elasticNetParam=0.8
        ).fit(VectorAssembler(inputCols=FEATURES, outputCol="v").transform(part))
        mine = table[table["g"] == group].set_index(["metric", "param"])["value"]
        assert np.allclose([mine["coefficient", f] for f in FEATURES], model.coefficients.toArray(), atol=1e-5)
        assert np.isclose(mine["train_mse", ""], model.summary.meanSquaredError, rtol=1e-6)
        test = data[(data["g"] == group) & data["is_test"]]
        guess = test[FEATURES].to_numpy() @ model.coefficients.toArray() + model.intercept
        assert np.isclose(mine["test_mse", ""], np.mean((test["label"] - guess) ** 2), rtol=1e-4)


@pytest.mark.parametrize("steps", [1, 2, 3, 10])
def test_stopped_steps_are_mllibs(spark, steps):
    _, rows = _linear_rows(spark)
    wild = rows.withColumns({"y": rows["w"] + rows["z"] + rows["y"] * 0.01, "z": rows["z"] * 1000, "g": F.lit("wild")})
    rows = rows.unionByName(wild).unionByName(wild.withColumns({"w": F.lit(2.0), "g": F.lit(None).cast("string")}))
    table = linear.elastic_net_stopped(rows, ["g"], FEATURES, "label", steps=steps).toPandas()
    table["g"] = table["g"].fillna("null")
    for group, part in {"a": "g = 'a'", "b": "g = 'b'", "wild": "g = 'wild'", "null": "g is null"}.items():
        data = VectorAssembler(inputCols=FEATURES, outputCol="v").transform(rows.filter(part))
        model = LinearRegression(featuresCol="v", labelCol="label", maxIter=steps, regParam=0.3, elasticNetParam=0.8).fit(data.filter("not is_test"))
        mine = table[table["g"] == group].set_index(["metric", "param"])["value"]
        assert np.allclose([mine["coefficient", f] for f in FEATURES], model.coefficients.toArray(), rtol=1e-9, atol=1e-9)
        assert np.isclose(mine["intercept", ""], model.intercept)
        assert np.isclose(mine["train_mse", ""], model.summary.meanSquaredError)
        assert np.isclose(mine["test_mse", ""], model.evaluate(data.filter("is_test")).meanSquaredError)


def test_moments_do_not_depend_on_partitions(spark):
    _, rows = _linear_rows(spark)
    runs = [
        linear.l1_path_cv(rows.repartition(p), ["g"], FEATURES, "label").toPandas().sort_values(["g", "metric", "param"])
        for p in (1, 7)
    ]
    assert np.allclose(runs[0]["value"], runs[1]["value"])
    assert len(runs[0]) == 2 * (21 + 1 + 4 + 1 + 3)


def test_pca_equals_eigenvectors(spark):
    data, rows = _linear_rows(spark)
    fit = linear.pca_fit(rows, ["g"], FEATURES, 2)
    scores = linear.pca_scores(rows, fit, ["g"], FEATURES, 2).toPandas()
    part = data[data["g"] == "a"][FEATURES]
    standard = ((part - part.mean()) / part.std()).to_numpy()
    values, vectors = np.linalg.eigh(np.corrcoef(standard.T))
    table = fit.filter("g = 'a' and component = 1").toPandas().iloc[0]
    assert np.isclose(table["explained"], values[-1] / values.sum())
    assert np.allclose(np.abs(table["loading"]), np.abs(vectors[:, -1]))
    mine = scores[scores["g"] == "a"].sort_values(FEATURES)["pc_1"].to_numpy()
    direct = (standard @ vectors[:, -1])[np.lexsort([part[c] for c in reversed(FEATURES)])]
    assert np.allclose(np.abs(mine), np.abs(direct))


@pytest.mark.parametrize("block_rows", [70, 50_000])
def test_forecast_equals_least_squares(spark, block_rows):
    rng = np.random.default_rng(11)
    lags, n = 5, 300
    series = np.cumsum(rng.normal(size=n)) + 50
    rows = spark.createDataFrame(pd.DataFrame({"s": "a", "t": np.arange(n), "v": series}))
    got = linear.sequence_forecast(rows, ["s"], ["t"], "v", lags=lags, block_rows=block_rows).toPandas().sort_values("t")
    first = int(np.ceil(n * 0.7))
    windows = np.lib.stride_tricks.sliding_window_view(series, lags + 1)
    design = np.column_stack([np.ones(len(windows)), windows[:, :-1]])
    train = np.arange(lags, n) < first
    weights, *_ = np.linalg.lstsq(design[train], windows[train, -1], rcond=None)
    assert np.allclose(got["forecast"], (design @ weights)[~train], atol=1e-6)
    assert np.allclose(got["persistence"], series[first - 1 : -1])
    assert got["step"].tolist() == list(range(n - first))


def _direct_states(net: Reservoir, window: np.ndarray) -> np.ndarray:
    entry, bias, inner = net.weights
    state = np.zeros(net.units)
    for value in window:
        state = np.array([math.tanh(entry[j] * (2 * value - 1) + bias[j] + sum(state[i] * inner[i, j] for i in range(net.units))) for j in range(net.units)])
    return state


@pytest.mark.parametrize("block_rows", [70, 50_000])
def test_reservoir_equals_a_direct_loop(spark, block_rows):
    rng = np.random.default_rng(12)
    lags, n, net = 6, 160, Reservoir(units=7)
    series = np.cumsum(rng.normal(size=n)) + 50
    rows = spark.createDataFrame(pd.DataFrame({"s": "a", "t": np.arange(n), "v": series}))
    got = linear.sequence_forecast(rows, ["s"], ["t"], "v", lags, block_rows, net, ridge=0.01).toPandas().sort_values("t")
    first = int(np.ceil(n * 0.7))
    low, high = series[:first].min(), series[:first].max()
    scaled = (series - low) / (high - low)
    design = np.array([[1.0, *_direct_states(net, scaled[i - lags : i])] for i in range(lags, n)])
    train = np.arange(lags, n) < first
    x, y = design[train], scaled[lags:][train]
    weights = np.linalg.solve(x.T @ x + 0.01 * len(x) * np.diag([0.0] + [1.0] * 7), x.T @ y)
    assert np.allclose(got["forecast"], (design @ weights)[~train] * (high - low) + low, atol=1e-8)


def test_reservoir_follows_a_bent_series(spark):
    """Each value is a parabola of the one before: the last value says little, a line in the values hardly more."""
    value, series = 0.3, []
    for _ in range(1500):
        value = 3.8 * value * (1 - value)
        series.append(value)
    rows = spark.createDataFrame(pd.DataFrame({"s": "a", "t": np.arange(1500), "v": series}))
    errors = {}
    for model, net in (("line", None), ("reservoir", Reservoir())):
        table = linear.sequence_forecast(rows, ["s"], ["t"], "v", reservoir=net).toPandas()
        errors[model] = ((table["v"] - table["forecast"]) ** 2).mean()
    errors["persistence"] = ((table["v"] - table["persistence"]) ** 2).mean()
    assert errors["reservoir"] < errors["line"] / 10 < errors["persistence"] / 10


def _direct_boosting(bins, y, n_bins, alpha, trees_, depth, rate=0.3, ridge=1.0):
    """Level-wise boosting on binned features; returns the prediction function on bin vectors."""
    threshold = lambda g: np.sign(g) * max(abs(g) - alpha, 0)
    score = lambda g, h: threshold(g) ** 2 / (h + ridge)
    base = y.mean()
    prediction = np.full(len(y), base)
    forest = []

    def grow(rows, level):
        g, h = (prediction[rows] - y[rows]).sum(), rows.sum()
        best = None
        if level < depth:
            for f in range(bins.shape[1]):
                for b in range(n_bins):
                    left = rows & (bins[:, f] <= b)
                    if 0 < left.sum() < h:
                        gl, hl = (prediction[left] - y[left]).sum(), left.sum()
                        gain = round(score(gl, hl) + score(g - gl, h - hl) - score(g, h), 9)
                        if gain > 1e-6 and (best is None or gain > best[0]):
                            best = (gain, f, b)
        if best is None:
            return -rate * threshold(g) / (h + ridge)
        _, f, b = best
        return f, b, grow(rows & (bins[:, f] <= b), level + 1), grow(rows & (bins[:, f] > b), level + 1)

    def value(tree, point):
        while isinstance(tree, tuple):
            tree = tree[2] if point[tree[0]] <= tree[1] else tree[3]
        return tree

    for _ in range(trees_):
        tree = grow(np.ones(len(y), bool), 0)
        forest.append(tree)
        prediction = prediction + np.array([value(tree, p) for p in bins])
    return lambda points: base + np.array([sum(value(t, p) for t in forest) for p in points])


def test_boosted_trees_equal_direct_boosting(spark):
    rng = np.random.default_rng(21)
    n = 400
    data = pd.DataFrame({"g": "a", "f1": rng.integers(0, 6, n).astype(float), "f2": rng.integers(0, 5, n).astype(float)})
    data["label"] = 4 * (data["f1"] > 2) + data["f2"] * (data["f1"] > 3) + rng.normal(size=n)
    data["is_test"] = np.arange(n) % 10 >= 7
    data["fold"] = (np.arange(n) // 10) % 3
    penalties = [0.1, 20.0, 1e9]
    got = trees.boosted_trees_l1(
        spark.createDataFrame(data), ["g"], ["f1", "f2"], "label", penalties, folds=3, trees=3, depth=2
    ).toPandas()
    bins = data[["f1", "f2"]].to_numpy()
    y, test, fold = data["label"].to_numpy(), data["is_test"].to_numpy(), data["fold"].to_numpy()
    scores = []
    for alpha in penalties:
        errors = []
        for held in range(3):
            train = ~test & (fold != held)
            predict = _direct_boosting(bins[train], y[train], 6, alpha, 3, 2)
            out = ~test & (fold == held)
            errors.append(np.mean((y[out] - predict(bins[out])) ** 2))
        scores.append(np.mean(errors))
    mine = got[got["metric"] == "cv_error"].set_index("param")["value"]
    assert np.allclose([mine["1e-01"], mine["2e+01"], mine["1e+09"]], scores)
    best = penalties[int(np.argmin(scores))]
    predict = _direct_boosting(bins[~test], y[~test], 6, best, 3, 2)
    values = got.set_index("metric")["value"]
    assert values["best_penalty"] == best
    assert np.isclose(values["test_mse"], np.mean((y[test] - predict(bins[test])) ** 2))


def _tree_rows(n: int = 400, seed: int = 21) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    data = pd.DataFrame({"g": "a", "f1": rng.integers(0, 6, n).astype(float), "f2": rng.integers(0, 5, n).astype(float)})
    data["label"] = 4 * (data["f1"] > 2) + data["f2"] * (data["f1"] > 3) + rng.normal(size=n)
    data["is_test"] = np.arange(n) % 10 >= 7
    data["fold"] = (np.arange(n) // 10) % 3
    return data


@pytest.mark.parametrize("limit", ["10m", "0"])
def test_trees_over_many_blocks_and_a_null_group(spark, monkeypatch, limit):
    """Blocks of four cells give the trees of one block; a group without name is a group; trees travel by a salted join too."""
    data = _tree_rows()
    rows = spark.createDataFrame(pd.concat([data, data.assign(g=None)]), "g string, f1 double, f2 double, label double, is_test boolean, fold long")
    found = {}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for size in (4096, 4):
            monkeypatch.setattr(trees, "BLOCK_CELLS", size)
            if size == 4:
                spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            table = trees.boosted_trees_l1(rows, ["g"], ["f1", "f2"], "label", [0.1, 20.0], folds=3, trees=2, depth=3).toPandas()
            found[size] = table.fillna({"g": "null"}).sort_values(["g", "metric", "param"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert np.allclose(found[4096]["value"], found[4]["value"])
    by_group = found[4].set_index(["g", "metric", "param"])["value"]
    assert np.allclose(by_group["a"], by_group["null"])


def test_some_thousand_cells_need_no_exchange(spark, monkeypatch):
    """A group of 6,400 cells is grown in one task for each batch of settings, with the errors of many blocks."""
    n = 6400
    data = pd.DataFrame({"g": "a", "f1": np.arange(n) % 80.0, "f2": np.arange(n) // 80.0})
    data["label"] = data["f1"] * (data["f2"] > 30) + np.random.default_rng(4).normal(size=n)
    data["is_test"], data["fold"] = np.arange(n) % 10 >= 7, (np.arange(n) // 10) % 2
    binned = trees.binned_rows(spark.createDataFrame(data), ["g"], ["f1", "f2"], "label", 80)
    settings = [(float(a), 0.0) for a in range(6)]
    found = []
    for size in (None, 2000):
        if size:
            monkeypatch.setattr(trees, "BLOCK_CELLS", size)
        booster = trees.boost(binned, ["g"], ["f1", "f2"], "label", settings, 2, 2, 3, 0.3, 1.0, 80)
        assert booster.many == (6 if size else 0)  # three fits, two batches of settings
        found.append(booster.errors().toPandas().sort_values(["held", "setting"]))
    assert found[0]["setting"].tolist() == list(range(6)) * 3
    columns = ["held_mse", "test_mse", "train_mse"]
    assert np.allclose(found[0][columns], found[1][columns], equal_nan=True)


def test_bins_do_not_depend_on_the_number_of_features(spark):
    """With 24 features a single useful one is still cut where it has to be."""
    rng = np.random.default_rng(2)
    n = 600
    data = pd.DataFrame(rng.normal(size=(n, 24)), columns=[f"f{i}" for i in range(24)])
    data["label"] = 10.0 * (data["f17"] > data["f17"].quantile(0.9))
    data["g"], data["is_test"], data["fold"] = "a", np.arange(n) % 10 >= 7, (np.arange(n) // 10) % 3
    features = [f"f{i}" for i in range(24)]
    got = trees.boosted_trees_l1(spark.createDataFrame(data), ["g"], features, "label", [0.0], folds=3, trees=12, depth=2).toPandas()
    assert got.set_index("metric")["value"]["test_mse"] < data["label"].var() / 4


def test_least_gain_prunes(spark):
    rows = spark.createDataFrame(_tree_rows())
    found = trees.boosted_trees_cv(rows, ["g"], ["f1", "f2"], "label", (0.0, 50.0, 1e9), folds=3, trees=3, depth=3).toPandas()
    scores = found[found["metric"] == "cv_error"].set_index("param")["value"]
    assert sorted(found["metric"]) == ["best_min_gain", "cv_error", "cv_error", "cv_error", "test_mse", "train_mse"]
    assert scores["1e+09"] > 2 * scores["0e+00"]  # no split at all


def test_predictions_are_those_of_the_errors(spark):
    data = _tree_rows()
    rows = spark.createDataFrame(data.assign(id=np.arange(len(data))))
    predicted, metrics = trees.boosted_predictions(rows, ["g"], ["f1", "f2"], "label", [0.1, 20.0], folds=3, trees=3, depth=2)
    table, values = predicted.toPandas(), metrics.toPandas().set_index("metric")["value"]
    assert sorted(table["id"]) == np.flatnonzero(data["is_test"]).tolist()
    assert np.isclose(((table["label"] - table["prediction"]) ** 2).mean(), values["test_mse"])


def test_task_helpers_need_no_installed_package(tmp_path):
    import subprocess
    import sys

    from pyspark import cloudpickle

    from tickloom.operators import lowess

    path = tmp_path / "helpers"
    path.write_bytes(cloudpickle.dumps([linear.penalised_line, linear.Moments, lowess._block_fits]))
    code = "import pickle; pickle.load(open('helpers', 'rb'))"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)


def test_weak_penalties_share_their_row_counts(monkeypatch):
    rng = np.random.default_rng(5)
    n = 300
    growth = trees.Growth((1e-9, 1e-8, 1e-7, 30.0), (0.0,) * 4, 2, 8, 3, 0.3, 1.0)
    row = {
        "folds": np.zeros(n, np.int32).tobytes(), "test_fold": 2, "held": 1, "bins": rng.integers(0, 8, (2, n)).astype(np.int16).tobytes(),
        "sums": np.stack([rng.integers(1, 4, n), rng.normal(size=n) * 9, rng.random(n)]).tobytes(), "pred": np.zeros(4 * n).tobytes(),
    }
    calls = []
    bincount = np.bincount
    monkeypatch.setattr(trees.np, "bincount", lambda *a, **k: calls.append(1) or bincount(*a, **k))
    block = trees.Block(growth, row)
    root = block.sums(growth, trees.Tree(growth).route(block.bins, 0), 0)
    assert len(calls) == 4 * 2 + 2  # gradients of four settings and two features, rows of two features
    assert (root[1] == root[1][:, :1]).all()
    for _ in range(4):
        block.add_grown(growth)
    for setting in range(4):
        alone = trees.replace(growth, alphas=growth.alphas[setting : setting + 1], gains=(0.0,))
        one = trees.Block(alone, {**row, "pred": np.zeros(n).tobytes()})
        for _ in range(4):
            one.add_grown(alone)
        assert (one.pred[0] == block.pred[setting]).all()


def test_a_few_queries_are_searched_by_all_cores(spark, monkeypatch):
    rng = np.random.default_rng(6)
    data = pd.DataFrame({"g": "a", "f1": rng.random(400), "f2": rng.random(400), "id": range(400), "y": rng.random(400)})
    files, stage = {}, knn.stage

    def seen(df, label, *rest):
        staged = stage(df, label, *rest)
        files[label] = len(staged.inputFiles())
        return staged

    monkeypatch.setattr(knn, "stage", seen)
    table = spark.createDataFrame(data)
    knn.nearest_neighbours(table, table, ["g"], ["f1", "f2"], "id", "y", 3).count()
    assert files["knn-queries"] > 1
