"""Regression, outliers and smoothing against direct numpy computations."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression

from tickloom.operators import lowess, ols


def _sample(n: int = 40, seed: int = 3) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    frames = []
    for pair, slope in (("a", 2.0), ("b", -0.5)):
        x = rng.normal(size=n) * 3 + 1
        y = 1 + slope * x + rng.standard_t(3, size=n)
        y[0] += 25
        frames.append(pd.DataFrame({"pair": pair, "row_key": np.arange(n), "x": x, "y": y}))
    return pd.concat(frames, ignore_index=True)


@pytest.fixture(scope="module")
def cases(spark):
    return _sample(), spark.createDataFrame(_sample())


def test_fit_and_tests_of_residuals(spark, cases):
    data, rows = cases
    fit = ols.ols_fit(rows, ["pair"])
    table = ols.ols_summary(rows, fit, ["pair"], ["row_key"]).toPandas().set_index("pair")
    for pair, group in data.groupby("pair"):
        x, y, n = group["x"].to_numpy(), group["y"].to_numpy(), len(group)
        design = np.column_stack([x, np.ones(n)])
        beta, *_ = np.linalg.lstsq(design, y, rcond=None)
        e = y - design @ beta
        got = table.loc[pair]
        assert np.allclose([got["slope"], got["intercept"]], beta)
        assert abs(e.sum()) < 1e-9
        errors = np.sqrt(np.diag(np.linalg.inv(design.T @ design)) * (e @ e) / (n - 2))
        assert np.allclose([got["se_slope"], got["se_intercept"]], errors)
        assert np.isclose(got["condition_number"], np.linalg.cond(design))
        assert np.isclose(got["durbin_watson"], np.sum(np.diff(e) ** 2) / (e @ e))
        log_likelihood = -n / 2 * (math.log(2 * math.pi * (e @ e) / n) + 1)
        assert np.isclose(got["aic"], 4 - 2 * log_likelihood)
        assert np.isclose(got["bic"], 2 * math.log(n) - 2 * log_likelihood)
        skew, kurtosis = np.mean(e**3) / np.mean(e**2) ** 1.5, np.mean(e**4) / np.mean(e**2) ** 2
        assert np.isclose(got["jarque_bera"], n / 6 * (skew**2 + (kurtosis - 3) ** 2 / 4))
        assert np.isclose(got["omnibus"], _k2(skew, kurtosis, n))


def _k2(skew: float, kurtosis: float, n: int) -> float:
    """K-squared of D'Agostino and Pearson by the textbook steps."""
    y = skew * math.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    b2 = 3 * (n**2 + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = -1 + math.sqrt(2 * (b2 - 1))
    z1 = math.asinh(y / math.sqrt(2 / (w2 - 1))) / math.sqrt(math.log(math.sqrt(w2)))
    mean = 3 * (n - 1) / (n + 1)
    variance = 24 * n * (n - 2) * (n - 3) / ((n + 1) ** 2 * (n + 3) * (n + 5))
    x = (kurtosis - mean) / math.sqrt(variance)
    b1 = 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * math.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6 + 8 / b1 * (2 / b1 + math.sqrt(1 + 4 / b1**2))
    z2 = ((1 - 2 / (9 * a)) - np.cbrt((1 - 2 / a) / (1 + x * math.sqrt(2 / (a - 4))))) / math.sqrt(2 / (9 * a))
    return z1**2 + z2**2


def test_p_values_agree_with_mllib(spark, cases):
    _, rows = cases
    table = ols.ols_inference(ols.ols_fit(rows, ["pair"]), ["pair"]).toPandas().set_index("pair")
    for pair in ("a", "b"):
        data = VectorAssembler(inputCols=["x"], outputCol="v").transform(rows.filter(f"pair = '{pair}'"))
        summary = LinearRegression(featuresCol="v", labelCol="y", solver="normal").fit(data).summary
        assert np.allclose(table.loc[pair, ["p_slope", "p_intercept"]].astype(float), summary.pValues, atol=1e-12)
        assert np.isclose(table.loc[pair, "p_f"], summary.pValues[0], atol=1e-12)
        half = table.loc[pair, "high_slope"] - table.loc[pair, "slope"]
        # 2.024394 is the two-sided 5 % point of Student's t with 38 degrees of freedom
        assert np.isclose(half / summary.coefficientStandardErrors[0], 2.024394, atol=1e-5)


def test_studentized_residuals_equal_leave_one_out(spark, cases):
    data, rows = cases
    fit = ols.ols_fit(rows, ["pair"])
    got = ols.studentized_residuals(rows, fit, ["pair"]).toPandas().sort_values(["pair", "row_key"])
    for pair, group in data.groupby("pair"):
        x, y = group["x"].to_numpy(), group["y"].to_numpy()
        design = np.column_stack([x, np.ones(len(x))])
        hat = np.diag(design @ np.linalg.inv(design.T @ design) @ design.T)
        e = y - design @ np.linalg.lstsq(design, y, rcond=None)[0]
        expected = []
        for i in range(len(x)):
            rest = np.arange(len(x)) != i
            residual = y[rest] - design[rest] @ np.linalg.lstsq(design[rest], y[rest], rcond=None)[0]
            expected.append(e[i] / math.sqrt(residual @ residual / (rest.sum() - 2) * (1 - hat[i])))
        assert np.allclose(got.loc[got["pair"] == pair, "t"], expected)
    outliers = ols.studentized_outliers(rows, fit, ["pair"]).toPandas()
    assert {("a", 0), ("b", 0)} <= set(zip(outliers["pair"], outliers["row_key"]))


def test_degenerate_fits_are_null(spark):
    rows = spark.createDataFrame(
        [("same_x", i, 1.0, float(i)) for i in range(5)]
        + [("few", i, float(i), float(i * i)) for i in range(3)]
        + [("line", i, float(i), 2.0 * i) for i in range(6)]
        + [("gaps", i, None, 1.0) for i in range(4)],
        "pair string, row_key int, x double, y double",
    )
    fit = ols.ols_fit(rows, ["pair"])
    table = fit.toPandas().set_index("pair")
    assert "gaps" not in table.index
    assert pd.isna(table.loc["same_x", "slope"])
    assert np.isclose(table.loc["line", "slope"], 2.0)
    scored = ols.studentized_residuals(rows, fit, ["pair"]).toPandas()
    assert scored.loc[scored["pair"].isin(["same_x", "few", "line"]), "t"].isna().all()
    inference = ols.ols_inference(fit, ["pair"]).toPandas().set_index("pair")
    assert inference.loc["same_x", ["p_slope", "p_intercept", "p_f"]].isna().all()
    assert pd.isna(inference.loc["line", "p_slope"])
    assert 0 < inference.loc["few", "p_slope"] < 1


def _direct_lowess(x: np.ndarray, y: np.ndarray, frac: float, iterations: int = 3) -> np.ndarray:
    n = len(x)
    k = int(frac * n + 1e-10)
    robust = np.ones(n)
    for _ in range(iterations + 1):
        fit = np.empty(n)
        for i in range(n):
            d = np.abs(x - x[i])
            h = np.sort(d)[k - 1]
            w = np.where(d <= 0.001 * h, 1.0, np.where(d > 0.999 * h, 0.0, (1 - (d / max(h, 1e-300)) ** 3) ** 3)) * robust
            centre = (w @ x) / w.sum()
            spread = w @ (x - centre) ** 2
            slope = (w @ ((x - centre) * y)) / spread if spread > 1e-12 else 0.0
            fit[i] = (w @ y) / w.sum() + slope * (x[i] - centre)
        e = np.abs(y - fit)
        u = e / (6 * np.median(e))
        robust = np.where(u > 0.999, 0.0, np.where(u < 0.001, 1.0, (1 - u**2) ** 2))
    return fit


def _wave(n: int, seed: int = 5, ties: bool = False) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    x = rng.uniform(0, 10, n)
    x = np.round(x) if ties else x
    y = np.sin(x) + rng.normal(size=n) * 0.3
    y[::17] += 4
    return pd.DataFrame({"g": "w", "id": np.arange(n), "x": x, "y": y})


@pytest.mark.parametrize("ties", [False, True])
def test_lowess_equals_direct_loop(spark, ties):
    data = _wave(120, ties=ties)
    spans = [1 / 3, 2 / 3, 1 / 5]
    got = lowess.lowess_smooth(spark.createDataFrame(data), ["g"], spans).toPandas()
    for span in spans:
        mine = got[np.isclose(got["frac"], span)].sort_values("id")
        assert np.allclose(mine["fitted"], _direct_lowess(data["x"].to_numpy(), data["y"].to_numpy(), span), atol=1e-9)


def test_lowess_in_blocks_is_the_same(spark, monkeypatch):
    data = pd.concat([_wave(700), _wave(500, seed=6, ties=True).assign(g="ties"), _wave(300, seed=7).assign(g=None)])
    rows = spark.createDataFrame(data, "g string, id long, x double, y double")
    whole = lowess.lowess_smooth(rows, ["g"], [1 / 5]).toPandas().sort_values(["g", "id"])
    monkeypatch.setattr(lowess, "BLOCK_KNOTS", 37)
    cut = lowess.lowess_smooth(rows, ["g"], [1 / 5]).toPandas().sort_values(["g", "id"])
    assert len(whole) == 1500 and np.allclose(whole["fitted"], cut["fitted"], atol=1e-9)
    first = whole[whole["g"] == "w"]
    assert np.allclose(first["fitted"], _direct_lowess(*data[data["g"] == "w"][["x", "y"]].to_numpy().T, 1 / 5), atol=1e-8)


def test_lowess_joins_repeat_only_hot_knots(spark, monkeypatch):
    """Beyond the broadcast limit rows of rare x take a plain join, those of a hot x a salted one; the fits stay."""
    data = pd.concat([_wave(400), _wave(300, seed=7).assign(g=None)])
    data.loc[data["id"] < 60, "x"] = 2.0
    rows = spark.createDataFrame(data, "g string, id long, x double, y double")
    whole = lowess.lowess_smooth(rows, ["g"], [1 / 5, 1 / 2]).toPandas().sort_values(["frac", "g", "id"])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    repeated, attach = [], lowess.attach
    monkeypatch.setattr(lowess, "HOT_ROWS", 50)
    monkeypatch.setattr(lowess, "attach", lambda rows, stats, *more, salts=None, **how: (
        None if salts == 1 or "x" not in more[0] else repeated.append(stats.count()), attach(rows, stats, *more, salts=salts, **how))[1])
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
        cut = lowess.lowess_smooth(rows, ["g"], [1 / 5, 1 / 2]).toPandas().sort_values(["frac", "g", "id"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(whole) == 1400 and np.allclose(whole["fitted"], cut["fitted"], atol=1e-9)
    assert max(repeated) == 4  # the hot x of both groups, for each span


def test_lowess_without_weight_keeps_the_value(spark):
    rng = np.random.default_rng(4)
    y = rng.normal(size=60) * 0.01
    y[20:40] = np.where(np.arange(20) % 2 == 0, 100.0, -100.0)
    rows = spark.createDataFrame([("a", i, float(i), float(v)) for i, v in enumerate(y)], "g string, id int, x double, y double")
    for iterations in (1, 3):
        got = lowess.lowess_smooth(rows, ["g"], [1 / 5], iterations).toPandas()
        assert got["fitted"].notna().all()


def _direct_fits(knots: np.ndarray, k: int) -> np.ndarray:
    fits = np.empty(len(knots))
    for i, x in enumerate(knots["x"]):
        away = np.abs(knots["x"] - x)
        order = np.argsort(away, kind="stable")
        h = away[order][np.searchsorted(np.cumsum(knots["n"][order]), k)]
        with np.errstate(divide="ignore", invalid="ignore"):
            weight = np.where(away <= 0.001 * h, 1.0, np.where(away > 0.999 * h, 0.0, (1 - (away / h) ** 3) ** 3))
        s, t, shift = weight * knots["s"], weight * knots["t"], knots["x"] - x
        a0, a1, a2, b0, b1 = s.sum(), s @ shift, s @ shift**2, t.sum(), t @ shift
        spread = a0 * a2 - a1 * a1
        fits[i] = np.nan if a0 <= 0 else (a2 * b0 - a1 * b1) / spread if spread > 1e-12 * a0 * a2 else b0 / a0
    return fits


@pytest.mark.parametrize("size", [7, 33, 64, 300])
def test_fits_by_moments_equal_direct_sums(size):
    """Even, heavy-tailed and tied x, any span, single blocks at hand only where the plan says they are needed."""
    draw = np.random.default_rng(size)
    for trial in range(24):
        count = int(draw.integers(1, 900))
        x = [draw.uniform(0, 10, count), draw.normal(size=count) ** 3, draw.standard_cauchy(count), np.round(draw.normal(size=count) * 50)][trial % 4]
        x = np.unique(x)
        knots = np.zeros(len(x), lowess.KNOT)
        knots["x"], knots["n"] = x, draw.integers(1, 4, len(x))
        knots["s"] = knots["n"] * draw.uniform(0, 1, len(x)) * (draw.random(len(x)) > 0.2)
        knots["t"] = knots["s"] * (np.sin(x) + draw.normal(size=len(x)))
        k = max(int(draw.choice([0.05, 0.2, 1 / 3, 2 / 3, 1.0]) * knots["n"].sum()), 1)
        blocks = dict(enumerate(np.split(knots, range(size, len(x), size))))
        layout = pd.DataFrame([(b, v["x"][0], v["x"][-1], v["n"].sum()) for b, v in blocks.items()], columns=["block", "low", "high", "rows"])
        plan = lowess._plan(layout, k)
        got = []
        for b, own in blocks.items():
            raw = {s: blocks[s] for at, s in plan if at == b}
            rest = {s: (v["n"].sum(), lowess.Stretches.of_knots(v, np.zeros(1, int))) for s, v in blocks.items() if s not in raw}
            got.append(lowess._block_fits(own, raw, rest, k))
        assert np.allclose(np.concatenate(got), _direct_fits(knots, k), rtol=1e-8, atol=1e-8, equal_nan=True)
        assert len(plan) <= 8 * len(blocks) + 16


@pytest.mark.parametrize("parts", [1, 8])
def test_lowess_keeps_a_perfect_line(spark, parts):
    rows = spark.createDataFrame([("l", i, float(i), 3.0 * i) for i in range(30)], "g string, id int, x double, y double")
    got = lowess.lowess_smooth(rows.repartition(parts), ["g"], [1 / 3]).toPandas()
    assert np.allclose(got["fitted"], got["y"])


def test_lowess_in_teams_is_the_same(spark, monkeypatch):
    """Teams of neighbouring blocks, with single knots of some blocks and one sum for each run of the others, and a gap in x."""
    data = pd.concat([_wave(800, seed=8), _wave(400, seed=9).assign(g=None)])
    data.loc[data["x"] > 6, "x"] += 500.0
    monkeypatch.setattr(lowess, "BLOCK_KNOTS", 12)
    monkeypatch.setattr(lowess, "TEAMS", 2)
    got = lowess.lowess_smooth(spark.createDataFrame(data, "g string, id long, x double, y double"), ["g"], [1 / 5, 1 / 2]).toPandas()
    for group in ("w", None):
        own = data[data["g"].isna() if group is None else data["g"] == group]
        for span in (1 / 5, 1 / 2):
            mine = got[(got["g"].isna() if group is None else got["g"] == group) & np.isclose(got["frac"], span)].sort_values("id")
            assert np.allclose(mine["fitted"], _direct_lowess(*own[["x", "y"]].to_numpy().T, span), atol=1e-7)
    x = np.sort(data["x"].to_numpy()[:800])
    layout = pd.DataFrame([(b, v[0], v[-1], len(v)) for b, v in enumerate(np.split(x, range(12, 800, 12)))], columns=["block", "low", "high", "rows"])
    for k in (160, 400):
        sources, runs = lowess._teams(layout, k, 8, 2)
        assert {s["source"] for s in sources if s["own"]} == set(layout["block"])
        assert len(runs) <= 4 * len({s["team"] for s in sources})


def test_fits_of_a_leaf_share_their_stretches(monkeypatch):
    """The sums of stretches are moved a few times for each leaf, not some twenty times for each fit."""
    draw = np.random.default_rng(2)
    knots = np.zeros(16_000, lowess.KNOT)
    knots["x"], knots["n"], knots["s"] = np.sort(draw.uniform(0, 1e8, len(knots))), 1, draw.uniform(0, 1, len(knots))
    knots["t"] = knots["s"] * draw.normal(size=len(knots))
    blocks = dict(enumerate(np.split(knots, range(1000, len(knots), 1000))))
    layout = pd.DataFrame([(b, v["x"][0], v["x"][-1], v["n"].sum()) for b, v in blocks.items()], columns=["block", "low", "high", "rows"])
    k = len(knots) // 3
    raw = {s: blocks[s] for at, s in lowess._plan(layout, k) if at == 8}
    rest = {s: (v["n"].sum(), lowess.Stretches.of_knots(v, np.zeros(1, int))) for s, v in blocks.items() if s not in raw}
    moves, moved = [], lowess._moved
    monkeypatch.setattr(lowess, "_moved", lambda moments, *to: (moves.append(moments.shape[1]), moved(moments, *to))[1])
    got = lowess._block_fits(blocks[8], raw, rest, k)
    assert np.allclose(got, _direct_fits(knots, k)[8000:9000], rtol=1e-9)
    assert sum(moves) < 3 * len(got)


def test_far_off_fit_keeps_its_spread():
    """A knot without weight far from all others: the line comes from a spread that is a tiny part of the squared distance."""
    draw = np.random.default_rng(3)
    x = np.concatenate([[-30_000.0], np.sort(draw.normal(size=300)), [15_000.0, 18_000.0]])
    knots = np.zeros(len(x), lowess.KNOT)
    knots["x"], knots["n"], knots["s"] = x, 1, np.concatenate([[0.0], draw.uniform(0.1, 1, 300), [0.0, 0.0]])
    knots["t"] = knots["s"] * (2 * x + draw.normal(size=len(x)))
    got = lowess._block_fits(knots, {0: knots}, {}, 302)[0]
    a0 = a1 = a2 = b0 = b1 = Fraction(0)
    for at, s, t in zip(x[1:301], knots["s"][1:301], knots["t"][1:301]):
        away = Fraction(at) - Fraction(x[0])
        weight = (1 - (away / 45_000) ** 3) ** 3 * Fraction(s)
        value = (1 - (away / 45_000) ** 3) ** 3 * Fraction(t)
        a0, a1, a2, b0, b1 = a0 + weight, a1 + weight * away, a2 + weight * away**2, b0 + value, b1 + value * away
    assert abs(got / float((a2 * b0 - a1 * b1) / (a0 * a2 - a1 * a1)) - 1) < 1e-9


def test_lowess_in_pieces_is_the_same(spark, monkeypatch):
    """Beyond the broadcast limit a pass moves pieces of blocks, here of some 16 rows: ties, twice the same row, a line, rows without weight."""
    rng = np.random.default_rng(4)
    alone = pd.DataFrame({"g": "alone", "id": np.arange(60), "x": np.arange(60.0), "y": rng.normal(size=60) * 0.01})
    alone.loc[20:39, "y"] = np.where(np.arange(20) % 2 == 0, 100.0, -100.0)
    line = pd.DataFrame({"g": "line", "id": np.arange(50), "x": np.arange(50.0), "y": 3.0 * np.arange(50)})
    data = pd.concat([_wave(300, seed=10, ties=True).assign(g=None), _wave(200, seed=11), _wave(200, seed=11), alone, line])
    rows = spark.createDataFrame(data, "g string, id long, x double, y double")
    order = ["frac", "g", "id", "fitted"]
    whole = lowess.lowess_smooth(rows, ["g"], [1 / 5, 1 / 2]).toPandas().sort_values(order)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    monkeypatch.setattr(lowess, "BLOCK_KNOTS", 20)
    monkeypatch.setattr(lowess, "PIECE_ROWS", 16)
    packed, pieces = [], lowess._Smoother._pieces
    monkeypatch.setattr(lowess._Smoother, "_pieces", lambda self: (packed.append(pieces(self)), packed[-1])[1])
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
        cut = lowess.lowess_smooth(rows, ["g"], [1 / 5, 1 / 2]).toPandas().sort_values(order)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(whole) == len(cut) == 2 * len(data) and np.allclose(whole["fitted"], cut["fitted"], atol=1e-9)
    assert packed[0].agg({"piece": "max"}).first()[0] > 5
