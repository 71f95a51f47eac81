"""Simple least-squares regression for many (group, response, predictor) cases at once.

Rows come in long form with ``x`` and ``y`` and one or more key columns; every key is one fit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tickloom.functions.formulas import (
    COEFFICIENT_STEPS,
    FIT_STEPS,
    RESIDUAL_STEPS,
    STUDENT_STEPS,
    apply_steps,
    t_critical,
    two_sided_p,
)
from tickloom.operators.skew import attach, windowed_blocks, with_row_index
from tickloom.session import stage

FIT_COLUMNS = ["n", "mx", "my", "sxx", "syy", "sxy", "slope", "intercept", "sse", "r2"]


def ols_fit(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key; a single aggregation with map-side combine."""
    known = rows.filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    moments = known.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.avg("x").alias("mx"),
        F.avg("y").alias("my"),
        F.regr_sxx("y", "x").alias("sxx"),
        F.regr_syy("y", "x").alias("syy"),
        F.regr_sxy("y", "x").alias("sxy"),
    )
    return apply_steps(moments, FIT_STEPS).select(*keys, *FIT_COLUMNS)


def ols_predict(rows: DataFrame, fit: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds ``fitted`` and ``residual``."""
    lines = fit.select(*keys, "slope", "intercept")
    return (
        attach(rows, lines, keys)
        .withColumn("fitted", F.col("intercept") + F.col("slope") * F.col("x"))
        .withColumn("residual", F.col("y") - F.col("fitted"))
    )


def studentized_residuals(rows: DataFrame, fit: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds ``t``, the externally studentized residual; null where it is not defined."""
    scored = apply_steps(attach(rows, fit, keys), STUDENT_STEPS)
    return scored.select(*rows.columns, "t")


def studentized_outliers(
    rows: DataFrame, fit: DataFrame, keys: Sequence[str], limit: float = 3.0
) -> DataFrame:
    return studentized_residuals(rows, fit, keys).filter(F.abs("t") > limit)


def _residual_moments(
    rows: DataFrame, fit: DataFrame, keys: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """Mean powers of the residuals, and their squared steps along ``order_by``."""
    residuals = ols_predict(
        rows.filter(F.col("x").isNotNull() & F.col("y").isNotNull()), fit, keys
    ).select(*keys, *order_by, F.col("residual").alias("e"))
    blocks = windowed_blocks(with_row_index(residuals, order_by, keys), before=1)
    previous = F.lag("e").over(Window.partitionBy(*keys, "block").orderBy("row_idx"))
    own = blocks.withColumn("step", F.col("e") - previous).filter(~F.col("is_halo"))
    return own.groupBy(*keys).agg(
        *[F.avg(F.pow("e", F.lit(p))).alias(f"m{p}") for p in (2, 3, 4)],
        F.sum(F.col("step") * F.col("step")).alias("sum_step_sq"),
    )


def ols_summary(
    rows: DataFrame, fit: DataFrame, keys: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """Coefficients with errors, fit quality and residual tests, one row per key."""
    fit = stage(fit, "ols-fit")
    described = attach(fit, _residual_moments(rows, fit, keys, order_by), keys, salts=1)
    return apply_steps(described, COEFFICIENT_STEPS + RESIDUAL_STEPS)


def ols_inference(fit: DataFrame, keys: Sequence[str], alpha: float = 0.05) -> DataFrame:
    """p-values and confidence limits of both coefficients, and of the F statistic."""
    full = apply_steps(fit, COEFFICIENT_STEPS).filter("df > 0").withColumn("t_crit", t_critical("df", alpha))
    return full.select(
        *keys,
        "df",
        *[
            c
            for name in ("slope", "intercept")
            for c in (
                F.col(name),
                two_sided_p(f"t_{name}", "df").alias(f"p_{name}"),
                (F.col(name) - F.col("t_crit") * F.col(f"se_{name}")).alias(f"low_{name}"),
                (F.col(name) + F.col("t_crit") * F.col(f"se_{name}")).alias(f"high_{name}"),
            )
        ],
        "f_value",
        two_sided_p("t_slope", "df").alias("p_f"),
    )


def scatter_series(rows: DataFrame, curves: Sequence[tuple[str, DataFrame]], keys: Sequence[str]) -> DataFrame:
    """Points and curves of a chart in one tidy table ``(*keys, series, x, y)``.

    ``curves`` are named frames with the key columns, ``x`` and ``fitted``.
    """
    points = rows.select(*keys, F.lit("points").alias("series"), "x", "y")
    for name, curve in curves:
        points = points.unionByName(
            curve.select(*keys, F.lit(name).alias("series"), "x", F.col("fitted").alias("y"))
        )
    return points
