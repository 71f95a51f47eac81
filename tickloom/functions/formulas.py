"""Closed forms of simple regression, as named steps in SQL text.

Each step may use the names before it. Inputs per fit: ``n, mx, my, sxx, syy, sxy``, and for the
residual block ``m2, m3, m4`` (mean powers of the residual) and ``sum_step_sq`` (sum of squared
differences of neighbouring residuals).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

Steps = list[tuple[str, str]]

FIT_STEPS: Steps = [
    ("slope", "sxy / nullif(sxx, 0)"),
    ("intercept", "my - slope * mx"),
    ("sse", "greatest(syy - sxy * slope, 0)"),
    ("r2", "sxy * slope / nullif(syy, 0)"),
]

COEFFICIENT_STEPS: Steps = [
    ("df", "n - 2"),
    ("mse_resid", "sse / nullif(df, 0)"),
    ("se_slope", "sqrt(mse_resid / nullif(sxx, 0))"),
    ("se_intercept", "sqrt(mse_resid * (1e0 / n + mx * mx / nullif(sxx, 0)))"),
    ("t_slope", "slope / nullif(se_slope, 0)"),
    ("t_intercept", "intercept / nullif(se_intercept, 0)"),
    ("adj_r2", "1 - (1 - r2) * (n - 1) / nullif(df, 0)"),
    ("f_value", "t_slope * t_slope"),
    ("log_likelihood", "-n / 2e0 * (ln(2 * pi()) + ln(nullif(sse, 0) / n) + 1)"),
    ("aic", "4 - 2 * log_likelihood"),
    ("bic", "2 * ln(n) - 2 * log_likelihood"),
    ("trace", "n + sxx + n * mx * mx"),
    ("eigen_high", "(trace + sqrt(trace * trace - 4 * n * sxx)) / 2"),
    ("condition_number", "eigen_high / nullif(sqrt(n * sxx), 0)"),
]

# Jarque-Bera; skewness and kurtosis tests of D'Agostino and of Anscombe and Glynn
RESIDUAL_STEPS: Steps = [
    ("skew", "m3 / nullif(pow(m2, 15e-1), 0)"),
    ("kurtosis", "m4 / nullif(m2 * m2, 0)"),
    ("jarque_bera", "n / 6e0 * (skew * skew + (kurtosis - 3) * (kurtosis - 3) / 4)"),
    ("prob_jarque_bera", "exp(-jarque_bera / 2)"),
    ("durbin_watson", "sum_step_sq / nullif(n * m2, 0)"),
    ("c", "case when n >= 8 then cast(n as double) end"),
    ("sk_y", "skew * sqrt((c + 1) * (c + 3) / (6 * (c - 2)))"),
    (
        "sk_b2",
        "3 * (c * c + 27 * c - 70) * (c + 1) * (c + 3) / ((c - 2) * (c + 5) * (c + 7) * (c + 9))",
    ),
    ("sk_w2", "sqrt(2 * (sk_b2 - 1)) - 1"),
    ("sk_ratio", "sk_y / sqrt(2 / (sk_w2 - 1))"),
    ("z_skew", "ln(sk_ratio + sqrt(sk_ratio * sk_ratio + 1)) / sqrt(5e-1 * ln(sk_w2))"),
    ("ku_sd", "sqrt(24 * c * (c - 2) * (c - 3) / ((c + 1) * (c + 1) * (c + 3) * (c + 5)))"),
    ("ku_x", "(kurtosis - 3 * (c - 1) / (c + 1)) / ku_sd"),
    (
        "ku_b1",
        "6 * (c * c - 5 * c + 2) / ((c + 7) * (c + 9)) * sqrt(6 * (c + 3) * (c + 5) / (c * (c - 2) * (c - 3)))",
    ),
    ("ku_a", "6 + 8 / ku_b1 * (2 / ku_b1 + sqrt(1 + 4 / (ku_b1 * ku_b1)))"),
    ("ku_d", "1 + ku_x * sqrt(2 / (ku_a - 4))"),
    (
        "z_kurtosis",
        "((1 - 2 / (9 * ku_a)) - sign(ku_d) * cbrt((1 - 2 / ku_a) / nullif(abs(ku_d), 0))) / sqrt(2 / (9 * ku_a))",
    ),
    ("omnibus", "z_skew * z_skew + z_kurtosis * z_kurtosis"),
    ("prob_omnibus", "exp(-omnibus / 2)"),
]

# residual scaled by the error variance of the fit without its row
STUDENT_STEPS: Steps = [
    ("residual", "y - (intercept + slope * x)"),
    ("leverage", "1e0 / n + (x - mx) * (x - mx) / nullif(sxx, 0)"),
    (
        "left_out_mse",
        "(sse - residual * residual / nullif(1 - leverage, 0)) / nullif(n - 3, 0)",
    ),
    (
        "t",
        "case when n > 3 and left_out_mse > 0 and leverage < 1 "
        "then residual / sqrt(left_out_mse * (1 - leverage)) end",
    ),
]


def apply_steps(df: DataFrame, steps: Steps) -> DataFrame:
    for name, expression in steps:
        df = df.withColumn(name, F.expr(expression))
    return df


def two_sided_p(t: str, df: str) -> Column:
    """Two-sided p-value of Student's t by the incomplete beta function on the JVM; null for a null t."""
    return F.expr(
        f"case when {t} is not null then cast(reflect('org.apache.commons.math3.special.Beta', 'regularizedBeta', "
        f"{df} / ({df} + coalesce({t} * {t}, 0e0)), {df} / 2e0, 5e-1) as double) end"
    )


def t_critical(df: str, alpha: float = 0.05) -> Column:
    """Point exceeded in absolute value with probability ``alpha``, by bisection."""
    tail = (
        "cast(reflect('org.apache.commons.math3.special.Beta', 'regularizedBeta', "
        f"{df} / ({df} + s.mid * s.mid), {df} / 2e0, 5e-1) as double) > {alpha!r}D"
    )
    return F.expr(
        "aggregate(sequence(1, 100), named_struct('lo', 0e0, 'mid', 512e0, 'hi', 1024e0), "
        f"(s, i) -> if({tail}, "
        "named_struct('lo', s.mid, 'mid', (s.mid + s.hi) / 2, 'hi', s.hi), "
        "named_struct('lo', s.lo, 'mid', (s.lo + s.mid) / 2, 'hi', s.mid)), s -> s.mid)"
    )
