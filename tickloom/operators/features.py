"""Scaling, lag windows, time splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.functions.values import minmax, minmax_inverse
from tickloom.operators.skew import attach, windowed_blocks, with_row_index


def assemble(df: DataFrame, columns: Sequence[str], name: str = "features") -> DataFrame:
    """Vector column for MLlib; rows with a null among ``columns`` are left out."""
    return VectorAssembler(inputCols=list(columns), outputCol=name, handleInvalid="skip").transform(df)


def fit_minmax(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], where: Column | None = None
) -> DataFrame:
    """Smallest and largest value per key; ``where`` restricts the fit, e.g. to the training rows."""
    rows = df if where is None else df.filter(where)
    return rows.groupBy(*keys).agg(
        *[m(c).alias(f"{c}__{n}") for c in columns for n, m in (("lo", F.min), ("hi", F.max))]
    )


def apply_minmax(df: DataFrame, fit: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Adds ``<column>_scaled`` from a fit made by ``fit_minmax``."""
    scaled = {f"{c}_scaled": minmax(F.col(c), F.col(f"{c}__lo"), F.col(f"{c}__hi")) for c in columns}
    return attach(df, fit, keys).withColumns(scaled)


def invert_minmax(scaled: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Adds ``<column>_restored`` to rows that carry the fit and ``<column>_scaled``."""
    return scaled.withColumns(
        {
            f"{c}_restored": minmax_inverse(F.col(f"{c}_scaled"), F.col(f"{c}__lo"), F.col(f"{c}__hi"))
            for c in columns
        }
    )


def lag_window_features(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    value: str,
    lags: int = 60,
    block_rows: int = 50_000,
) -> DataFrame:
    """Each row that has ``lags`` predecessors, with those values in ``window``, oldest first.

    The window runs over numbered blocks with a halo, never over a whole key.
    """
    indexed = df if "row_idx" in df.columns else with_row_index(df, order_by, keys)
    blocks = windowed_blocks(indexed, lags, block_rows)
    order = Window.partitionBy(*keys, "block").orderBy("row_idx")
    past = F.array(*[F.lag(value, n).over(order) for n in range(lags, 0, -1)])
    return (
        blocks.withColumn("window", past)
        .filter(~F.col("is_halo") & (F.col("row_idx") >= lags))
        .drop("block", "is_halo")
    )


def split_temporal(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], train_share: float = 0.7
) -> DataFrame:
    """Earliest ``train_share`` of each key's rows train, the rest test (``is_test``)."""
    indexed = with_row_index(df, order_by, keys)
    return mark_temporal(indexed, keys, train_share)


def mark_temporal(indexed: DataFrame, keys: Sequence[str], train_share: float = 0.7) -> DataFrame:
    """``is_test`` and ``first_test`` for rows that already carry ``row_idx``."""
    sizes = indexed.groupBy(*keys).agg(
        F.ceil(F.count("*") * F.lit(train_share)).alias("first_test")
    )
    return attach(indexed, sizes, keys).withColumn("is_test", F.col("row_idx") >= F.col("first_test"))


def tail_with_context(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    value: str,
    lags: int = 60,
    windows: int | None = 20,
) -> DataFrame:
    """Lag windows of the test rows of a time split, reaching back into the training rows.

    ``windows`` keeps the first so many test rows per key, the ones the forecast is scored on.
    """
    late = split_temporal(df, keys, order_by).filter(F.col("row_idx") >= F.col("first_test") - lags)
    if windows is not None:
        late = late.filter(F.col("row_idx") < F.col("first_test") + windows)
    return lag_window_features(late, keys, order_by, value, lags).filter("is_test")
