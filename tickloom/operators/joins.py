"""Joins by position and by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tickloom.operators.skew import with_row_index


def positional_concat(
    left: DataFrame, left_order: Sequence[str], right: DataFrame, right_order: Sequence[str]
) -> DataFrame:
    """Side by side by row position; the shorter side is filled with nulls."""
    a = with_row_index(left, left_order)
    b = with_row_index(right, right_order)
    return a.join(b, "row_idx", "full").select("row_idx", *left.columns, *right.columns)


def keyed_state_join(
    means: DataFrame, mean_key: str, rates: Sequence[DataFrame], crosswalk: DataFrame, rate_key: str
) -> DataFrame:
    """Means keyed by region name with rates keyed by region code, through ``crosswalk``.

    Every input has one row per region, so no key is hot.
    """
    joined = means.join(crosswalk, mean_key)
    for rate in rates:
        joined = joined.join(rate, rate_key)
    return joined


def union_all(*frames: DataFrame) -> DataFrame:
    first, *rest = frames
    for other in rest:
        first = first.unionByName(other)
    return first
