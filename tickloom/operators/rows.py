"""Row selection, positions and pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.operators.aggregate import exact_ranks
from tickloom.operators.skew import attach, with_row_index
from tickloom.session import stage


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.toDF(*names)


def column_by_position(df: DataFrame, position: int) -> str:
    return df.columns[position]


def slice_rows(
    df: DataFrame, order_by: Sequence[str], start: int, stop: int, keys: Sequence[str] = ()
) -> DataFrame:
    """Rows ``start`` (included) to ``stop`` (excluded) within each key."""
    indexed = with_row_index(df, order_by, keys)
    return indexed.filter((F.col("row_idx") >= start) & (F.col("row_idx") < stop)).drop("row_idx")


def row_number_display(df: DataFrame, order_by: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Running number from 1."""
    return with_row_index(df, order_by, keys).select(
        (F.col("row_idx") + 1).alias("row_number"), *df.columns
    )


def page_rows(
    df: DataFrame, order_by: Sequence[str], keys: Sequence[str] = (), page_size: int = 5
) -> DataFrame:
    """Every row with its page number (from 0) and place on the page; filter on ``page`` to show one."""
    indexed = with_row_index(df, order_by, keys)
    return indexed.select(
        F.floor(F.col("row_idx") / page_size).alias("page"),
        (F.col("row_idx") % page_size).alias("place"),
        *df.columns,
    )


def page_after(df: DataFrame, key: str, last: object | None, page_size: int = 5) -> DataFrame:
    """One page by key: the next ``page_size`` rows beyond ``last`` (None for the first page)."""
    rows = df if last is None else df.filter(F.col(key) > F.lit(last))
    return rows.orderBy(key).limit(page_size)


def show_head(df: DataFrame, order_by: Sequence[str], keys: Sequence[str] = (), n: int = 5) -> DataFrame:
    """First ``n`` rows, of each key if given; map tasks pass on at most ``n`` rows per key."""
    if not keys:
        return df.orderBy(*order_by).limit(n)
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("__rn", F.row_number().over(window)).filter(F.col("__rn") <= n).drop("__rn")


def filter_threshold(df: DataFrame, value: str, limit: float = 3.0) -> DataFrame:
    return df.filter(F.abs(F.col(value)) > limit)


def filter_isin(df: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``wanted`` (reduced to its distinct keys first); null is in no list."""
    listed = wanted.select(*keys).dropna().distinct()
    return df.join(listed, list(keys), "left_semi")


def add_constant(df: DataFrame, name: str = "const") -> DataFrame:
    return df.withColumn(name, F.lit(1.0))


def dropna_thresh(df: DataFrame, thresh: int = 1) -> DataFrame:
    return df.dropna(thresh=thresh)


def fill_zero(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.fillna(0, subset=list(columns) if columns else None)


def hash_bucket(*keys: str, buckets: int = 10, seed: int = 42) -> Column:
    """Stable bucket of a row key: independent of partitioning, so repeatable on a cluster."""
    return F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(buckets))


def split_holdout(df: DataFrame, bucket: Column, test_buckets: int = 3, buckets: int = 10) -> DataFrame:
    """Adds ``is_test``: the upper ``test_buckets`` of ``buckets`` are the test rows."""
    return df.withColumn("is_test", bucket >= buckets - test_buckets)


def split_exact(df: DataFrame, identity: Sequence[str], share: float = 0.3, keys: Sequence[str] = (), seed: int = 42) -> DataFrame:
    """Adds ``is_test`` to ``share`` of the rows of every key, rounded up, drawn by a hash.

    ``identity`` names what tells the rows of a key apart; the draw depends on it and ``seed`` alone, not on
    partitions or file order, and rows of equal identity are drawn together. The hash of the last test row is
    found by exact selection, so no row is sorted or moved for it. A null key is a key.
    """
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in identity])
    hashed = df.withColumns(
        {"__h": F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("long"), "__all": F.lit(0)}
    )
    groups = [*keys, "__all"]
    cut = exact_ranks(hashed, groups, "__h", [(share, f"cast(ceil({share!r}D * __n) as long)")])
    marked = attach(hashed, stage(cut.selectExpr(*[f"`{k}`" for k in groups], "at[0] as __cut"), "split-cut"), groups)
    return marked.withColumn("is_test", F.col("__h") <= F.col("__cut")).drop("__h", "__all", "__cut")


def kfold(df: DataFrame, bucket: Column, folds: int = 5) -> DataFrame:
    return df.withColumn("fold", F.pmod(bucket, F.lit(folds)).cast("int"))
