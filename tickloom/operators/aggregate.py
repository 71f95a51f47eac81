"""Group means, summary statistics, counts, error measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.functions.values import nan_to_null
from tickloom.operators.skew import attach
from tickloom.session import stage

# fixed value: ranks of the quantile sketch are exact up to half as many rows per group, beyond that they
# are off by at most the rows divided by it
SKETCH_ACCURACY = 200_000
QUARTILES = [(p, f"greatest(cast(ceil({p}D * __n) as long), 1L)") for p in (0.25, 0.5, 0.75)]


def group_mean(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Mean per key, skipping nulls and NaN; rows with a null key do not form a group."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(*[F.avg(nan_to_null(c)).alias(c) for c in columns])
        .orderBy(key)
    )


def exact_ranks(
    rows: DataFrame,
    keys: Sequence[str],
    value: str,
    ranks: Sequence[tuple[float, str]],
    also: Sequence[Column] = (),
) -> DataFrame:
    """Values at several ranks of every group, exact for any group size: ``(*keys, n, *also, at)``.

    A rank is its share of the rows and its number in terms of ``__n``, the rows of the group with a value.
    ``also`` are further aggregates of the same pass. The first pass is one sketch for all ranks; it is exact
    for groups of up to half its size. For a larger group it gives two values that surely enclose each
    rank: the second pass counts the rows below them, and ranks the distinct values between, which are those of
    about one row in 25,000 for each rank. Without a larger group nothing is read a second time.
    """
    known = rows.select(*keys, F.col(value).alias("__v"))
    margin = 4.0 / SKETCH_ACCURACY
    marks = [min(max(share + m, 0.0), 1.0) for share, _ in ranks for m in (-margin, 0.0, margin)]
    sketch = stage(
        rows.withColumn("__v", F.col(value))
        .groupBy(*keys)
        .agg(F.count("__v").alias("__n"), F.percentile_approx("__v", marks, SKETCH_ACCURACY).alias("__q"), *also),
        "rank-sketch",
    )
    own = [c for c in sketch.columns if c not in ("__n", "__q")]
    places = range(len(ranks))
    is_small = f"__n <= {SKETCH_ACCURACY // 2}"
    small = sketch.filter(is_small).selectExpr(*own, "__n as n", f"array({', '.join(f'__q[{3 * j + 1}]' for j in places)}) as at")
    large = sketch.filter(f"not {is_small}")
    bounds = large.selectExpr(
        *keys,
        f"""array({', '.join(f"struct({j} as place, {rank} as rank, __q[{3 * j}] as low, __q[{3 * j + 2}] as high)" for j, (_, rank) in enumerate(ranks))}) as __bounds""",
    )
    # one row for each value: from which ranks' bounds on it lies, and itself where it lies within any
    reached = " | ".join(f"if(__v >= __q[{3 * j}], {1 << j}, 0)" for j in places)
    within = " or ".join(f"__v between __q[{3 * j}] and __q[{3 * j + 2}]" for j in places)
    below = " or ".join(f"__v <= __q[{3 * j + 2}]" for j in places)
    values = (
        attach(known, large.select(*keys, "__q"), keys)
        .filter(below)
        .selectExpr(*keys, f"{reached} as __reached", f"if({within}, __v, null) as __v")
        .groupBy(*keys, "__reached", "__v")
        .agg(F.count("*").alias("__c"))
    )
    counted = (
        attach(values, bounds, keys)
        .selectExpr(
            *keys, "__v", "__c",
            "explode(filter(__bounds, b -> if(__v is null, getbit(__reached, b.place) = 0, __v <= b.high))) as __b",
        )
        .selectExpr(*keys, "__b.place as __place", "__b.rank as __rank", "if(__v >= __b.low, __v, null) as __v", "__c")
        .groupBy(*keys, "__place", "__rank", "__v")
        .agg(F.sum("__c").alias("__c"))
    )
    order = ", ".join([f"`{k}`" for k in keys] + ["__place"])
    ranked = counted.selectExpr("*", f"sum(__c) over (partition by {order} order by __v nulls first) as __upto")
    found = ranked.groupBy(*keys, "__place").agg(F.expr("min(if(__upto >= __rank, __v, null)) as __v"))
    at = found.groupBy(*keys).agg(F.expr("transform(array_sort(collect_list(struct(__place, __v))), s -> s.__v) as at"))
    return small.unionByName(attach(large, at, keys, salts=1).selectExpr(*own, "__n as n", "at"))


def describe_columns(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles per key and column.

    Long form ``(*keys, column, count, mean, stddev, min, p25, p50, p75, max)``. A quartile is the least value
    with at least that share of the values up to it.
    """
    cases = ", ".join(f"'{c}', cast(`{c}` as double)" for c in columns)
    long = df.selectExpr(*[f"`{k}`" for k in keys], f"stack({len(columns)}, {cases}) as (`column`, __value)")
    also = [
        F.avg("__value").alias("mean"), F.stddev_samp("__value").alias("stddev"), F.min("__value").alias("min"), F.max("__value").alias("max")
    ]
    found = exact_ranks(long, [*keys, "column"], "__value", QUARTILES, also)
    quartiles = [F.col("at")[i].alias(p) for i, p in enumerate(["p25", "p50", "p75"])]
    return found.select(*keys, "column", F.col("n").alias("count"), "mean", "stddev", "min", *quartiles, "max")


def exact_median(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Median per key, the mean of both middle values for an even count."""
    # just above one half, for the upper of two middle values
    middle = [(0.5, "(__n + 1) div 2"), (0.5 + 1e-9, "__n div 2 + 1")]
    found = exact_ranks(rows.filter(F.col(value).isNotNull()), keys, value, middle)
    return found.selectExpr(*[f"`{k}`" for k in keys], "(at[0] + at[1]) / 2 as median")


def summary_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Spark's own summary layout: one text row per statistic, one column per input column."""
    return df.select(*columns).summary()


def count_by(df: DataFrame, key: Column, name: str) -> DataFrame:
    return df.groupBy(key.alias(name)).count()


def mse(label: Column, prediction: Column) -> Column:
    return F.avg((label - prediction) * (label - prediction))


def argmin_first(errors: DataFrame, keys: Sequence[str], candidate: str, error: str) -> DataFrame:
    """Candidate with the least error per key; on a tie the smallest candidate."""
    best = F.min_by(F.struct(candidate, error), F.struct(error, candidate))
    return errors.groupBy(*keys).agg(best.alias("best")).select(*keys, "best.*")


def cv_score(fold_errors: DataFrame, keys: Sequence[str], error: str) -> DataFrame:
    return fold_errors.groupBy(*keys).agg(F.abs(F.avg(error)).alias("cv_error"))


def rank_by_error(errors: DataFrame, keys: Sequence[str], candidate: str, error: str) -> DataFrame:
    """Candidates of each key in order of error; there is one row per fitted candidate."""
    window = Window.partitionBy(*keys).orderBy(error, candidate)
    return errors.withColumn("rank", F.row_number().over(window))


def compare_predictions(table: DataFrame, keys: Sequence[str], label: str, models: Sequence[str]) -> DataFrame:
    """Mean squared errors of several models on the rows that all of them predict, and how sure the order is.

    ``table`` has one column of predictions for each model. Per key: ``n`` common rows, the error of every model
    under its name, ``best`` and ``second`` (ties in the order of ``models``), and ``t``, the mean of the
    second's squared error less the best's over its standard error; null where all differences are equal.
    """
    squares = [(F.col(f"`{m}`") - F.col(f"`{label}`")) * (F.col(f"`{m}`") - F.col(f"`{label}`")) for m in models]
    common = stage(table.select(*keys, F.array(*squares).alias("e")).filter("not exists(e, v -> v is null or isnan(v))"), "errors")
    wide = common.groupBy(*keys).agg(F.count("*").alias("n"), *[F.avg(F.col("e")[i]).alias(m) for i, m in enumerate(models)])
    places = ", ".join(f"struct(`{m}` as mse, {i} as place, '{m}' as model)" for i, m in enumerate(models))
    ranked = stage(wide.selectExpr("*", f"array_sort(array({places})) as ranked"), "ranked")
    pairs = attach(common, ranked.select(*keys, "ranked"), keys).selectExpr(
        *[f"`{k}`" for k in keys], "e[ranked[1].place] - e[ranked[0].place] as d"
    )
    tested = pairs.groupBy(*keys).agg(F.expr("avg(d) / nullif(stddev_samp(d) / sqrt(count(d)), 0)").alias("t"))
    return attach(ranked, tested, keys, salts=1).selectExpr(
        *[f"`{k}`" for k in keys], "n", *[f"`{m}`" for m in models], "ranked[0].model as best", "ranked[1].model as second", "t"
    )
