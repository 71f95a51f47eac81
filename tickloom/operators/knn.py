"""Exact k-nearest-neighbour regression without comparing every query with every training row.

Training rows are split into small cells by repeated quantile cuts, one feature after the other.
A query first looks into its own cell, which bounds the distance of its k-th neighbour, and then
visits only the cells that its bound reaches; pairs beyond the bound are dropped inside that join.
Cuts and cell boxes are small written tables. Copies of one point are reduced to the ``k`` with the
smallest ids, as no others can be among the neighbours.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.operators.features import fit_minmax
from tickloom.operators.skew import attach, dealt
from tickloom.session import stage

_GRID = 64  # most cuts made at one level
_FEW_PARTS = 8  # parts per level below which a node is cut along fewer features
_SLACK = 1.0 + 1e-9  # keeps rounding from excluding a cell at the exact distance


class _Space:
    """Columns of one neighbour search, and distances over them as SQL text."""

    def __init__(self, keys: Sequence[str], features: Sequence[str]):
        self.keys = list(keys)
        self.features = list(features)
        self.node = [*keys, "path"]

    def _squares(self, gap: str) -> str:
        """Sum over the features, in their order, of the squared ``gap`` in units of the range."""
        scaled = [f"(({gap.replace('@', f)}) / {f}__range)" for f in self.features]
        return " + ".join(f"{s} * {s}" for s in scaled)

    def distance_sq(self, point: str) -> str:
        """``point`` is the column name of a feature of the training point, ``@`` standing for the feature."""
        return self._squares(f"@ - {point}")

    def box_nearest_sq(self) -> str:
        return self._squares("greatest(@__min - @, @ - @__max, 0e0)")

    def box_farthest_sq(self) -> str:
        return self._squares("greatest(abs(@__min - @), abs(@ - @__max))")


def _describe_nodes(points: DataFrame, space: _Space, depth: int, cell_rows: int) -> DataFrame:
    """Row count, box and cut values of every node of one level."""
    feature = space.features[depth % len(space.features)]
    ahead = max(len(space.features) - depth, 1)
    boxes = [m(f).alias(f"{f}__{n}") for f in space.features for n, m in (("min", F.min), ("max", F.max))]
    quantiles = F.percentile_approx(feature, [i / _GRID for i in range(1, _GRID)], 10_000)
    nodes = points.groupBy(*space.node).agg(F.count("*").alias("n"), *boxes, quantiles.alias("grid"))
    # a node far too large is cut a little along each feature ahead, a smaller one more along fewer
    wanted = f"(n / {cell_rows})"
    levels = f"greatest(1, least({ahead}, ceil(ln({wanted}) / ln({_FEW_PARTS}))))"
    parts = F.expr(f"cast(least({_GRID}, ceil(power({wanted}, 1e0 / {levels}))) as int)")
    chosen = F.expr(
        f"transform(sequence(1, parts - 1), i -> grid[cast(ceil(i * {_GRID} / parts) as int) - 1])"
    )
    cuts = F.filter(F.array_distinct(chosen), lambda c: c < F.col(f"{feature}__max"))
    return (
        nodes.withColumn("parts", parts)
        .withColumn("cuts", F.when(F.col("parts") > 1, cuts).otherwise(F.array().cast("array<double>")))
        .drop("grid", "parts")
    )


def _slab(value: str) -> str:
    """Place of a value among the cuts; a slab holds the values up to and including its cut."""
    return f"size(filter(cuts, c -> c < {value}))"


def _child(slab: str) -> Column:
    return F.expr(f"concat(path, '/', cast({slab} as string))")


def _build_cells(points: DataFrame, space: _Space, cell_rows: int) -> tuple[DataFrame, list[DataFrame]]:
    """Points with their final path, and the node table of every level, the last one holding the cells."""
    points = points.withColumn("path", F.lit(""))
    levels: list[DataFrame] = []
    fruitless = 0
    while True:
        depth = len(levels)
        nodes = stage(_describe_nodes(points, space, depth, cell_rows), "knn-nodes")
        levels.append(nodes)
        largest, cut = nodes.agg(F.max("n"), F.max(F.size("cuts"))).first() or (None, None)
        fruitless = 0 if cut else fruitless + 1
        if largest is None or largest <= cell_rows or fruitless == len(space.features):
            return points, levels
        value = space.features[depth % len(space.features)]
        points = stage(
            attach(points, nodes.select(*space.node, "cuts"), space.node)
            .withColumn("path", _child(_slab(value)))
            .drop("cuts"),
            "knn-points",
        )


def nearest_neighbours(
    train: DataFrame,
    queries: DataFrame,
    keys: Sequence[str],
    features: Sequence[str],
    train_id: str,
    label: str,
    k: int,
    cell_rows: int = 64,
) -> DataFrame:
    """The k nearest training rows of every distinct query point, ``rank`` from 1.

    Distance is Euclidean over features divided by their training range (by 1 if constant), ties go
    to the smaller ``train_id``. Returns ``(*keys, *features, rank, id, label, d2)``.
    """
    space = _Space(keys, features)
    complete = reduce(lambda a, b: a & b, [F.col(f).isNotNull() for f in features])
    fit = fit_minmax(train, keys, features)
    ranges = stage(
        fit.select(
            *keys,
            *[
                F.when(F.col(f"{f}__hi") > F.col(f"{f}__lo"), F.col(f"{f}__hi") - F.col(f"{f}__lo"))
                .otherwise(1.0)
                .alias(f"{f}__range")
                for f in features
            ],
        ),
        "knn-ranges",
    )
    copies = Window.partitionBy(*keys, *features).orderBy("id")
    points = stage(
        train.filter(complete & F.col(label).isNotNull())
        .select(*keys, *features, F.col(train_id).alias("id"), F.col(label).alias("label"))
        .withColumn("copy", F.row_number().over(copies))
        .filter(F.col("copy") <= k)
        .drop("copy"),
        "knn-points",
    )
    points, levels = _build_cells(points, space, cell_rows)

    # up to about cell_rows points of each cell, all of them unless no cut could divide it; they
    # only bound the k-th distance
    sizes = levels[-1].selectExpr(*space.node, f"ceil(n / {cell_rows}) as pieces")
    sample = stage(
        attach(points, sizes, space.node)
        .filter("pmod(xxhash64(id, label), pieces) = 0")
        .groupBy(*space.node)
        .agg(F.collect_list(F.struct(*features)).alias("sample")),
        "knn-sample",
    )

    # a query looks through many points, so a few bytes of queries are work for all cores
    asked = stage(
        dealt(attach(queries.filter(complete).select(*keys, *features).distinct(), ranges, keys), *keys, *features),
        "knn-queries",
    )
    bounded = asked.withColumn("path", F.lit("")).withColumn("bound", F.lit(float("inf")))
    for depth, nodes in enumerate(levels):
        reach = F.expr(f"case when n >= {k} then {space.box_farthest_sq()} end")
        path = _child(_slab(features[depth % len(features)])) if depth < len(levels) - 1 else F.col("path")
        bounded = attach(bounded, nodes, space.node, salts=1).select(
            *asked.columns, path.alias("path"), F.least("bound", reach).alias("bound")
        )
    seen = f"array_sort(transform(sample, p -> {space.distance_sq('p.@')}))"
    bounded = stage(
        attach(bounded, sample, space.node, how="left", salts=1)
        .withColumn("bound", F.expr(f"least(bound, get({seen}, {k - 1})) * {_SLACK!r}"))
        .drop("sample", "path"),
        "knn-bounds",
    )

    visits = bounded.withColumn("path", F.lit(""))
    for depth, nodes in enumerate(levels):
        visits = attach(visits, nodes, space.node, salts=1).filter(f"{space.box_nearest_sq()} <= bound")
        if depth < len(levels) - 1:
            f = features[depth % len(features)]
            reach = f"sqrt(bound) * {f}__range * {_SLACK!r}"
            slabs = f"sequence({_slab(f'{f} - {reach}')}, {_slab(f'{f} + {reach}')})"
            visits = visits.selectExpr("*", f"explode({slabs}) as slab").withColumn("path", _child("slab"))
        visits = visits.select(*bounded.columns, "path")

    distance = space.distance_sq("@__point")
    candidates = points.selectExpr(*space.node, "id", "label", *[f"{f} as {f}__point" for f in features])
    found = (
        attach(visits, candidates, space.node, salts=1)
        .filter(f"{distance} <= bound")
        .selectExpr(*keys, *features, f"{distance} as d2", "id", "label")
    )
    order = Window.partitionBy(*keys, *features).orderBy("d2", "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def knn_predict(
    train: DataFrame,
    queries: DataFrame,
    keys: Sequence[str],
    features: Sequence[str],
    train_id: str,
    label: str,
    k: int,
    cell_rows: int = 64,
) -> DataFrame:
    """Query rows with the mean label of their 1, 2, ... k nearest as ``pred_1`` ... ``pred_k``."""
    hits = nearest_neighbours(train, queries, keys, features, train_id, label, k, cell_rows)
    means = [
        F.avg(F.when(F.col("rank") <= j, F.col("label"))).alias(f"pred_{j}") for j in range(1, k + 1)
    ]
    by_point = hits.groupBy(*keys, *features).agg(*means)
    return attach(queries, by_point, [*keys, *features], how="left", salts=1)


def knn_errors(predicted: DataFrame, keys: Sequence[str], label: str, k: int) -> DataFrame:
    """Mean squared error of every neighbour count: ``(*keys, k, mse)``, from one pass."""
    errors = [
        F.avg((F.col(label) - F.col(f"pred_{j}")) * (F.col(label) - F.col(f"pred_{j}"))).alias(f"e{j}")
        for j in range(1, k + 1)
    ]
    cases = ", ".join(f"{j}, e{j}" for j in range(1, k + 1))
    return predicted.groupBy(*keys).agg(*errors).selectExpr(*keys, f"stack({k}, {cases}) as (k, mse)")
