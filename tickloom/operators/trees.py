"""Boosted regression trees for all groups, settings and folds at once, grown level by level as Spark jobs.

Features are cut into quantile bins, and the rows of one group, fold and bin combination are summed
into a *cell*: they take the same path through every tree. Cells are dealt into *blocks* of bounded
size, each with the running predictions of every setting, so a group with a large share of the rows
covers many blocks. A tree is one job: at each level every task adds up the gradients of its blocks by
(setting, node, feature, bin), the sums of a group meet and choose the splits, and these go back to the
blocks; the last step adds the leaves to the predictions, which are written once a tree. The model
never passes through the driver. Groups whose cells fill no more than one block have nothing to
exchange: their sums are whole where they are, and the same steps follow each other in one task. A block is
so large that a level of it costs more than the exchange of its sums, and the settings are dealt out a
few to a task (a *batch*), each batch with its own copy of the cells.

Splits follow the second-order gain and leaf weights of Chen and Guestrin (2016) with squared error, so
the second derivative is the row count. A setting is a leaf penalty and a least gain.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tickloom.operators.linear import PENALTIES
from tickloom.operators.skew import attach, broadcast_limit, dealt
from tickloom.session import stage, stage_instead

NO_FOLD = -1  # trains on every fold
MIN_GAIN = 1e-6
MIN_GAINS = (0.0, 10.0, 100.0, 1000.0, 10_000.0)
BLOCK_CELLS = 1 << 18  # about 20 s and 50 MB for a batch that is grown in one task
BATCH = 4  # most settings of a batch
TASK_BYTES = 1 << 26  # sums that a task holds before it passes them on


@dataclass(frozen=True)
class Growth:
    """Settings that are boosted together, and the shape of their trees."""

    alphas: tuple[float, ...]
    gains: tuple[float, ...]
    features: int
    bins: int
    depth: int
    rate: float
    ridge: float

    @property
    def nodes(self) -> int:
        return (1 << self.depth) - 1

    @property
    def tree_bytes(self) -> int:
        return len(self.alphas) * (4 * self.nodes + 8 * (2 * self.nodes + 1))

    def batches(self) -> dict[int, Growth]:
        """The settings in batches of nearly equal size, by the number of their first one."""
        parts = np.array_split(np.arange(len(self.alphas)), -(-len(self.alphas) // BATCH))
        return {int(p[0]): replace(self, alphas=self.alphas[p[0] : p[-1] + 1], gains=self.gains[p[0] : p[-1] + 1]) for p in parts}


class Tree:
    """One tree of every setting: arrays (setting, node), nodes numbered from the root, children of i at 2i + 1 and 2i + 2."""

    def __init__(self, growth: Growth, octets: bytes = b""):
        self.growth = growth
        shape = len(growth.alphas), growth.nodes
        cells = shape[0] * shape[1]
        if octets:
            splits = np.frombuffer(octets, np.int16, 2 * cells).reshape(2, *shape).copy()
            self.feature, self.cut = splits
            self.value = np.frombuffer(octets, float, -1, 4 * cells).reshape(shape[0], -1).copy()
        else:
            self.feature, self.cut = np.full(shape, -1, np.int16), np.zeros(shape, np.int16)
            self.value = np.zeros((shape[0], 2 * growth.nodes + 1))

    def to_bytes(self) -> bytes:
        return self.feature.tobytes() + self.cut.tobytes() + self.value.tobytes()

    def split(self, level: int, sums: np.ndarray) -> None:
        """Best split of every node of a level, and the values of its children, from the sums of a whole group."""
        growth = self.growth
        alpha = np.array(growth.alphas)[:, None]
        g, h = sums.cumsum(axis=-1)
        whole_g, whole_h = g[0, :, :, -1], h[0, :, :, -1]

        def leaf(gradient: np.ndarray, rows: np.ndarray) -> np.ndarray:
            return -growth.rate * _shrunk(gradient, alpha) / (rows + growth.ridge)

        def score(gradient: np.ndarray, rows: np.ndarray) -> np.ndarray:
            return _shrunk(gradient, alpha[:, :, None]) ** 2 / (rows + growth.ridge)

        first = (1 << level) - 1
        if level == 0:
            self.value[:, :1] = leaf(whole_g, whole_h)
        total_g, total_h = whole_g[:, :, None], whole_h[:, :, None]
        gain = np.round(score(g, h) + score(total_g - g, total_h - h) - score(total_g, total_h), 9)
        gain[(h >= total_h) | (h <= 0)] = -np.inf
        # (setting, node, feature and bin): the first of equal gains is the first feature, then the least cut
        flat = np.moveaxis(gain, 0, 2).reshape(*whole_g.shape, -1)
        best = flat.argmax(axis=-1)
        value = np.take_along_axis(flat, best[:, :, None], -1)[:, :, 0]
        worth = value > MIN_GAIN + np.array(growth.gains)[:, None]
        feature, cut = best // growth.bins, best % growth.bins
        each, node = np.arange(len(alpha))[:, None], np.arange(1 << level)
        left_g, left_h = g[feature, each, node, cut], h[feature, each, node, cut]
        here = slice(first, first + (1 << level))
        self.feature[:, here] = np.where(worth, feature, -1)
        self.cut[:, here] = cut
        children = 2 * (first + node) + 1
        self.value[:, children] = np.where(worth, leaf(left_g, left_h), 0.0)
        self.value[:, children + 1] = np.where(worth, leaf(whole_g - left_g, whole_h - left_h), 0.0)

    def step(self, bins: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Nodes (setting, cell) one level on; a cell stays where no split is."""
        shape, cells, flat = self.value.shape, np.arange(bins.shape[1]), bins.ravel()
        split = self.feature >= 0
        # by node: its first child, the line of its feature in ``flat`` and its cut; where no split is, itself and no bin above
        on, line, cut = np.tile(np.arange(shape[1]), (shape[0], 1)), np.zeros(shape, np.int64), np.full(shape, np.iinfo(np.int16).max, np.int64)
        inner = slice(0, self.growth.nodes)
        on[:, inner] = np.where(split, 2 * on[:, inner] + 1, on[:, inner])
        line[:, inner] = np.where(split, self.feature, 0).astype(np.int64) * len(cells)
        cut[:, inner] = np.where(split, self.cut, cut[:, inner])
        moved = np.empty_like(node)
        tables = np.stack([on, line, cut], axis=1)
        for setting, here in enumerate(node):
            if setting and np.array_equal(tables[setting], tables[setting - 1]) and np.array_equal(here, node[setting - 1]):
                moved[setting] = moved[setting - 1]
                continue
            place = line[setting].take(here)
            place += cells
            np.add(on[setting].take(here), flat.take(place) > cut[setting].take(here), out=moved[setting])
        return moved

    def route(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """Node (setting, cell) after so many levels."""
        node = np.zeros((len(self.feature), bins.shape[1]), np.int64)
        for _ in range(levels):
            node = self.step(bins, node)
        return node


def _shrunk(gradient: np.ndarray, alpha: np.ndarray) -> np.ndarray:
    return np.sign(gradient) * np.maximum(np.abs(gradient) - alpha, 0.0)


class Block:
    """Cells of one group, held-out fold and batch of settings, those trained on first."""

    def __init__(self, growth: Growth, row: dict):
        fold = np.frombuffer(row["folds"], np.int32)
        out = (fold == row["test_fold"]) | (fold == row["held"])
        self.order = np.argsort(out, kind="stable")
        self.trained = len(fold) - int(out.sum())
        self.bins = np.frombuffer(row["bins"], np.int16).reshape(growth.features, -1)[:, self.order].astype(np.int64)
        self.n, self.sy, self.syy = np.frombuffer(row["sums"], float).reshape(3, -1)[:, self.order]
        self.test, self.in_fold = fold[self.order] == row["test_fold"], fold[self.order] == row["held"]
        self.train = ~self.test & ~self.in_fold
        self.pred = np.frombuffer(row["pred"], float).reshape(len(growth.alphas), -1)[:, self.order]

    def sums(self, growth: Growth, node: np.ndarray, level: int) -> np.ndarray:
        """Gradients and rows by (feature, setting, node of the level, bin), given the node of every cell."""
        nodes, width, trained = 1 << level, growth.bins, self.trained
        size = nodes * width
        found = np.zeros((2, growth.features, len(growth.alphas), size))
        bins, rows = self.bins[:, :trained], self.n[:trained]
        places = None
        for setting, (here, pred) in enumerate(zip(node[:, :trained], self.pred)):
            gradient = rows * pred[:trained] - self.sy[:trained]
            # weak penalties mostly split alike: the rows of equal nodes are counted once
            alike = places is not None and np.array_equal(here, node[setting - 1, :trained])
            if not alike:
                # cells that stopped further up fall into one more node, which is left out
                places = np.where(here >= nodes - 1, here - (nodes - 1), nodes) * width + bins
            for feature, at in enumerate(places):
                found[0, feature, setting] = np.bincount(at, weights=gradient, minlength=size)[:size]
                if not alike:
                    found[1, feature, setting] = np.bincount(at, weights=rows, minlength=size)[:size]
            if alike:
                found[1, :, setting] = found[1, :, setting - 1]
        return found.reshape(2, growth.features, len(growth.alphas), nodes, width)

    def add_grown(self, growth: Growth) -> None:
        """A tree of each setting, grown on this block alone."""
        tree = Tree(growth)
        node = tree.route(self.bins, 0)
        for level in range(growth.depth):
            first = (1 << level) - 1
            tree.split(level, self.sums(growth, node, level))
            if (tree.feature[:, first : 2 * first + 1] < 0).all():
                break
            node = tree.step(self.bins, node)
        self.add(tree, node)

    def octets(self) -> bytes:
        """The predictions in the order of the row."""
        pred = np.empty_like(self.pred)
        pred[:, self.order] = self.pred
        return pred.tobytes()

    def add(self, tree: Tree, node: np.ndarray) -> None:
        """The leaves of a whole tree to the predictions."""
        self.pred = self.pred + np.take_along_axis(tree.value, node, 1)


# --- cells and blocks -----------------------------------------------------------------------


def binned_rows(rows: DataFrame, keys: Sequence[str], features: Sequence[str], label: str, bins: int) -> DataFrame:
    """Complete rows with ``bin``: the place of every feature among the quantiles of the group's training rows."""
    known = rows.dropna(subset=[*features, label])
    grid = [i / bins for i in range(1, bins)]
    cuts = known.filter("not is_test").groupBy(*keys).agg(
        *[F.array_distinct(F.percentile_approx(f, grid, 10_000)).alias(f"cuts_{i}") for i, f in enumerate(features)]
    )
    places = ", ".join(f"size(filter(cuts_{i}, c -> c < `{f}`))" for i, f in enumerate(features))
    joined = attach(known, stage(cuts, "tree-cuts"), keys)
    return joined.selectExpr(*[f"`{c}`" for c in rows.columns], f"array({places}) as bin")


def _cells(binned: DataFrame, keys: Sequence[str], label: str, folds: int) -> DataFrame:
    """Sums per (key, fold, bin combination); test rows have the fold after the last."""
    y = F.col(f"`{label}`")
    fold = F.when(F.col("is_test"), folds).otherwise(F.col("fold")).cast("int")
    return binned.groupBy(*keys, fold.alias("fold"), "bin").agg(
        F.count("*").alias("n"), F.sum(y).alias("sy"), F.sum(y * y).alias("syy")
    )


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    condition = F.lit(True)
    for c in columns:
        condition = condition & left[c].eqNullSafe(right[c])
    return condition


def _blocks(cells: DataFrame, keys: Sequence[str], folds: int, growth: Growth) -> DataFrame:
    """Blocks for every held-out fold, all predictions at the mean of the training rows."""
    sizes = cells.groupBy(*keys).agg(F.ceil(F.count("*") / BLOCK_CELLS).alias("blocks"))
    by_hash = attach(cells, sizes, keys).withColumn("block", F.pmod(F.xxhash64("fold", "bin"), F.col("blocks")))
    listed = by_hash.groupBy(*keys, "block", "blocks").agg(
        F.sort_array(F.collect_list(F.struct("fold", "bin", "n", "sy", "syy"))).alias("cell")
    )
    held = F.explode(F.array(*[F.lit(i) for i in (NO_FOLD, *range(folds))])).alias("held")
    sums = cells.filter(F.col("fold") < folds).groupBy(*keys, "fold").agg(F.sum("n").alias("n"), F.sum("sy").alias("sy"))
    means = (
        sums.select("*", held)
        .groupBy(*keys, "held")
        .agg(F.expr("sum(if(fold <> held, sy, 0)) / sum(if(fold <> held, n, 0))").alias("mean"))
    )
    of_keys = [f for f in cells.schema.fields if f.name in keys]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for cell in batch.column("cell"):
                values = cell.values
                bins = values.field("bin").flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)
                sums = [values.field(c).to_numpy(zero_copy_only=False).astype(float) for c in ("n", "sy", "syy")]
                packed.append((
                    np.ascontiguousarray(bins.T, np.int16).tobytes(),
                    values.field("fold").to_numpy(zero_copy_only=False).astype(np.int32).tobytes(),
                    np.stack(sums).tobytes(),
                ))
            columns = [pa.array(c, pa.binary()) for c in zip(*packed)] if packed else [pa.array([], pa.binary())] * 3
            kept = [*keys, "block", "blocks"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *columns], [*kept, "bins", "folds", "sums"])

    numbers = [T.StructField(c, T.LongType()) for c in ("block", "blocks")]
    binary = [T.StructField(c, T.BinaryType()) for c in ("bins", "folds", "sums")]
    blocks = stage(listed.mapInArrow(pack, T.StructType([*of_keys, *numbers, *binary])), "tree-blocks")
    settings = growth.batches()
    first = F.explode(F.array(*[F.lit(i) for i in settings])).alias("first")
    spread, means = blocks.select("*", held).select("*", first), stage(means, "tree-means")
    started = spread.join(means, _same(spread, means, [*keys, "held"]), "left").select(
        *[spread[c] for c in [*keys, "held", "first", "block", "blocks", "bins", "folds", "sums"]], F.coalesce("mean", F.lit(0.0)).alias("mean")
    )

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column("first").to_pylist(), batch.column("folds"), batch.column("mean").to_pylist())
            preds = [np.full(len(settings[i].alphas) * len(fold.as_buffer()) // 4, mean).tobytes() for i, fold, mean in rows]
            names = [c for c in batch.schema.names if c != "mean"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(preds, pa.binary())], [*names, "pred"])

    whole = T.StructType([*started.drop("mean").schema.fields, T.StructField("pred", T.BinaryType())])
    return dealt(started, *keys, "held", "first", "block").mapInArrow(start, whole)


# --- boosting -------------------------------------------------------------------------------


def _with_pred(batch: pa.RecordBatch, preds: list[bytes]) -> pa.RecordBatch:
    names = [c for c in batch.schema.names if c not in ("tree", "pred")]
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(preds, pa.binary())], [*names, "pred"])


class Booster:
    """The blocks of all groups and the jobs that grow trees on them."""

    def __init__(self, blocks: DataFrame, keys: Sequence[str], folds: int, growth: Growth):
        self.group, self.folds, self.batches = [*keys, "held", "first"], folds, growth.batches()
        self.fields = [f for f in blocks.schema.fields if f.name in self.group]
        started = stage(blocks, "tree-start")
        self.alone = started.filter("blocks = 1")
        self.blocks, self.path = started.filter("blocks > 1"), None
        self.groups = stage(self.blocks.select(*self.group).distinct(), "tree-groups")
        self.many = self.groups.count()
        self.small = self.many * max(g.tree_bytes for g in self.batches.values()) <= broadcast_limit(blocks)

    def grow(self, trees: int) -> None:
        for _ in range(trees if self.many else 0):
            self.add_tree()
        self.blocks = self.blocks.unionByName(stage(self._grown_alone(trees), "tree-state"))

    def _grown_alone(self, trees: int) -> DataFrame:
        """All trees of the groups that are one block."""
        settings, folds = self.batches, self.folds

        def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                preds = []
                for row in batch.to_pylist():
                    growth = settings[row["first"]]
                    block = Block(growth, {**row, "test_fold": folds})
                    for _ in range(trees):
                        block.add_grown(growth)
                    preds.append(block.octets())
                yield _with_pred(batch, preds)

        # a fit takes seconds whatever its bytes, and some penalties end at once: many tasks even out
        return dealt(self.alone, *self.group, each=6).mapInArrow(grow, self.alone.schema)

    def _schema(self, *added: str) -> T.StructType:
        return T.StructType([*self.fields, *[T.StructField(c, T.BinaryType()) for c in added]])

    def _with(self, trees: DataFrame) -> DataFrame:
        """Blocks beside the trees of their group: broadcast where all trees together are known to be small."""
        if not self.small:
            return attach(self.blocks, trees, self.group)
        rows = F.broadcast(trees)
        return self.blocks.join(rows, _same(self.blocks, rows, self.group)).select(*[self.blocks[c] for c in self.blocks.columns], "tree")

    def _split(self, trees: DataFrame, level: int) -> DataFrame:
        settings, group, folds = self.batches, self.group, self.folds

        def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[tuple, list] = {}

            def passed_on() -> pa.RecordBatch:
                rows = [(*key, tree, sums.tobytes()) for key, (tree, sums) in held.items()]
                held.clear()
                columns = list(zip(*rows)) if rows else [()] * (len(group) + 2)
                names = [*group, "tree", "sums"]
                return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

            types = None
            for batch in batches:
                types = [*(batch.schema.field(c).type for c in group), pa.binary(), pa.binary()]
                for row in batch.to_pylist():
                    key = tuple(row[c] for c in group)
                    growth = settings[row["first"]]
                    block = Block(growth, {**row, "test_fold": folds})
                    sums = block.sums(growth, Tree(growth, row["tree"]).route(block.bins, level), level)
                    if key in held:
                        held[key][1] += sums
                    else:
                        held[key] = [row["tree"], sums]
                    if len(held) * sums.nbytes > TASK_BYTES:
                        yield passed_on()
            if held:
                yield passed_on()

        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            first, tree, total = None, b"", 0
            for batch in batches:
                first = batch if first is None else first
                tree = batch.column("tree")[0].as_py()
                for sums in batch.column("sums"):
                    total = total + np.frombuffer(sums.as_py(), float)
            growth = settings[first.column("first")[0].as_py()]
            grown = Tree(growth, tree)
            shape = 2, growth.features, len(growth.alphas), 1 << level, growth.bins
            grown.split(level, total.reshape(shape))
            key = [first.column(c).slice(0, 1) for c in group]
            yield pa.RecordBatch.from_arrays([*key, pa.array([grown.to_bytes()], pa.binary())], [*group, "tree"])

        partial = self._with(trees).mapInArrow(add_up, self._schema("tree", "sums"))
        return partial.groupBy(*group).applyInArrow(choose, self._schema("tree"))

    def add_tree(self) -> None:
        """One job: a level is a sum over the blocks of every group, the end adds the leaves."""
        settings, folds = self.batches, self.folds
        trees = self.groups.withColumn("tree", F.lit(b""))
        for level in range(next(iter(settings.values())).depth):
            trees = self._split(trees, level)

        def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                preds = []
                for row in batch.to_pylist():
                    growth = settings[row["first"]]
                    block = Block(growth, {**row, "test_fold": folds})
                    tree = Tree(growth, row["tree"])
                    block.add(tree, tree.route(block.bins, growth.depth))
                    preds.append(block.octets())
                yield _with_pred(batch, preds)

        self.blocks, self.path = stage_instead(self._with(trees).mapInArrow(step, self.blocks.schema), "tree-state", self.path)

    def errors(self) -> DataFrame:
        """Mean squared errors ``(group, setting, held_mse, test_mse, train_mse)`` of every setting."""
        settings, folds = self.batches, self.folds
        group = self.group[:-1]
        parts = ("in_fold", "test", "train")

        def loss(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    block = Block(settings[row["first"]], {**row, "test_fold": folds})
                    by_cell = block.syy - 2 * block.pred * block.sy + block.n * block.pred**2
                    columns = [pa.array(row["first"] + np.arange(len(by_cell)), pa.int32())]
                    for part in parts:
                        mask = getattr(block, part)
                        columns += [pa.array(by_cell[:, mask].sum(axis=1)), pa.array(np.full(len(by_cell), block.n[mask].sum()))]
                    key = [pa.array([row[c]] * len(by_cell), batch.schema.field(c).type) for c in group]
                    yield pa.RecordBatch.from_arrays([*key, *columns], schema.names)

        values = [T.StructField(f"{p}_{c}", T.DoubleType()) for p in parts for c in ("loss", "n")]
        schema = T.StructType([*self.fields[:-1], T.StructField("setting", T.IntegerType()), *values])
        names = {"in_fold": "held_mse", "test": "test_mse", "train": "train_mse"}
        return self.blocks.mapInArrow(loss, schema).groupBy(*group, "setting").agg(
            *[F.expr(f"sum({p}_loss) / nullif(sum({p}_n), 0)").alias(names[p]) for p in parts]
        )

    def predictions(self) -> DataFrame:
        """``(keys, first, fold, bin, pred)`` of the fits on every fold: predictions of a batch of settings for each cell."""
        settings, group = self.batches, [c for c in self.group if c != "held"]

        def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    growth = settings[row["first"]]
                    bins = np.frombuffer(row["bins"], np.int16).reshape(growth.features, -1).T.astype(np.int32)
                    fold = np.frombuffer(row["folds"], np.int32)
                    pred = np.frombuffer(row["pred"], float).reshape(len(growth.alphas), -1).T
                    key = [pa.array([row[c]] * len(fold), batch.schema.field(c).type) for c in group]
                    yield pa.RecordBatch.from_arrays([*key, pa.array(fold), pa.array(list(bins)), pa.array(list(pred))], schema.names)

        fields = [f for f in self.fields if f.name in group]
        arrays = [T.StructField("bin", T.ArrayType(T.IntegerType())), T.StructField("pred", T.ArrayType(T.DoubleType()))]
        schema = T.StructType([*fields, T.StructField("fold", T.IntegerType()), *arrays])
        return self.blocks.filter(F.col("held") == NO_FOLD).mapInArrow(unpack, schema)


def boost(
    binned: DataFrame,
    keys: Sequence[str],
    features: Sequence[str],
    label: str,
    settings: Sequence[tuple[float, float]],
    folds: int,
    trees: int,
    depth: int,
    rate: float,
    ridge: float,
    bins: int,
) -> Booster:
    """All ``settings`` (leaf penalty, least gain), held-out folds and groups boosted side by side."""
    growth = Growth(
        tuple(float(a) for a, _ in settings), tuple(float(g) for _, g in settings), len(features), bins, depth, rate, ridge
    )
    cells = stage(_cells(binned, keys, label, folds), "tree-cells")
    booster = Booster(_blocks(cells, keys, folds, growth), keys, folds, growth)
    booster.grow(trees)
    return booster


def _chosen(booster: Booster, keys: Sequence[str], values: Sequence[float]) -> tuple[DataFrame, DataFrame]:
    """Cross-validated error of every setting, and the errors of the refit with the best one."""
    tried = F.array(*[F.lit(float(v)) for v in values])
    errors = stage(booster.errors().withColumn("tried", F.get(tried, F.col("setting"))), "tree-errors")
    scores = errors.filter(F.col("held") != NO_FOLD).groupBy(*keys, "setting", "tried").agg(
        F.abs(F.avg("held_mse")).alias("cv_error")
    )
    best = scores.groupBy(*keys).agg(F.expr("min_by(setting, struct(cv_error, setting)) as setting"))
    refit = errors.filter(F.col("held") == NO_FOLD)
    return scores, refit.join(best, _same(refit, best, [*keys, "setting"])).select(*[refit[c] for c in refit.columns])


def _metric_rows(scores: DataFrame, refit: DataFrame, keys: Sequence[str], model: str, best: str, param: str) -> DataFrame:
    chosen = refit.selectExpr(
        *keys, f"stack(3, '{best}', tried, 'train_mse', train_mse, 'test_mse', test_mse) as (metric, value)"
    ).selectExpr(*keys, "metric", "'' as param", "value")
    tried = scores.selectExpr(*keys, "'cv_error' as metric", f"format_string('{param}', tried) as param", "cv_error as value")
    return chosen.unionByName(tried).selectExpr(*keys, f"'{model}' as model", "metric", "param", "value")


def boosted_trees_l1(
    rows: DataFrame,
    keys: Sequence[str],
    features: Sequence[str],
    label: str,
    penalties: Sequence[float] = PENALTIES,
    folds: int = 5,
    trees: int = 100,
    depth: int = 6,
    rate: float = 0.3,
    ridge: float = 1.0,
    bins: int = 32,
) -> DataFrame:
    """Choice of the leaf penalty by cross-validation over ``fold``, refit on all training rows, test error.

    ``rows`` carry ``is_test`` and ``fold``. ``bins`` is the most bins of a feature; it decides where
    splits can fall. Metric rows ``(*keys, model, metric, param, value)``.
    """
    binned = binned_rows(rows.select(*keys, "is_test", "fold", *features, label), keys, features, label, bins)
    booster = boost(binned, keys, features, label, [(p, 0.0) for p in penalties], folds, trees, depth, rate, ridge, bins)
    scores, refit = _chosen(booster, keys, penalties)
    return _metric_rows(scores, refit, keys, "boosted_trees", "best_penalty", "%.0e")


def boosted_trees_cv(
    rows: DataFrame,
    keys: Sequence[str],
    features: Sequence[str],
    label: str,
    min_gains: Sequence[float] = MIN_GAINS,
    folds: int = 5,
    trees: int = 100,
    depth: int = 6,
    rate: float = 0.3,
    ridge: float = 1.0,
    bins: int = 32,
) -> DataFrame:
    """The same search over the least gain of a split, which prunes trees instead of shrinking leaves."""
    binned = binned_rows(rows.select(*keys, "is_test", "fold", *features, label), keys, features, label, bins)
    booster = boost(binned, keys, features, label, [(0.0, g) for g in min_gains], folds, trees, depth, rate, ridge, bins)
    scores, refit = _chosen(booster, keys, min_gains)
    return _metric_rows(scores, refit, keys, "gbt", "best_min_gain", "%.0e")


def boosted_predictions(
    rows: DataFrame,
    keys: Sequence[str],
    features: Sequence[str],
    label: str,
    penalties: Sequence[float] = PENALTIES,
    folds: int = 5,
    trees: int = 100,
    depth: int = 6,
    rate: float = 0.3,
    ridge: float = 1.0,
    bins: int = 32,
) -> tuple[DataFrame, DataFrame]:
    """Test rows with ``prediction`` by the chosen penalty, and the metric rows of ``boosted_trees_l1``."""
    binned = stage(binned_rows(rows, keys, features, label, bins), "tree-rows")
    booster = boost(binned, keys, features, label, [(p, 0.0) for p in penalties], folds, trees, depth, rate, ridge, bins)
    scores, refit = _chosen(booster, keys, penalties)
    scores, refit = stage(scores, "tree-scores"), stage(refit, "tree-refit")
    cells = booster.predictions().filter(F.col("fold") == folds).drop("fold")
    of_best = attach(cells, refit.select(*keys, "setting"), keys).filter("setting >= first and setting < first + size(pred)")
    of_best = of_best.selectExpr(*keys, "bin", "pred[setting - first] as prediction")
    test = binned.filter("is_test")
    predicted = attach(test, stage(of_best, "tree-predictions"), [*keys, "bin"]).drop("bin")
    return predicted, _metric_rows(scores, refit, keys, "boosted_trees", "best_penalty", "%.0e")
