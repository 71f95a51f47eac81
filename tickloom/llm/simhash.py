"""Near-duplicates by SimHash: 64-bit fingerprints linked within a few bits through sharded BK-trees.

Two fingerprints that differ in at most ``radius`` bits agree on all but ``radius`` of any ``m`` blocks
of the 64 bits. So each distinct fingerprint goes to one shard for every choice of ``m - radius``
blocks, keyed by their bits, and linked fingerprints share a shard. A shard is a BK-tree: a child hangs
under its parent by its Hamming distance to it, and a search follows only the edges within the radius.
The number of blocks follows the number of fingerprints, so that an ordinary shard stays small; a shard
of more than ``tree_size`` fingerprints becomes several trees, and its fingerprints search all of them.
Shard trees are not broadcast, because together they grow with the corpus: the fingerprints travel to
the trees. Each tree reports a spanning forest of the links it finds, which keeps what is reachable.

Defined cases: a null, empty or white text has fingerprint zero, linked like any other; texts shorter
than a shingle are one shingle; equal rows are linked; an empty table gives an empty result. A null
``doc_id`` never is a component's smallest one unless all are null.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.common import packed
from tickloom.llm.components import components
from tickloom.session import stage

SHINGLE = 3
RADIUS = 3
SEED = 42
TREE_SIZE = 2_000
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
BIT_ROWS = 1 << 16  # shingles whose bits are counted at once


def text_fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, itertools.repeat(SEED)), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BIT_ROWS):
        octets = hashes[at : at + BIT_ROWS].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big", signed=True)


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """The 64 bits as a signed long."""

    def batches(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([text_fingerprint(t, shingle) for t in part], dtype="int64")

    batches.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(batches, "long")(text)


class BKTree:
    """Distinct integers; children hang under their parent by their Hamming distance to it."""

    def __init__(self) -> None:
        self.root: tuple[int, dict] | None = None

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = (value, {})
            return
        node = self.root
        while True:
            distance = (node[0] ^ value).bit_count()
            child = node[1].get(distance)
            if child is None:
                node[1][distance] = (value, {})
                return
            node = child

    def within(self, value: int, radius: int) -> list[int]:
        found, open_nodes = [], [self.root] if self.root else []
        while open_nodes:
            held, children = open_nodes.pop()
            distance = (held ^ value).bit_count()
            if distance <= radius:
                found.append(held)
            for edge, child in children.items():
                if -radius <= edge - distance <= radius:
                    open_nodes.append(child)
        return found


class Forest:
    """Union-find; ``tie`` says whether the two were apart until now."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def top(self, x: int) -> int:
        parent = self.parent
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    def tie(self, x: int, y: int) -> bool:
        x, y = self.top(x), self.top(y)
        self.parent[x] = y
        return x != y


def _tree_links(batches: Iterator[pd.DataFrame], radius: int) -> Iterator[pd.DataFrame]:
    """Rows come sorted by tree, members before searches from other trees of the same shard."""
    now, tree, forest = None, BKTree(), Forest()
    for batch in batches:
        found: list[tuple[int, int]] = []
        for choice, key, part, member, fp in zip(*(batch[c].tolist() for c in ("choice", "key", "part", "member", "fp"))):
            if (choice, key, part) != now:
                now, tree, forest = (choice, key, part), BKTree(), Forest()
            value = fp & 0xFFFFFFFFFFFFFFFF
            found += [(fp, near) for near in tree.within(value, radius) if forest.tie(value, near)]
            if member:
                tree.add(value)
        links = np.array([(a, b) for a, b in found], dtype=object).reshape(-1, 2)
        signed = [b - (1 << 64) if b >> 63 else b for b in links[:, 1]]
        yield pd.DataFrame({"a": pd.Series(links[:, 0], dtype="int64"), "b": pd.Series(signed, dtype="int64")})


def block_masks(blocks: int, radius: int = RADIUS) -> list[int]:
    """For each choice of ``blocks - radius`` of the blocks, the mask of their bits as a signed long."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << (high - low)) - 1) << low for low, high in zip(cuts, cuts[1:])]
    masks = [sum(chosen) for chosen in itertools.combinations(parts, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def blocks_for(fingerprints: int, radius: int = RADIUS, shard: int = 256) -> int:
    """Least number of blocks that leaves about ``shard`` of evenly spread fingerprints in a shard."""
    blocks = radius + 1
    while fingerprints > shard << (64 * (blocks - radius) // blocks) and blocks < 4 * radius:
        blocks += 1
    return blocks


def link(fingerprints: DataFrame, radius: int = RADIUS, tree_size: int = TREE_SIZE) -> DataFrame:
    """``(a, b)``: for distinct fingerprints ``fp``, links that reach all that lie within ``radius``."""
    masks = block_masks(blocks_for(fingerprints.count(), radius), radius)
    choices = ", ".join(f"named_struct('choice', {i}, 'key', fp & {m}L)" for i, m in enumerate(masks))
    shards = fingerprints.select("fp", F.expr(f"inline(array({choices}))"))
    sizes = shards.groupBy("choice", "key").agg(F.count("*").alias("size")).filter("size > 1")
    parts = F.ceil(F.col("size") / tree_size).cast("int")
    searches = (
        shards.join(sizes, ["choice", "key"])
        .select("fp", "choice", "key", parts.alias("parts"))
        .select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        .select("choice", "key", "part", (F.expr("pmod(xxhash64(fp), parts)") == F.col("part")).alias("member"), "fp")
    )
    tree = ["choice", "key", "part"]
    placed = searches.repartition(*tree).sortWithinPartitions(*tree, F.desc("member"), "fp")
    return placed.mapInPandas(lambda batches: _tree_links(batches, radius), "a long, b long")


def classes(rows: DataFrame, order: Column, radius: int = RADIUS) -> DataFrame:
    """``(fp, first)`` for rows with a column ``fp``: the least ``order`` in the class of each fingerprint."""
    nodes = stage(rows.groupBy("fp").agg(F.min(order).alias("least")), "fingerprints")
    labels = components(link(nodes.select("fp"), radius)).withColumnRenamed("node", "fp")
    labelled = nodes.join(labels, "fp", "left").select("fp", "least", F.coalesce("label", "fp").alias("label"))
    first = labelled.groupBy("label").agg(F.min("least").alias("first"))
    return labelled.join(first, "label").select("fp", "first")


def near_duplicates(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id`` of every row."""
    marked = stage(docs.select("doc_id", fingerprint(docs[f"`{text}`"], shingle).alias("fp")), "simhash")
    found = classes(marked, F.col("doc_id"), radius)
    return marked.join(found, "fp").select("doc_id", "fp", F.col("first").alias("component_id"))


def keep_first(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of each class, the one with the smallest ``doc_id`` (null last); of equal ids, any one."""
    marked = stage(
        packed(docs, fp=fingerprint(docs[f"`{text}`"], shingle)).withColumn("place", F.monotonically_increasing_id()), "simhash"
    )
    order = F.struct(F.col("row.doc_id").isNull().alias("absent"), F.col("row.doc_id").alias("doc_id"), "place")
    first = classes(marked, order, radius).select(F.col("first.place").alias("place")).distinct()
    return marked.join(first, "place", "left_semi").select("row.*")
