"""Suffix-array dedup: byte strings of ``LENGTH`` that start in two places, by a difference cover.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts anywhere else, in the same
document or another. Winnowed anchors, a locally consistent sample of the positions, deal the work:
two equal strings have the same anchor, so the stretches of text around one anchor meet in one shard,
and anchors that occur once are left out. Each shard builds the suffix array of its stretches: the
triples at two of three positions are sorted and named, the names are sorted by recursion, the
remaining suffixes are sorted by what follows them and merged in. Then neighbours whose first
``LENGTH`` bytes are equal are marked. Copies of a stretch enter a shard's array once. Every string of
the input starts in exactly one stretch, so nothing is met twice.

Defined cases: a null text has no bytes; a text shorter than ``LENGTH`` keeps all; rows that repeat
are each other's copies; a null id is an id like any other; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm import anchors
from tickloom.llm.common import LAST, identified
from tickloom.session import stage

LENGTH = 400
GRAM = 32
SHARD_BYTES = 1_000_000
CHUNK_BYTES = 1 << 18  # the arrays over a chunk stay in the cache


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order, by the difference cover {1, 2} modulo 3; symbols are above zero."""
    n = len(symbols)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: symbols[i:].tolist()), np.int64)
    s = np.zeros(n + 4, np.uint64)
    s[:n] = symbols
    n1, n2 = (n + 2) // 3, n // 3  # places 1 and 2 modulo 3; as many 0 as 1, by the empty suffix where n is 1
    width = np.uint64(int(s.max()).bit_length())
    rank_width = np.uint64((n1 + n2).bit_length())
    two = (s[:-1] << width) | s[1:]  # a number for two symbols, in their order
    if 2 * width + max(width, rank_width) > 64:
        two = np.unique(two, return_inverse=True)[1].astype(np.uint64)
    triples = (two[:-1] << width) | s[2:]
    triples = np.concatenate([triples[1::3][:n1], triples[2::3][:n2]])
    order = np.argsort(triples)
    triples = triples[order]
    new = np.concatenate([[True], triples[1:] != triples[:-1]])
    if not new.all():
        names = np.empty(n1 + n2, np.uint32)
        names[order] = np.cumsum(new, dtype=np.uint32)
        order = suffix_array(names)
    rank = np.empty(n1 + n2, np.uint32)
    rank[order] = np.arange(1, n1 + n2 + 1, dtype=np.uint32)
    rank1, rank2 = np.zeros(n1 + 1, np.uint32), np.zeros(n1, np.uint32)
    rank1[:n1], rank2[:n2] = rank[:n1], rank[n1:]

    is_one = order < n1
    first, second = order[is_one], order[~is_one] - n1
    by_one = np.sort((s[0:n:3] << rank_width) | rank1[:n1])
    zeros = order[(by_one & ((np.uint64(1) << rank_width) - np.uint64(1))).astype(np.int64) - 1]
    by_two = ((two[0:n:3] << rank_width) | rank2)[zeros]
    # each of the two is in order on both sides
    before = np.searchsorted(((s[1::3][:n1] << rank_width) | rank2)[first], by_one)
    before += np.searchsorted(((two[2::3][:n2] << rank_width) | rank1[1 : n2 + 1])[second], by_two)
    merged = np.empty(n1 + n1 + n2, np.int64)
    others = np.ones(len(merged), bool)
    before += np.arange(n1)
    merged[before] = 3 * zeros
    others[before] = False
    merged[others] = np.where(is_one, 3 * order + 1, 3 * (order - n1) + 2)
    return merged[1:] if n % 3 == 1 else merged  # the empty suffix comes first


def repeated_starts(stretches: list[bytes], length: int) -> np.ndarray:
    """Marks, over the stretches laid end to end, where a string starts that also starts elsewhere in them."""
    octets = np.frombuffer(b"".join(stretches), np.uint8)
    sizes = np.fromiter(map(len, stretches), np.int64, len(stretches))
    # one separator after each stretch, so that no order depends on what happens to follow it
    gaps = np.cumsum(sizes + 1) - 1
    plain = np.ones(len(octets) + len(sizes), bool)
    plain[gaps] = False
    spaced = np.ones(len(plain), np.uint16)
    spaced[plain] = octets.astype(np.uint16) + np.uint16(2)
    # strings that end within their stretch; what stands between two equal ones in the order is equal too
    whole = np.arange(len(plain)) + length <= np.repeat(gaps, sizes + 1)
    order = suffix_array(spaced)
    order = order[whole[order]]
    starts = (np.cumsum(plain) - 1)[order]  # places without the separators
    hashes = anchors.gram_hashes(octets, length)[starts]
    same = hashes[1:] == hashes[:-1]
    marks = np.zeros(len(octets), bool)
    marks[starts[1:][same]] = True
    marks[starts[:-1][same]] = True
    return marks


def _text_runs(texts: pa.Array, length: int, gram: int):
    for row, octets, offsets in anchors.chunks(texts, CHUNK_BYTES):
        anchor, start, count, text, places = anchors.byte_runs(octets, offsets, length, gram)
        yield anchor, start, count, places, text, row, octets, offsets


def _anchor_rows(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("id").to_numpy(zero_copy_only=False)
        for anchor, _, _, places, text, row, *_ in _text_runs(batch.column("content"), length, gram):
            columns = [pa.array(anchor.view(np.int64)), pa.array(ids[row + text].astype(np.int64)), pa.array(places)]
            yield pa.RecordBatch.from_arrays(columns, ["anchor", "id", "places"])


def _stretch_rows(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    """The bytes that the windows of each listed run cover, with the place of the first in its text."""
    for batch in batches:
        ids, keys = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "key"))
        for anchor, start, count, _, text, row, octets, offsets in _text_runs(batch.column("content"), length, gram):
            hit = anchors.listed(anchor, text, batch.column("anchors").slice(row, len(offsets) - 1))
            first, past = start[hit], start[hit] + count[hit] + length - 1
            raw = octets.tobytes()
            cut = [raw[a:b] for a, b in zip(first.tolist(), past.tolist())]
            columns = [
                pa.array(anchor[hit].view(np.int64)), pa.array(ids[row + text[hit]].astype(np.int64)), pa.array(keys[row + text[hit]].astype(np.int64)),
                pa.array(first - offsets[text[hit]]), pa.array(cut, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["anchor", "id", "key", "first", "stretch"])


class _Shard:
    """Distinct stretches, how often each occurs, and where."""

    def __init__(self) -> None:
        self.stretches: dict[bytes, list] = {}
        self.places: list[tuple[int, int, int, list]] = []
        self.size = 0

    def add(self, id_: int, key: int, first: int, stretch: bytes) -> None:
        held = self.stretches.get(stretch)
        if held is None:
            held = self.stretches[stretch] = [0, ()]
            self.size += len(stretch)
        held[0] += 1
        self.places.append((id_, key, first, held))

    def located(self, length: int) -> Iterator[tuple[int, int, int, int]]:
        """``(id, key, first byte, past byte)`` of the strings that start elsewhere too, runs joined."""
        if len(self.stretches) > 1 or any(len(s) > length for s in self.stretches):
            marks = repeated_starts(list(self.stretches), length)
        else:
            marks = np.zeros(self.size, bool)
        begin = 0
        for stretch, held in self.stretches.items():
            if held[0] > 1:
                held[1] = [(0, len(stretch))]
            else:
                own = np.concatenate([[False], marks[begin : begin + len(stretch)], [False]])
                edges = np.flatnonzero(own[1:] != own[:-1]).tolist()
                held[1] = [(a, b - 1 + length) for a, b in zip(edges[::2], edges[1::2])]
            begin += len(stretch)
        for id_, key, first, held in self.places:
            for a, b in held[1]:
                yield id_, key, first + a, first + b


def _locate(batches: Iterator[pd.DataFrame], length: int, limit: int) -> Iterator[pd.DataFrame]:
    """Rows come sorted by anchor; a shard takes whole anchors until it has ``limit`` distinct bytes."""
    shard, now = _Shard(), None

    def out(done: _Shard) -> pd.DataFrame:
        found = np.array(list(done.located(length)), np.int64).reshape(-1, 4)
        return pd.DataFrame(found, columns=["id", "key", "a", "b"])

    for batch in batches:
        for anchor, id_, key, first, stretch in zip(*(batch[c].tolist() for c in ("anchor", "id", "key", "first", "stretch"))):
            if anchor != now:
                if shard.size >= limit:
                    yield out(shard)
                    shard = _Shard()
                now = anchor
            shard.add(id_, key, first, bytes(stretch))
    yield out(shard)


def repeated_spans(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``(id, spans)``: for each id the byte spans, which may overlap, that start elsewhere too, with the text's key."""
    held = identified(docs, text)
    found = stage(held.mapInArrow(lambda b: _anchor_rows(b, length, gram), "anchor long, id long, places long"), "anchors")
    again = found.groupBy("anchor").agg(F.sum("places").alias("n")).filter("n > 1").select("anchor")
    lists = found.join(again, "anchor").groupBy("id").agg(F.collect_set("anchor").alias("anchors"))
    listed = held.join(stage(lists, "anchor-lists"), "id")
    stretches = listed.mapInArrow(lambda b: _stretch_rows(b, length, gram), "anchor long, id long, key long, first long, stretch binary")
    sharded = stretches.repartition("anchor").sortWithinPartitions("anchor")
    located = sharded.mapInPandas(lambda b: _locate(b, length, SHARD_BYTES), "id long, key long, a long, b long")
    return located.groupBy("id").agg(F.collect_set(F.struct("key", "a", "b")).alias("spans"))


def _cut(text: str | None, spans) -> tuple[int, int, int, bytes]:
    octets = (text or "").encode()
    kept, at, removed, runs = [], 0, 0, 0
    for a, b in sorted((s["a"], s["b"]) for s in spans) if spans is not None else ():
        if a > at or not runs:
            runs += 1
            kept.append(octets[at:a])
        removed += max(0, b - max(a, at))
        at = max(at, b)
    kept.append(octets[at:])
    return len(octets), removed, runs, b"".join(kept)


def kept_bytes(text: Column, spans: Column) -> Column:
    """Struct of ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs) and the ``kept`` bytes."""

    def cut(texts: pd.Series, places: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_cut(t, p) for t, p in zip(texts, places)], columns=["n_bytes", "n_removed", "n_spans", "kept"])

    cut.__annotations__ = {"texts": pd.Series, "places": pd.Series, "return": pd.DataFrame}
    return F.pandas_udf(cut, "n_bytes long, n_removed long, n_spans long, kept binary").asNondeterministic()(text, spans)


def remove_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and the ``kept`` bytes of every row."""
    # joined by id in the same job as the stretches are, so the texts are shuffled once
    found = identified(docs, text).join(repeated_spans(docs, text, length, gram), "id", "left")
    own = F.transform(F.filter("spans", lambda s: s["key"] == F.col("key")), lambda s: F.struct(s["a"].alias("a"), s["b"].alias("b")))
    marked = found.select("id", kept_bytes(F.col("content"), own).alias("k"))
    return marked.select(F.expr(f"nullif(id, {LAST}L)").alias("doc_id"), "k.*")
