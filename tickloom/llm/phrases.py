"""Substring dedup by repeated-phrase automata: word passages that an earlier document has already.

A window of ``WINDOW`` consecutive words is removed if the same words start in a document of smaller
id. Winnowed anchors show where to look: any two equal windows share one. Anchors found more than once
select segments of the documents, and segments with the same anchor meet in one shard. A shard
confirms the windows that more than one document has, compiles them, with the smallest id of each,
into an Aho-Corasick automaton over word numbers, and streams its segments through it, which locates
every occurrence. Shards are cut by the number of distinct segments, so an automaton has a bounded
size; copies of a segment are one. Results do not depend on hashes: these only select segments.

Defined cases: a null text has no words; texts shorter than a window keep all; a null id is larger than
any other; rows with the same id never remove each other's words; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm import anchors
from tickloom.llm.common import LAST, identified
from tickloom.session import stage

WINDOW = 13
GRAM = 4
SHARD_SEGMENTS = 20_000


def _text_runs(texts: pa.Array, window: int, gram: int):
    """For each chunk: anchors, first windows, windows, the row of each run, and the words' bytes and spans."""
    for row, octets, offsets in anchors.chunks(texts):
        first, past, text = anchors.words(octets, offsets)
        anchor, start, count = anchors.runs(anchors.grams(anchors.span_hashes(octets, first, past), gram), text, window, gram)
        yield anchor, start, count, text[start] if len(start) else start, row, octets, offsets, first, past


def _anchor_rows(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("id").to_numpy(zero_copy_only=False)
        for anchor, _, _, text, row, *_ in _text_runs(batch.column("content"), window, gram):
            _, once = np.unique(anchors.mix(anchor ^ anchors.mix(text.astype(np.uint64))), return_index=True)
            anchor, text = anchor[once], text[once]  # a document counts an anchor once
            columns = [pa.array(anchor.view(np.int64)), pa.array(ids[row + text].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["anchor", "id"])


def _segment_rows(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[pa.RecordBatch]:
    """The words of every run whose anchor is in the document's list."""
    for batch in batches:
        ids, keys = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "key"))
        wanted = batch.column("anchors")
        for anchor, start, count, text, row, octets, offsets, first, past in _text_runs(batch.column("content"), window, gram):
            hit = anchors.listed(anchor, text, wanted.slice(row, len(offsets) - 1))
            text_first = np.searchsorted(first, offsets[:-1])  # number of a text's first word
            raw = octets.tobytes()
            cut = [b" ".join(raw[a:b].split()).decode() for a, b in zip(first[start[hit]].tolist(), past[start[hit] + count[hit] + window - 2].tolist())]
            columns = [
                pa.array(anchor[hit].view(np.int64)), pa.array(ids[row + text[hit]].astype(np.int64)), pa.array(keys[row + text[hit]].astype(np.int64)),
                pa.array((start[hit] - text_first[text[hit]]).astype(np.int32)), pa.array(cut, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["anchor", "id", "key", "first", "segment"])


class _Shard:
    """Segments by anchor: of each distinct one the smallest and largest id, and where it occurs."""

    def __init__(self, window: int) -> None:
        self.window = window
        self.anchors: list[dict[str, list]] = []
        self.places: list[tuple[int, int, int, list]] = []
        self.distinct = 0

    def add(self, new_anchor: bool, id_: int, key: int, first: int, segment: str) -> None:
        if new_anchor:
            self.anchors.append({})
        segments = self.anchors[-1]
        held = segments.get(segment)
        if held is None:
            held = segments[segment] = [id_, id_, ()]
            self.distinct += 1
        elif id_ < held[0]:
            held[0] = id_
        elif id_ > held[1]:
            held[1] = id_
        self.places.append((id_, key, first, held))

    def _passages(self, segments: dict[str, list], numbered: dict[str, tuple[int, ...]]) -> dict[tuple[int, ...], int]:
        """Confirmed passages of one anchor with the smallest id that has each.

        Equal windows have equal anchors, so a lone segment is one passage; of several, the windows are compared.
        """
        if len(segments) == 1:
            ((segment, (low, _, _)),) = segments.items()
            return {numbered[segment]: low}
        width = self.window
        seen: dict[tuple[int, ...], int] = {}
        again: set[tuple[int, ...]] = set()
        for segment, (low, high, _) in segments.items():
            numbers = numbered[segment]
            for i in range(len(numbers) - width + 1):
                phrase = numbers[i : i + width]
                known = seen.get(phrase)
                if known is None:
                    seen[phrase] = low
                    if low < high:
                        again.add(phrase)
                else:
                    if low != known or high != known:
                        again.add(phrase)
                    if low < known:
                        seen[phrase] = low
        return {phrase: seen[phrase] for phrase in again}

    def located(self) -> Iterator[tuple[int, int, int]]:
        """``(id, key, first word)`` of each window that a smaller id has too."""
        numbers: dict[str, int] = {}
        automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        searched: list[tuple[tuple[int, ...], list]] = []
        for segments in self.anchors:
            # without two documents there is no smaller id
            if min(s[0] for s in segments.values()) == max(s[1] for s in segments.values()):
                continue
            numbered = {s: tuple([numbers.setdefault(w, len(numbers)) for w in s.split(" ")]) for s in segments}
            passages = self._passages(segments, numbered)
            if passages:
                searched += [(numbered[s], held) for s, held in segments.items()]
                for passage, low in passages.items():
                    automaton.add_word(passage, (len(passage), low))
        if not len(automaton):
            return
        automaton.make_automaton()
        for segment, held in searched:
            first_of: dict[int, int] = {}
            for end, (size, low) in automaton.iter(segment):
                for at in range(end - size + 1, end - self.window + 2):
                    first_of[at] = min(low, first_of.get(at, low))
            held[2] = tuple(first_of.items())
        for id_, key, first, held in self.places:
            for at, low in held[2]:
                if low < id_:
                    yield id_, key, first + at


def _locate(batches: Iterator[pd.DataFrame], window: int, limit: int) -> Iterator[pd.DataFrame]:
    """Rows come sorted by anchor; a shard takes whole anchors until it has ``limit`` distinct segments."""
    shard, now = _Shard(window), None

    def out(done: _Shard) -> pd.DataFrame:
        found = np.array(list(done.located()), np.int64).reshape(-1, 3)
        return pd.DataFrame({"id": found[:, 0], "key": found[:, 1], "at": found[:, 2].astype(np.int32)})

    for batch in batches:
        for anchor, id_, key, first, segment in zip(*(batch[c].tolist() for c in ("anchor", "id", "key", "first", "segment"))):
            if anchor != now and shard.distinct >= limit:
                yield out(shard)
                shard = _Shard(window)
            shard.add(anchor != now, id_, key, first, segment)
            now = anchor
    yield out(shard)


def repeated_windows(docs: DataFrame, text: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``(id, places)``: for each id the first words of the windows that a smaller id has, with the text's key."""
    held = identified(docs, text)
    found = held.mapInArrow(lambda b: _anchor_rows(b, window, gram), "anchor long, id long")
    again = found.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")
    lists = found.join(again, "anchor").groupBy("id").agg(F.collect_set("anchor").alias("anchors"))
    listed = held.join(stage(lists, "anchor-lists"), "id")
    segments = listed.mapInArrow(lambda b: _segment_rows(b, window, gram), "anchor long, id long, key long, first int, segment string")
    sharded = segments.repartition("anchor").sortWithinPartitions("anchor")
    located = sharded.mapInPandas(lambda b: _locate(b, window, SHARD_SEGMENTS), "id long, key long, at int")
    return located.groupBy("id").agg(F.collect_set(F.struct("key", "at")).alias("places"))


def _kept(text: str | None, starts: np.ndarray | None, window: int) -> tuple[int, int, str]:
    words = (text or "").encode().split()
    if starts is None or not len(starts):
        return len(words), 0, b" ".join(words).decode()
    edges = np.zeros(len(words) + 1, np.int64)
    edges[starts] += 1
    np.add.at(edges, np.asarray(starts) + window, -1)
    keep = np.cumsum(edges[:-1]) == 0
    return len(words), int((~keep).sum()), b" ".join([w for w, k in zip(words, keep.tolist()) if k]).decode()


def kept_words(text: Column, starts: Column, window: int = WINDOW) -> Column:
    """Struct of ``n_words``, ``n_removed`` and the ``kept`` words joined by one space."""

    def cut(texts: pd.Series, places: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_kept(t, p, window) for t, p in zip(texts, places)], columns=["n_words", "n_removed", "kept"])

    cut.__annotations__ = {"texts": pd.Series, "places": pd.Series, "return": pd.DataFrame}
    return F.pandas_udf(cut, "n_words long, n_removed long, kept string").asNondeterministic()(text, starts)


def remove_repeats(docs: DataFrame, text: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and the ``kept`` text of every row."""
    # joined by id in the same job as the segments are, so the texts are shuffled once
    found = identified(docs, text).join(repeated_windows(docs, text, window, gram), "id", "left")
    own = F.transform(F.filter("places", lambda p: p["key"] == F.col("key")), lambda p: p["at"])
    marked = found.select("id", kept_words(F.col("content"), own, window).alias("k"))
    return marked.select(F.expr(f"nullif(id, {LAST}L)").alias("doc_id"), "k.*")
