"""Runs of periodic words inside documents: stretches that repeat themselves at a fixed lag.

A run is a stretch of words with smallest period q, at least twice q and at least ``least`` words
long, that cannot be extended. Its words and those q further on agree over ``max(least - q, q)``
places at least: the guaranteed overlap on the diagonal of lag q. Diagonals are taken by octaves of
lags. The grams of one length, about two thirds of the least overlap of the octave, are indexed, and
of every run of ``stride`` places one asks for the occurrences of its gram at the lags of the octave: an
overlap of ``gram + stride - 1`` holds such a place, so no run is missed, and there are at most about as
many seeds as words, however often a gram occurs. Seeds are extended both ways by doubling steps. A
table for each lag holds how far that diagonal has been followed, so no stretch is followed twice; and
a seed inside a shorter period that divides its lag is left out, as its stretch has that period.

Gram names come from exact pairs of names of half the length, and only grams that occur again in their
document are carried on, so ordinary prose costs little more than its word numbers. Documents
of a batch are worked on together in arrays; each is whole inside its task, and nothing is shuffled.

Defined cases: null words, an empty array and texts of fewer than ``least`` words have no runs; a null
word equals a null word; equal rows get equal runs; very long documents are worked on whole in time
n log n apart from the extensions; only the words are read, so other columns cannot clash.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

LEAST = 12
CHUNK_WORDS = 1 << 20  # words worked on together, or one document
FOUND = "struct<n_words: long, runs: array<struct<start: long, length: long, period: long>>, kept: array<struct<first: long, past: long>>>"


def _agreeing(words: np.ndarray, left: int, lag: int, past: int) -> int:
    """First place from ``left`` where words ``lag`` apart differ; ``past`` is the end of the document."""
    step, end = 16, past - lag
    while left < end:
        upto = min(left + step, end)
        differ = words[left:upto] != words[left + lag : upto + lag]
        at = int(differ.argmax())
        if differ[at]:
            return left + at
        left, step = upto, 2 * step
    return end


def _agreeing_back(words: np.ndarray, left: int, lag: int, start: int) -> int:
    """First place of the agreeing stretch that ``left`` belongs to."""
    step = 16
    while left > start:
        low = max(left - step, start)
        differ = words[low:left] != words[low + lag : left + lag]
        if differ.any():
            return left - int(differ[::-1].argmax())
        left, step = low, 2 * step
    return start


class _Grams:
    """Names of the grams that occur again in their document; grams of equal names are equal."""

    def __init__(self, words: np.ndarray, document: np.ndarray):
        self.size = 1
        self.places = np.arange(len(words))
        # a name belongs to one document, so grams of different documents never meet
        self._name(document.astype(np.int64) * (int(words.max(initial=0)) + 1) + words)

    def _name(self, keys: np.ndarray) -> None:
        _, names, counts = np.unique(keys, return_inverse=True, return_counts=True)
        again = counts[names] > 1
        self.places, self.names = self.places[again], names[again]

    def double(self) -> None:
        at = np.searchsorted(self.places, self.places + self.size)
        there = np.minimum(at, max(len(self.places) - 1, 0))
        goes_on = self.places[there] == self.places + self.size if len(self.places) else np.zeros(0, bool)
        pairs = self.names * (int(self.names.max(initial=0)) + 1) + self.names[there] if len(self.places) else self.names
        self.places = self.places[goes_on]
        self.size *= 2
        self._name(pairs[goes_on])

    def seeds(self, asked: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of equal grams ``low`` to ``high - 1`` apart, the first of each among the ``asked`` indexes."""
        order = np.lexsort((self.places, self.names))
        width = int(self.places.max(initial=0)) + high + 2
        keys = self.names[order] * width + self.places[order]
        own = self.names[asked] * width + self.places[asked]
        first, past = np.searchsorted(keys, own + low), np.searchsorted(keys, own + high)
        counts = past - first
        left = np.repeat(self.places[asked], counts)
        steps = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        return left, self.places[order][np.repeat(first, counts) + steps]


def _octaves(longest: int, least: int) -> list[tuple[int, int, int, int]]:
    """(low, high, gram, stride) for every octave of lags of a document of ``longest`` words; grams never shrink."""
    lows = [1 << i for i in range(longest.bit_length() - 1)]
    # the overlap is least at the lag of half ``least``, and grows with the lag beyond it
    overlaps = [min(max(least - q, q) for q in range(low, min(2 * low, low + least))) for low in lows]
    grams = [1 << int(math.log2(max(2 * (overlap + 1) / 3, 1))) for overlap in overlaps]
    grams = [min(grams[i:]) for i in range(len(grams))]
    return [(low, 2 * low, gram, overlap - gram + 1) for low, gram, overlap in zip(lows, grams, overlaps)]


def find_runs(words: np.ndarray, sizes: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """Runs ``(start, past, period)`` over documents of ``sizes`` words laid end to end, by start, then period."""
    ends = np.cumsum(sizes)
    document = np.repeat(np.arange(len(sizes)), sizes)
    starts = ends - sizes
    if not len(words):
        return []
    inside = np.arange(len(words)) - starts[document]
    grams = _Grams(words, document)
    runs: list[tuple[int, int, int]] = []
    known: set[tuple[int, int]] = set()
    for low, high, gram, stride in _octaves(int(sizes.max()), least):
        while grams.size < gram:
            grams.double()
        if not len(grams.places):
            break
        left, right = grams.seeds(np.flatnonzero(inside[grams.places] % stride == 0), low, high)
        if runs and len(left):
            # the run that reaches furthest of those that have begun, at every seed
            held = np.array(sorted(runs))
            reach = np.maximum.accumulate(held[:, 1])
            holder = np.maximum.accumulate(np.where(held[:, 1] == reach, np.arange(len(held)), 0))
            at = np.searchsorted(held[:, 0], left, "right") - 1
            inner = (at >= 0) & (reach[at] >= right + gram) & ((right - left) % held[holder[at], 2] == 0)
            left, right = left[~inner], right[~inner]
        order = np.lexsort((left, right - left))
        covered: dict[int, int] = {}
        for i, j in zip(left[order].tolist(), right[order].tolist()):
            lag = j - i
            if i < covered.get(lag, 0):
                continue
            home = document[i]
            first = _agreeing_back(words, i, lag, int(starts[home]))
            past = _agreeing(words, i + gram, lag, int(ends[home]))
            covered[lag] = past
            stretch = first, past + lag
            if stretch[1] - first >= max(least, 2 * lag) and stretch not in known:
                known.add(stretch)
                runs.append((*stretch, lag))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def _kept(runs: list[tuple[int, int, int]], size: int) -> list[tuple[int, int]]:
    """Stretches of words left when each run keeps its first period alone."""
    kept, at = [], 0
    for first, past in sorted((start + period, past) for start, past, period in runs):
        if first > at:
            kept.append((at, first))
        at = max(at, past)
    return [*kept, (at, size)] if at < size else kept


def _found(words: np.ndarray, sizes: np.ndarray, least: int) -> list[dict]:
    ends = np.cumsum(sizes)
    runs = find_runs(words, sizes, least)
    homes = np.searchsorted(ends, [r[0] for r in runs], "right").tolist()
    by_document: list[list[tuple[int, int, int]]] = [[] for _ in sizes]
    starts = (ends - sizes).tolist()
    for home, (first, past, period) in zip(homes, runs):
        by_document[home].append((first - starts[home], past - starts[home], period))
    return [
        {
            "n_words": size,
            "runs": [{"start": a, "length": b - a, "period": q} for a, b, q in own],
            "kept": [{"first": a, "past": b} for a, b in _kept(own, size)],
        }
        for size, own in zip(sizes.tolist(), by_document)
    ]


def find(words: Column, least: int = LEAST) -> Column:
    """Number of words, all runs, and the stretches of words that collapsing the runs keeps."""
    pair = pa.struct([("first", pa.int64()), ("past", pa.int64())])
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    rows = pa.struct([("n_words", pa.int64()), ("runs", pa.list_(run)), ("kept", pa.list_(pair))])

    def batch(lists: pa.Array) -> pa.Array:
        sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        through = np.concatenate([[0], np.cumsum(sizes)])
        found: list[dict] = []
        at = 0
        while at < len(sizes):
            past = max(at + 1, int(np.searchsorted(through, through[at] + CHUNK_WORDS, "right")) - 1)
            part = lists.slice(at, past - at).flatten().dictionary_encode().indices
            numbers = part.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
            found += _found(numbers, sizes[at:past], least)
            at = past
        return pa.array(found, rows)

    batch.__annotations__ = {"lists": pa.Array, "return": pa.Array}
    return F.arrow_udf(batch, FOUND).asNondeterministic()(words)


def collapsed(words: Column, kept: Column) -> Column:
    """The words of the ``kept`` stretches, joined by one space."""
    parts = F.transform(kept, lambda s: F.array_join(F.slice(words, (s["first"] + 1).cast("int"), (s["past"] - s["first"]).cast("int")), " "))
    return F.array_join(parts, " ")
