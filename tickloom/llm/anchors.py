"""Winnowed anchors of words or bytes, computed with array operations over whole batches.

Anchors only decide where to look: whatever two texts share of at least the window's length, they
share an anchor in it. What is looked at is then compared exactly by the operators.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20  # arrays over a chunk take about a hundred times its size
BASE = np.uint64(0x9E3779B97F4A7C15)
_UPPER = np.uint64(0xFFFFFFFF00000000)
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all others."""
    values = (values ^ (values >> np.uint64(30))) * MIX_A
    values = (values ^ (values >> np.uint64(27))) * MIX_B
    return values ^ (values >> np.uint64(31))


def chunks(texts: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, bytes, offsets)`` for runs of texts; a null is empty, one longer text goes alone."""
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_string(texts.type) else b"")
    _, places, data = texts.buffers()
    offsets = np.frombuffer(places, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    octets = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        yield row, octets[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row]
        row = last


@functools.cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    back = np.uint64(pow(int(BASE), -1, 1 << 64))
    ones = np.ones(size, np.uint64)
    up, down = ones * BASE, ones * back
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


@functools.cache
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * BASE)


def span_hashes(octets: np.ndarray, first: np.ndarray, past: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span; equal bytes have equal hashes wherever they stand."""
    size = max(1 << 20, 1 << int(len(octets)).bit_length())
    up, down = _powers(size)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_byte_values()[octets] * up[: len(octets)], dtype=np.uint64)])
    return mix((sums[past] - sums[first]) * down[first] + (past - first).astype(np.uint64))


def gram_hashes(octets: np.ndarray, size: int) -> np.ndarray:
    """``span_hashes`` of every ``size`` consecutive bytes, with fewer arrays."""
    n = max(len(octets) - size + 1, 0)
    if not n:
        return np.zeros(0, np.uint64)
    up, down = _powers(max(1 << 20, 1 << int(len(octets)).bit_length()))
    sums = _byte_values()[octets]
    sums *= up[: len(octets)]
    np.cumsum(sums, out=sums)
    found = sums[size - 1 :].copy()
    found[1:] -= sums[: n - 1]
    found *= down[:n]
    found += np.uint64(size)
    for shift, factor in ((30, MIX_A), (27, MIX_B), (31, None)):
        found ^= found >> np.uint64(shift)
        if factor is not None:
            found *= factor
    return found


def words(octets: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte spans of the words between white space (space, tab, line and page breaks), and each one's text."""
    plain = (octets != 32) & ((octets < 9) | (octets > 13))
    if not len(plain):
        return (np.zeros(0, np.int64),) * 3
    edges = np.zeros(len(octets) + 1, bool)
    edges[offsets] = True
    before = np.concatenate([[False], plain[:-1]]) & ~edges[:-1]
    after = np.concatenate([plain[1:], [False]]) & ~edges[1:]
    first, past = np.flatnonzero(plain & ~before), np.flatnonzero(plain & ~after) + 1
    return first, past, np.searchsorted(offsets, first, "right") - 1


def grams(values: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive values."""
    n = max(len(values) - size + 1, 0)
    found = np.zeros(n, np.uint64)
    for i in range(size):
        found = found * BASE + values[i : i + n]
    return mix(found)


def sliding_least(values: np.ndarray, size: int) -> np.ndarray:
    """Least of every ``size`` consecutive values, by doubling."""
    width = 1
    while 2 * width <= size:
        values = np.minimum(values[:-width], values[width:]) if len(values) > width else values[:0]
        width *= 2
    rest = size - width
    return np.minimum(values[:-rest], values[rest:]) if rest and len(values) > rest else values if not rest else values[:0]


def _inside(text: np.ndarray, windows: int, window: int) -> np.ndarray:
    return np.flatnonzero(text[:windows] == text[window - 1 :][:windows])


def _cut(change: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs begin among the windows, and their lengths; ``change`` compares each window with the one before."""
    at = np.flatnonzero(np.concatenate([[True], change | (inside[1:] != inside[:-1] + 1)]))
    return at, np.diff(np.concatenate([at, [len(inside)]]))


def runs(gram_hashes: np.ndarray, text: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring windows of one text with one least gram hash: anchor, first window, windows.

    ``text`` says to which text each element belongs, in order.
    """
    least = sliding_least(gram_hashes, window - gram + 1)
    inside = _inside(text, len(least), window)
    if not len(inside):
        return np.zeros(0, np.uint64), inside, inside
    least = least[inside]
    at, count = _cut((least[1:] != least[:-1]) | (text[inside[1:]] != text[inside[:-1]]), inside)
    return least[at], inside[at], count


def byte_runs(octets: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """As ``runs`` for the bytes of texts that start at ``offsets``, with each run's text and the places of its gram.

    A window's anchor is the gram whose upper half of the hash is least, the leftmost of equal ones, so a
    window's least value names the place as well. Equal windows of one text are in two runs, or in one
    whose gram stands in two places. A periodic stretch, where the gram comes again and again, is one
    run, whatever its length. Gives anchor, first window, windows, text and places.
    """
    begin, past = offsets[:-1], offsets[1:] - window + 1
    held = past > begin
    if not held.any():
        return np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 4
    hashes = gram_hashes(octets, gram)
    values = hashes & _UPPER
    values |= np.arange(len(values), dtype=np.uint64)
    least = sliding_least(values, window - gram + 1)
    cuts = np.unique(np.concatenate([np.flatnonzero(least[1:] != least[:-1]) + 1, begin[held], past[held]]))
    first, count = cuts[:-1], np.diff(cuts)
    text = np.searchsorted(offsets, first, "right") - 1
    inside = first < past[text]  # the rest are windows over the ends of texts
    first, count, text = first[inside], count[inside], text[inside]
    anchor = hashes[(least[first] & ~_UPPER).astype(np.int64)]
    at = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])]))
    return anchor[at], first[at], np.add.reduceat(count, at), text[at], np.diff(np.concatenate([at, [len(first)]]))


def listed(anchor: np.ndarray, text: np.ndarray, lists: pa.Array) -> np.ndarray:
    """Runs whose anchor is in the list of their text; by hash, so a rare one too many may be selected."""
    held = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    owners = np.repeat(np.arange(len(lists), dtype=np.uint64), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    return np.flatnonzero(np.isin(mix(anchor ^ mix(text.astype(np.uint64))), mix(held ^ mix(owners))))
