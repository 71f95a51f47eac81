"""Byte-level BPE over whole columns: vectorised pre-tokenisation, cached pair merging, decoding.

Texts of a batch are one array of code points. A table gives the class of each (letter, number, space,
other white space, apostrophe, other); with one look ahead that becomes a symbol, and symbols drive a
small automaton whose transition functions are composed associatively: blocks of the array compose
their functions side by side, a logarithmic scan over the blocks gives each its entry state, and one
more pass marks where slices begin. No regular expression is run. The slices go through pair merging
by rank with a bounded cache, and the byte offsets of the tokens are kept for decoding.

The slices are those of the pattern ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.

Defined cases: a null or empty text has no tokens and decodes to no bytes; equal rows get equal tokens;
a text of any length is encoded whole; ids outside the vocabulary raise when decoding.
"""

from __future__ import annotations

import base64
import functools
import heapq
import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

OTHER, LETTER, NUMBER, SPACE, WHITE, QUOTE = range(6)
#: Code points of the White_Space property (fixed values).
WHITE_SPACE = [9, 10, 11, 12, 13, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]

# symbols: what a character does, given the one after it; FIRST is added at the start of a text
S_LETTER, S_NUMBER, S_OTHER, S_QUOTE_ONE, S_QUOTE_TWO, S_SPACE, S_GAP, S_LAST_GAP, S_NONE = range(9)
FIRST = 16
# states: what the character before belongs to
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_SPACE, IN_GAP, ONE_LEFT, TWO_LEFT = range(8)
STATES = 8

BLOCK = 64
CHUNK = 1 << 20  # code points that are pre-tokenised together; longer texts are cut where slices surely begin
CACHE_BYTES = 24 << 20  # of cached slices and their ids
ENTRY_BYTES = 180  # what an entry of the cache costs beside its bytes
NO_RANK = (1 << 31) - 1
CHUNK_IDS = 1 << 16  # ids decoded at once
SHORT = 48  # slices up to this many bytes are merged together and cached, longer ones one by one with a heap


@functools.cache
def class_table() -> np.ndarray:
    """Class of every code point, by the Unicode version of this Python."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)), np.uint8)
    table[WHITE_SPACE] = WHITE
    table[ord(" ")] = SPACE
    table[ord("'")] = QUOTE
    return table


@functools.cache
def automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a slice begins, both indexed by ``symbol * STATES + state``."""
    move = np.zeros((2 * FIRST, STATES), np.uint8)
    begin = np.zeros((2 * FIRST, STATES), bool)
    for state in range(STATES):
        free = state in (FRESH, IN_LETTERS, IN_NUMBERS, IN_GAP)
        for symbol, run in ((S_LETTER, IN_LETTERS), (S_NUMBER, IN_NUMBERS), (S_OTHER, IN_OTHERS)):
            move[symbol, state], begin[symbol, state] = run, state not in (run, AFTER_SPACE)
        for symbol, rest in ((S_QUOTE_ONE, ONE_LEFT), (S_QUOTE_TWO, TWO_LEFT)):
            move[symbol, state], begin[symbol, state] = (rest if free else IN_OTHERS), free
        move[S_SPACE, state], begin[S_SPACE, state] = AFTER_SPACE, True
        move[S_GAP, state], begin[S_GAP, state] = IN_GAP, state != IN_GAP
        move[S_LAST_GAP, state], begin[S_LAST_GAP, state] = FRESH, True
        move[S_NONE, state] = state
    # the letters of a contraction
    move[S_LETTER, TWO_LEFT], begin[S_LETTER, TWO_LEFT] = ONE_LEFT, False
    move[S_LETTER, ONE_LEFT], begin[S_LETTER, ONE_LEFT] = FRESH, False
    move[FIRST : FIRST + S_NONE] = move[:S_NONE, FRESH : FRESH + 1]
    begin[FIRST : FIRST + S_NONE] = True
    return move.ravel(), begin.ravel()


def symbols(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Symbol of every code point; ``first`` has the places where texts begin."""
    n = len(points)
    kind = class_table()[points]
    ends = np.zeros(n, bool)
    ends[np.concatenate([first[first > 0], [n]]) - 1] = True
    following = np.concatenate([points[1:], [0]])
    following[ends] = 0
    later = np.concatenate([following[1:], [0]])
    later[ends] = 0
    symbol = np.array([S_OTHER, S_LETTER, S_NUMBER, S_GAP, S_GAP, S_OTHER], np.uint8)[kind]
    quote = np.flatnonzero(kind == QUOTE)
    one, two = following[quote], later[quote]
    pair = (one << 8) | np.where(two < 128, two, 0)
    symbol[quote[np.isin(one, [ord(c) for c in "stmd"])]] = S_QUOTE_ONE
    symbol[quote[np.isin(pair, [(ord(a) << 8) | ord(b) for a, b in ("re", "ve", "ll")])]] = S_QUOTE_TWO
    gap = (kind == SPACE) | (kind == WHITE)
    last = gap & ~ends
    last[:-1] &= ~gap[1:]
    symbol[last & (kind == SPACE)] = S_SPACE
    symbol[last & (kind == WHITE)] = S_LAST_GAP
    symbol[first] += FIRST
    return symbol


def slice_starts(symbol: np.ndarray) -> np.ndarray:
    """Places where slices begin, by composing transition functions block by block."""
    move, begin = automaton()
    n = len(symbol)
    blocks = -(-n // BLOCK)
    padded = np.full(blocks * BLOCK, S_NONE, np.uint8)
    padded[:n] = symbol
    steps = np.ascontiguousarray(padded.reshape(blocks, BLOCK).T).astype(np.uint16) * STATES
    whole = np.tile(np.arange(STATES, dtype=np.uint8), (blocks, 1))
    for step in steps:
        whole = move[step[:, None] + whole]
    reach = 1
    while reach < blocks:  # whole[i] becomes the composition of blocks 0..i
        whole[reach:] = np.take_along_axis(whole[reach:], whole[:-reach].copy(), axis=1)
        reach *= 2
    state = np.concatenate([[FRESH], whole[:-1, FRESH]]).astype(np.uint8)
    marks = np.empty((BLOCK, blocks), bool)
    for i, step in enumerate(steps):
        at = step + state
        marks[i] = begin[at]
        state = move[at]
    return np.flatnonzero(marks.T.ravel()[:n])


def pre_tokenise(texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The texts' bytes, the byte offsets where slices begin (and the end), and the slices of each text."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    joined = "".join(texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(points):
        return b"", np.zeros(1, np.int64), np.zeros(len(texts), np.int64)
    first = (np.cumsum(sizes) - sizes)[sizes > 0]
    starts = slice_starts(symbols(points, first))
    widths = 1 + (points >= 0x80) + (points >= 0x800).astype(np.uint8) + (points >= 0x10000)
    octets = np.concatenate([[0], np.cumsum(widths, dtype=np.int64)])
    counts = np.diff(np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)])))
    return joined.encode("utf-8", "surrogatepass"), octets[np.concatenate([starts, [len(points)]])], counts


def merge_pairs(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """Ids of one slice of any length: the adjacent pair of least rank is merged, the leftmost first, until none is left."""
    if piece in ranks:
        return (ranks[piece],)
    parts = [piece[i : i + 1] for i in range(len(piece))]
    after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    heap = [(ranks[a + b], i, a, b) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        if parts[i] != left or j >= len(parts) or parts[j] != right:
            continue  # one of the two has been merged since
        parts[i], parts[j], after[i] = left + right, b"", after[j]
        if after[i] < len(parts):
            before[after[i]] = i
        for k in (before[i], i):
            if k >= 0 and after[k] < len(parts):
                a, b = parts[k], parts[after[k]]
                if a + b in ranks:
                    heapq.heappush(heap, (ranks[a + b], k, a, b))
    return tuple(ranks[p] for p in parts if p)


class Vocabulary:
    """Ranks of a rank file, the bytes of each id, and a cache of merged slices."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        size = max(self.ranks.values()) + 1
        self.lengths = np.zeros(size, np.int64)
        tokens = [b""] * size
        for token, rank in self.ranks.items():
            tokens[rank], self.lengths[rank] = token, len(token)
        self.places = np.cumsum(self.lengths) - self.lengths
        self.octets = np.frombuffer(b"".join(tokens), np.uint8)
        #: slice to its ids, as the bytes of 32-bit integers
        self.cache: dict[bytes, bytes] = {}
        self.cached = 0

    @functools.cached_property
    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Every way to put a token together from two, as one key, by key, and the token's rank."""
        pairs = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        keys = sorted(pairs)
        return np.array(keys, np.int64), np.array([pairs[k] for k in keys] + [NO_RANK], np.int32)

    @functools.cached_property
    def single(self) -> np.ndarray:
        """Ids of the single bytes."""
        return np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that two tokens make, or ``NO_RANK``; the token is the rank."""
        keys = left.astype(np.int64) << 32 | right
        pair_keys, pair_ranks = self.pairs
        at = np.searchsorted(pair_keys, keys)
        known = pair_keys[np.minimum(at, len(pair_keys) - 1)] == keys
        return np.where(known, pair_ranks[at], NO_RANK)

    def merge_together(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of slices of like length: in each round every slice merges its leftmost pair of least rank."""
        width = max(map(len, pieces)) + 1
        padded = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(-1, width)
        ids = self.single[padded]
        ids[np.arange(width) >= np.fromiter(map(len, pieces), np.int64, len(pieces))[:, None]] = -1
        rank = np.where(ids[:, 1:] < 0, NO_RANK, self.pair_rank(ids[:, :-1], ids[:, 1:]))
        done = np.full(ids.shape, -1, np.int32)
        rows, columns = np.arange(len(pieces)), np.arange(width)
        while len(rows):
            at = rank.argmin(axis=1)
            least = rank[np.arange(len(rows)), at]
            ended = least == NO_RANK
            if ended.any():
                done[rows[ended]] = ids[ended]
                going = ~ended
                rows, ids, rank, at, least = rows[going], ids[going], rank[going], at[going], least[going]
                if not len(rows):
                    break
            each = np.arange(len(rows))
            source = np.minimum(columns + (columns > at[:, None]), width - 1)  # closes the gap after the merged pair
            ids, rank = np.take_along_axis(ids, source, 1), np.take_along_axis(rank, np.minimum(source[:, :-1], width - 2), 1)
            ids[:, -1], rank[:, -1] = -1, NO_RANK
            ids[each, at] = least
            for place in (np.maximum(at - 1, 0), at):  # the pairs with the new token; the first may have none before it
                left, right = ids[each, place], ids[each, place + 1]
                rank[each, place] = np.where(right < 0, NO_RANK, self.pair_rank(left, right))
        held = done >= 0
        flat = done[held].tobytes()
        ends = (4 * np.cumsum(held.sum(axis=1))).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def learn(self, pieces: set[bytes]) -> None:
        """Adds the ids of slices that the cache lacks."""
        by_width: dict[int, list[bytes]] = {}
        for piece in pieces:
            known = self.ranks.get(piece)
            if known is not None:
                self.cache[piece] = known.to_bytes(4, sys.byteorder)
            elif len(piece) > SHORT:
                self.cache[piece] = np.array(merge_pairs(piece, self.ranks), np.int32).tobytes()
            else:
                by_width.setdefault(len(piece) // 4, []).append(piece)
        for like in by_width.values():
            self.cache.update(zip(like, self.merge_together(like)))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and how many each text has."""
        octets, cuts, slices = pre_tokenise(texts)
        at = cuts.tolist()
        pieces = [octets[a:b] for a, b in zip(at, at[1:])]
        new = set(pieces).difference(self.cache)
        if self.cached > CACHE_BYTES:
            self.cache, self.cached, new = {}, 0, set(pieces)
        self.learn(new)
        merged = [self.cache[p] for p in pieces]
        for piece in new:
            if len(piece) > SHORT:
                del self.cache[piece]
            else:
                self.cached += ENTRY_BYTES + len(piece) + len(self.cache[piece])
        sizes = np.fromiter(map(len, merged), np.int64, len(merged)) // 4
        ids = np.frombuffer(b"".join(merged), np.int32)
        through = np.concatenate([[0], np.cumsum(sizes)])
        ends = np.cumsum(slices)
        return ids, through[ends] - through[ends - slices]

    def offsets(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Byte offset of every token in its own text."""
        ends = np.cumsum(self.lengths[ids])
        starts = ends - self.lengths[ids]
        first = np.cumsum(counts) - counts
        base = starts[np.minimum(first, max(len(ids) - 1, 0))] if len(ids) else np.zeros(len(counts), np.int64)
        return (starts - np.repeat(base, counts)).astype(np.int32)

    def decode(self, ids: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
        """``size`` bytes, each token's written at its own offset."""
        found = np.empty(size, np.uint8)
        for at in range(0, len(ids), CHUNK_IDS):
            part = ids[at : at + CHUNK_IDS]
            sizes = self.lengths[part]
            inside = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            found[inside + np.repeat(starts[at : at + CHUNK_IDS], sizes)] = self.octets[inside + np.repeat(self.places[part], sizes)]
        return found


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def cuts(text: str, most: int = CHUNK) -> list[str]:
    """Pieces of about ``most`` code points that are encoded as in the whole text.

    A slice begins at every blank after a character that is not white, whatever stands around them.
    """
    found, at, white = [], 0, {chr(c) for c in WHITE_SPACE}
    while len(text) - at > most:
        place = text.rfind(" ", at + 1, at + most)
        while place > at and text[place - 1] in white:
            place = text.rfind(" ", at + 1, place)
        if place <= at:  # none so near: the next one
            place = text.find(" ", at + most)
            while place > 0 and text[place - 1] in white:
                place = text.find(" ", place + 1)
            if place < 0:
                break
        found.append(text[at:place])
        at = place
    return [*found, text[at:]]


def _chunks(texts: pa.Array):
    """Runs of pieces of bounded size, with the number of the text that each piece belongs to."""
    held, owners, size = [], [], 0
    for owner, value in enumerate(texts):
        for piece in cuts(value.as_py() or ""):
            if held and size + len(piece) > CHUNK:
                yield held, owners
                held, owners, size = [], [], 0
            held.append(piece)
            owners.append(owner)
            size += len(piece)
    if held:
        yield held, owners


def _encoded(known: Vocabulary, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a batch, and how many each text has."""
    ids, counts = [np.zeros(0, np.int32)], np.zeros(len(texts), np.int64)
    for pieces, owners in _chunks(texts):
        found, sizes = known.encode(pieces)
        ids.append(found)
        np.add.at(counts, owners, sizes)
    return np.concatenate(ids), counts


def _lists(counts: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(values, pa.int32()))


def encode(text: Column, path: str) -> Column:
    """Struct of ``ids`` and ``starts`` (byte offset of each token) by the rank file at ``path``."""

    def batch(texts: pa.Array) -> pa.Array:
        known = vocabulary(path)
        ids, counts = _encoded(known, texts)
        return pa.StructArray.from_arrays([_lists(counts, ids), _lists(counts, known.offsets(ids, counts))], ["ids", "starts"])

    batch.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    # computed once even where several columns use it
    return F.arrow_udf(batch, "struct<ids: array<int>, starts: array<int>>").asNondeterministic()(text)


def _binaries(octets: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(octets)])


def round_trip(text: Column, path: str) -> Column:
    """Struct of ``ids`` and ``decoded``, the bytes that the ids give at the offsets kept with them, by one worker."""

    def batch(texts: pa.Array) -> pa.Array:
        known = vocabulary(path)
        ids, counts = _encoded(known, texts)
        starts = known.offsets(ids, counts)
        through = np.concatenate([[0], np.cumsum(known.lengths[ids])])
        ends = through[np.cumsum(counts)]
        firsts = np.concatenate([[0], ends[:-1]])
        octets = known.decode(ids, starts + np.repeat(firsts, counts), int(through[-1]))
        return pa.StructArray.from_arrays([_lists(counts, ids), _binaries(octets, ends)], ["ids", "decoded"])

    batch.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(batch, "struct<ids: array<int>, decoded: binary>").asNondeterministic()(text)


def decode(ids: Column, path: str) -> Column:
    """The bytes of the tokens ``ids``; no bytes for null."""

    def batch(lists: pa.Array) -> pa.Array:
        known = vocabulary(path)
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        if len(flat) and not (0 <= flat.min() and flat.max() < len(known.lengths)):
            raise ValueError("an id is not in the vocabulary")
        counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        through = np.concatenate([[0], np.cumsum(known.lengths[flat])])
        return _binaries(known.decode(flat, through[:-1], int(through[-1])), through[np.cumsum(counts)])

    batch.__annotations__ = {"lists": pa.Array, "return": pa.Array}
    return F.arrow_udf(batch, "binary")(ids)
