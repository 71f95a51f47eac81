"""Robust locally weighted regression (Cleveland 1979) for many groups at once, exact for every group.

Rows with the same x share one local fit, so each group is first reduced to *knots*, one per distinct
x with the sums of its rows, numbered by x and cut into blocks of about the square root of their
number. On either side of a knot the tricube weight is a polynomial of degree 9 in the distance, so
all a fit needs of a stretch of knots are its power sums. Each block is summed up once about its own
middle; the fits of a leaf of knots add up the stretches wholly inside their neighbourhoods, paired up in a
tree of moments, and look at single knots only where the neighbourhoods end and around the knots themselves. Moments
are always moved between middles inside the neighbourhood, so no large sums are ever subtracted.

A team of neighbouring blocks is one task: its own knots, the blocks where its neighbourhoods can end (found from the
blocks' ranges and row counts), and one line of moments for each run of blocks between these. The work grows
with distinct x times a logarithm, whatever the span. A block of sparse x whose neighbourhoods end all over a
dense stretch reads that stretch.

With many knots the rows of a block are packed into pieces, lines that the robust passes move as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tickloom.operators.aggregate import exact_median
from tickloom.operators.skew import attach, broadcast_limit, dealt, planned_bytes, with_row_index
from tickloom.session import stage, stage_instead

BLOCK_KNOTS = 1024  # least knots of a block
TEAM_BLOCKS, TEAMS = 8, 16  # most blocks fitted in one task, where a group has this many teams
HOT_ROWS = 10_000  # a knot of more rows is not joined in one task
PIECE_ROWS = 65_536
LEAF_KNOTS = 32
RAGGED = 12  # leaves at both ends of the neighbourhoods of a leaf that are added knot by knot
AT_ONCE = 16  # leaves; their weights stay in the cache
POOR = 1e-4  # spread of the places in shares of its largest value, below which sums are taken about the mean
ROUNDING = 1e-12  # of the largest |y|: errors below it are rounding, not scatter
INNER, OUTER = 0.001, 0.999  # parts of the radius with full weight and without weight
POWERS = 12  # distances to the 11th: the weight has degree 9, a line needs two more
_CHOOSE = [np.array([comb(q, p) for p in range(q + 1)], float) for q in range(POWERS)]
# how often the power r of a place goes into the weighted power p of the distance, by the powers of its middle
_TURNED = np.zeros((POWERS, 3, POWERS))
for _p in range(3):
    for _q, _sign in zip(range(_p, POWERS, 3), (1.0, -3.0, 3.0, -1.0)):
        for _r in range(_q + 1):
            _TURNED[_q - _r, _p, _r] += _sign * comb(_q, _r)
_TURNED = _TURNED.reshape(POWERS, 3 * POWERS)
_LINE = [T.StructField("block", T.LongType()), T.StructField("knots", T.BinaryType()), T.StructField("line", T.BinaryType())]
KNOT = np.dtype([("x", float), ("n", float), ("s", float), ("t", float)])


# --- moments --------------------------------------------------------------------------------


def _powers(values: np.ndarray) -> np.ndarray:
    found = np.ones((*values.shape, POWERS))
    for p in range(1, POWERS):
        np.multiply(found[..., p - 1], values, out=found[..., p])
    return found


def _moved(moments: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Moments of ``a + b * u`` from those of ``u``; shape (sums, nodes, powers)."""
    far, near = _powers(a), moments * _powers(b)
    found = np.empty_like(moments)
    for q in range(POWERS):
        found[:, :, q] = (far[:, q::-1] * near[:, :, : q + 1]) @ _CHOOSE[q]
    return found


@dataclass
class Stretches:
    """Neighbouring stretches of knots: their ends, and moments of both sums about the middle in half widths."""

    low: np.ndarray
    high: np.ndarray
    moments: np.ndarray

    @property
    def middle(self) -> np.ndarray:
        return (self.low + self.high) / 2

    @property
    def half(self) -> np.ndarray:
        width = (self.high - self.low) / 2
        return np.where(width > 0, width, 1.0)

    @classmethod
    def of_knots(cls, knots: np.ndarray, starts: np.ndarray) -> Stretches:
        """Sums of the knots from each start up to the next."""
        ends = np.append(starts[1:], len(knots))
        own = cls(knots["x"][starts], knots["x"][ends - 1], np.empty(0))
        each = np.repeat(np.arange(len(starts)), ends - starts)
        place = _powers((knots["x"] - own.middle[each]) / own.half[each])
        own.moments = np.stack([np.add.reduceat(place * knots[c][:, None], starts, axis=0) for c in ("s", "t")])
        return own

    def joined(self, first: np.ndarray, past: np.ndarray) -> Stretches:
        """One stretch for each range of neighbours; an empty range has no moments."""
        some = first < past
        low, high = np.where(some, self.low[np.where(some, first, 0)], 0.0), np.where(some, self.high[np.where(some, past - 1, 0)], 0.0)
        found, level = Stretches(low, high, np.zeros((2, len(first), POWERS))), self
        middle, half = found.middle, found.half
        while some.any():
            for at, on in ((first, some & (first % 2 == 1)), (past - 1, some & (past % 2 == 1))):
                each = np.flatnonzero(on)
                if len(each):
                    node, wide = at[each], half[each]
                    shift = (level.middle[node] - middle[each]) / wide
                    found.moments[:, each] += _moved(level.moments[:, node], shift, level.half[node] / wide)
            first, past = (first + 1) // 2, past // 2
            some = first < past
            if some.any():
                level = level.paired()
        return found

    def paired(self) -> Stretches:
        low, high, moments = self.low, self.high, self.moments
        if len(low) % 2:
            low, high = np.append(low, high[-1]), np.append(high, high[-1])
            moments = np.concatenate([moments, np.zeros((2, 1, POWERS))], axis=1)
        each = Stretches(low, high, moments)
        pair = Stretches(low[0::2], high[1::2], np.empty(0))
        middle, half = np.repeat(pair.middle, 2), np.repeat(pair.half, 2)
        moved = _moved(moments, (each.middle - middle) / half, each.half / half)
        pair.moments = moved[:, 0::2] + moved[:, 1::2]
        return pair


def _weighted(powers: np.ndarray) -> np.ndarray:
    """Sums with the tricube weight of distance to the power 0, 1 and 2, from sums of plain powers."""
    return powers[..., 0:3] - 3 * powers[..., 3:6] + 3 * powers[..., 6:9] - powers[..., 9:12]


def _weighted_about(moments: np.ndarray, a: np.ndarray, b: np.ndarray, about: np.ndarray) -> np.ndarray:
    """As ``_weighted`` of the moments moved to ``a + b * u``, with powers of the distance less ``about``."""
    found = []
    for _ in range(3):
        moved = _moved(np.concatenate([moments, np.zeros((*moments.shape[:2], POWERS - moments.shape[2]))], axis=2), a, b)
        found.append(_weighted(moved)[..., 0])
        moments = moments[..., :-1] * (a - about)[:, None] + moments[..., 1:] * b[:, None]
    return np.stack(found, axis=2)


def _add_stretches(
    sums: np.ndarray, items: Stretches, first: np.ndarray, past: np.ndarray, x: np.ndarray, h: np.ndarray, side: int, about: np.ndarray | None
) -> None:
    """Adds to ``sums`` (2, fits, 3) the items ``first`` up to ``past`` of every fit, all on one side of it."""
    level = items
    while (first < past).any():
        for at, on in ((first, (first < past) & (first % 2 == 1)), (past - 1, (first < past) & (past % 2 == 1))):
            fits = np.flatnonzero(on)
            if len(fits):
                node, scale = at[fits], side / h[fits]
                place = level.moments[:, node], (level.middle[node] - x[fits]) * scale, level.half[node] * scale
                found = _weighted(_moved(*place)) if about is None else _weighted_about(*place, about[fits] * side)
                sums[:, fits] += found * np.array([1.0, side, 1.0])
        first, past = (first + 1) // 2, past // 2
        if (first < past).any():
            level = level.paired()


def _add_knots(
    sums: np.ndarray, knots: np.ndarray, first: np.ndarray, past: np.ndarray, x: np.ndarray, h: np.ndarray, about: np.ndarray | None
) -> None:
    """Adds the knots ``first`` up to ``past`` of every fit, one by one."""
    for i in range(int((past - first).max(initial=0))):
        fits = np.flatnonzero(first + i < past)
        knot = knots[first[fits] + i]
        shift, wide = knot["x"] - x[fits], h[fits] > 0
        away = shift / np.where(wide, h[fits], 1.0)
        # without a radius only the rows at the very place count
        distance = np.where(wide, np.abs(away), np.where(shift == 0, 0.0, 2.0))
        weight = 1.0 - distance * distance * distance
        weight = np.where(distance <= INNER, 1.0, np.where(distance > OUTER, 0.0, weight * weight * weight))
        away = away if about is None else away - about[fits]
        by_power = np.stack([weight, weight * away, weight * away * away], axis=1)
        sums[0, fits] += by_power * knot["s"][:, None]
        sums[1, fits] += by_power * knot["t"][:, None]


# --- one block ------------------------------------------------------------------------------


def _radius(x: np.ndarray, starts: np.ndarray, ends: np.ndarray, upto: np.ndarray, k: int) -> np.ndarray:
    """Distance from each x to its k-th nearest row, rows of a knot counting at the knot.

    ``starts`` and ``ends`` are the knots where a neighbourhood can end and the stretches between them, ``upto``
    the rows of the group up to each end; no neighbourhood ends inside such a stretch, so it is taken as a whole.
    """
    before = np.append(0.0, upto[:-1])
    # the narrowest window with enough rows from each start; its middle moves on with the start
    last = np.searchsorted(upto, before + k, "left")
    starts, far = starts[last < len(ends)], ends[last[last < len(ends)]]
    near = np.searchsorted(starts + far, 2 * x, "left")
    best = np.full(len(x), np.inf)
    # the middles are rounded, so the one beyond is looked at as well
    for at in (near - 1, near, near + 1):
        at = np.clip(at, 0, len(starts) - 1)
        best = np.minimum(best, np.maximum(x - starts[at], far[at] - x))
    return best


def _add_leaves(sums: np.ndarray, leaves: np.ndarray, items: np.ndarray, x: np.ndarray, h: np.ndarray) -> None:
    """Adds to ``sums`` (leaves, fits, 5) the knots of the ``items`` (leaves, any) of every leaf, each knot to all fits of the leaf.

    ``leaves`` (x, s, t; all items; knots) are padded by knots without rows, ``x`` and ``h`` (leaves, fits) by any fits.
    """
    for i in range(0, len(x), AT_ONCE):
        part = slice(i, i + AT_ONCE)
        place, s, t = leaves[:, items[part]].reshape(3, len(items[part]), -1)
        away = place[:, None, :] - x[part, :, None]
        away /= h[part, :, None]
        np.clip(away, -2.0, 2.0, out=away)
        distance = np.abs(away)
        within = distance <= OUTER
        distance *= distance > INNER
        weight = distance * distance
        weight *= distance
        np.subtract(1.0, weight, out=weight)
        np.multiply(weight, weight, out=distance)
        weight *= distance
        weight *= within
        both = np.stack([s, t], axis=2)
        sums[part, :, 0:2] += weight @ both
        weight *= away
        sums[part, :, 2:4] += weight @ both
        weight *= away
        sums[part, :, 4:] += weight @ both[:, :, :1]


def _add_joined(sums: np.ndarray, stretch: Stretches, x: np.ndarray, h: np.ndarray, side: int) -> None:
    """Adds to ``sums`` (leaves, fits, 5) the one stretch of every leaf, on one side of all its fits."""
    middle, half, moments = stretch.middle[:, None], stretch.half[:, None], stretch.moments.transpose(1, 2, 0)
    for i in range(0, len(x), AT_ONCE):
        part = slice(i, i + AT_ONCE)
        scale = side / h[part]
        turned = (_powers((middle[part] - x[part]) * scale) @ _TURNED).reshape(*scale.shape, 3, POWERS)
        turned *= _powers(half[part] * scale)[:, :, None, :]
        found = turned.reshape(len(scale), -1, POWERS) @ moments[part]
        sums[part] += found.reshape(*scale.shape, 6)[:, :, :5] * np.array([1.0, 1.0, side, side, 1.0])


def _block_fits(own: np.ndarray, raw: dict[int, np.ndarray], others: dict[int, tuple[float, Stretches]], k: int) -> np.ndarray:
    """Weighted line through the neighbourhood of each own knot, evaluated there; NaN without any weight.

    ``raw`` are the blocks with single knots at hand (the own ones among them, whole), ``others`` rows and moments
    of the stretches of blocks between them, by the number of their first block.

    The fits of a leaf share the items that lie inside all their neighbourhoods: these are joined once, and
    the items where the neighbourhoods end are added knot by knot to all fits. Where the ends are far apart, each
    fit looks for its own items.
    """
    blocks = sorted([*raw, *others])
    knots = np.concatenate([raw[b] for b in blocks if b in raw])
    # a leaf never crosses the end of a block
    starts, parts, upto, first, last, seen, held = [], [], [], [], [], 0.0, 0
    for b in blocks:
        if b in raw:
            leaves = np.arange(0, len(raw[b]), LEAF_KNOTS)
            parts.append(Stretches.of_knots(raw[b], leaves))
            starts.append(held + leaves)
            upto.append(seen + np.cumsum(raw[b]["n"]))
            first.append(raw[b]["x"])
            last.append(raw[b]["x"])
            held += len(raw[b])
        else:
            rows, stretch = others[b]
            parts.append(stretch)
            starts.append(np.array([-1]))
            upto.append(np.array([seen + rows]))
            first.append(stretch.low)
            last.append(stretch.high)
        seen = upto[-1][-1]
    items = Stretches(*[np.concatenate([getattr(p, c) for p in parts]) for c in ("low", "high")], np.concatenate([p.moments for p in parts], axis=1))
    start = np.concatenate(starts)  # first knot of a leaf, -1 for a stretch without knots
    size = np.zeros(len(start), np.int64)
    leaf = np.flatnonzero(start >= 0)
    size[leaf] = np.diff(np.append(start[leaf], len(knots)))
    x = own["x"]
    h = _radius(x, np.concatenate(first), np.concatenate(last), np.concatenate(upto), k)
    sums = np.zeros((2, len(x), 3))
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        home = np.searchsorted(items.low, x, "right") - 1
        left = np.minimum(np.searchsorted(items.low, x - OUTER * h, "left"), home)
        right = np.maximum(np.searchsorted(items.high, x + OUTER * h, "right"), home + 1)
        # what the fits of a leaf need: items wholly inside for all of them, and those inside for some or cut
        of = np.flatnonzero(np.diff(home, prepend=-1))
        at, ends = home[of], [np.maximum(np.minimum.reduceat(left, of) - 1, 0), np.minimum(np.maximum.reduceat(right, of) + 1, len(start))]
        inside = [np.maximum.reduceat(left, of), np.minimum.reduceat(right, of)]
        ragged = inside[0] - ends[0] + ends[1] - inside[1]
        blind = np.append(0, np.cumsum(start < 0))
        # a stretch without knots is wholly inside or wholly outside
        split = blind[inside[0]] - blind[np.minimum.reduceat(left, of)] + blind[np.maximum.reduceat(right, of)] - blind[inside[1]]
        even = (ragged <= RAGGED) & (split == 0) & (np.minimum.reduceat(h, of) > 0) & np.isfinite(np.maximum.reduceat(h, of))
        each = np.repeat(np.arange(len(of)), np.diff(np.append(of, len(x))))
        if even.any():
            table = np.zeros((3, len(start), LEAF_KNOTS))
            table[0] = items.high[:, None]
            into = np.repeat(leaf, size[leaf]), np.arange(len(knots)) - np.repeat(start[leaf], size[leaf])
            for c, values in enumerate((knots["x"], knots["s"], knots["t"])):
                table[c][into] = values
            chosen = np.flatnonzero(even)
            fit = np.flatnonzero(even[each])
            spot = (np.cumsum(even) - 1)[each[fit]], fit - of[each[fit]]
            centre, radius = table[0, at[chosen]], np.repeat(np.maximum.reduceat(h, of)[chosen], LEAF_KNOTS).reshape(-1, LEAF_KNOTS)
            radius[spot] = h[fit]
            found = np.zeros((len(chosen), LEAF_KNOTS, 5))
            both = items.joined(np.append(inside[0][chosen], at[chosen] + 1), np.append(at[chosen], inside[1][chosen]))
            for side, some in ((-1, slice(len(chosen))), (1, slice(len(chosen), None))):
                _add_joined(found, Stretches(both.low[some], both.high[some], both.moments[:, some]), centre, radius, side)
            for many in np.unique(ragged[chosen]):
                same = np.flatnonzero(ragged[chosen] == many)
                which, step = chosen[same], np.arange(many)
                before = (inside[0] - ends[0])[which][:, None]
                single = np.where(step < before, ends[0][which][:, None] + step, inside[1][which][:, None] + step - before)
                single = np.concatenate([at[which][:, None], single], axis=1)
                more = np.zeros((len(same), LEAF_KNOTS, 5))
                _add_leaves(more, table, single, centre[same], radius[same])
                found[same] += more
            sums[:, fit] = found[spot][:, [[0, 2, 4], [1, 3, 3]]].transpose(1, 0, 2)
        rest = np.flatnonzero(~even[each])
        if len(rest):
            sums[:, rest] = _single_fits(items, knots, start, size, x[rest], h[rest], home[rest], left[rest], right[rest])
        (a0, a1, a2), (b0, b1, _) = sums[0].T, sums[1].T
        spread = a0 * a2 - a1 * a1
        fits = np.where(spread > 1e-12 * a0 * a2, (a2 * b0 - a1 * b1) / spread, b0 / a0)
        # all weight far away on one side: sums about its mean, lest the line's spread is lost in rounding
        poor = np.flatnonzero((a0 > 0) & (np.abs(spread) < POOR * a0 * a2))
        if len(poor):
            mean = (a1 / a0)[poor]
            sums = _single_fits(items, knots, start, size, x[poor], h[poor], home[poor], left[poor], right[poor], mean)
            (c0, c1, c2), (d0, d1, _) = sums[0].T, sums[1].T
            var, level = c2 - c1 * c1 / c0, d0 / c0
            fits[poor] = np.where(var > 1e-12 * a2[poor], level - (d1 - c1 * level) / var * (mean + c1 / c0), level)
    return np.where(a0 > 0, fits, np.nan)


def _single_fits(
    items: Stretches, knots: np.ndarray, start: np.ndarray, size: np.ndarray,
    x: np.ndarray, h: np.ndarray, home: np.ndarray, left: np.ndarray, right: np.ndarray, about: np.ndarray | None = None,
) -> np.ndarray:
    """Sums (2, fits, 3) of fits that share nothing: items ``left`` up to ``right``, and single knots at both ends and at ``home``.

    The powers are those of the distance in shares of ``h``, less ``about`` where this is given.
    """
    sums = np.zeros((2, len(x), 3))
    _add_stretches(sums, items, left, home, x, h, -1, about)
    _add_stretches(sums, items, home + 1, right, x, h, 1, about)
    # the leaf of the knot itself, and those that the neighbourhood ends in
    for at, real in ((home, np.full(len(x), True)), (left - 1, left > 0), (right, right < len(start))):
        at = np.clip(at, 0, len(start) - 1)
        first = np.maximum(start[at], 0)
        _add_knots(sums, knots, first, np.where(real, first + size[at], first), x, h, about)
    return sums


# --- blocks of a group ----------------------------------------------------------------------


def _plan(blocks: pd.DataFrame, k: int) -> list[tuple[int, int]]:
    """Pairs (block, block where one of its neighbourhoods can end), from ranges and row counts alone.

    The ends of a neighbourhood move with its knot, so those of the outermost knots enclose the others;
    the radius there is enclosed by the rows of the blocks wholly inside, and of those only touched.
    """
    low, high = blocks["low"].to_numpy(), blocks["high"].to_numpy()
    through = np.append(0, np.cumsum(blocks["rows"].to_numpy()))
    span = high[-1] - low[0]

    def enclosed(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        def bisect(count) -> tuple[np.ndarray, np.ndarray]:
            few, enough = np.full(len(x), -1.0), np.full(len(x), span)
            for _ in range(64):
                middle = (few + enough) / 2
                reached = count(middle) >= k
                few, enough = np.where(reached, few, middle), np.where(reached, middle, enough)
            return few, enough

        inside = bisect(lambda d: through[np.searchsorted(high, x + d, "right")] - through[np.searchsorted(low, x - d, "left")])
        touched = bisect(lambda d: through[np.searchsorted(low, x + d, "right")] - through[np.searchsorted(high, x - d, "left")])
        return np.maximum(touched[0], 0.0), inside[1]

    least_low, most_low = enclosed(low)
    least_high, most_high = enclosed(high)
    margin = 1e-9 * span
    zones = [
        (low - most_low - margin, high - OUTER * least_high + margin),
        (low + OUTER * least_low - margin, high + most_high + margin),
    ]
    number = blocks["block"].to_numpy()
    found = {(int(b), int(b)) for b in number}
    for first, last in zones:
        from_, past = np.searchsorted(high, first, "left"), np.searchsorted(low, last, "right")
        # ends between two blocks: one of them, so that blocks on either side are never joined
        past = np.where((from_ == past) & (from_ > 0) & (from_ < len(low)), past + 1, past)
        for b, i, j in zip(number.tolist(), from_.tolist(), past.tolist()):
            found.update((b, int(s)) for s in number[i:j])
    return sorted(found)


def _teams(blocks: pd.DataFrame, k: int, most: int, teams: int) -> tuple[list[dict], list[dict]]:
    """The plan for teams of neighbouring blocks: ``sources`` with single knots, and ``runs`` of the blocks between these.

    A team has up to ``most`` blocks, fewer where a group would have fewer than ``teams``.
    A run of blocks is wholly inside or wholly outside the neighbourhood of each of the team's knots.
    """
    number = blocks["block"].to_numpy()
    each = max(1, min(most, len(number) // teams))
    sources, runs = [], []
    plan = pd.DataFrame(_plan(blocks, k), columns=["block", "source"])
    for team, found in plan.groupby(plan["block"] // each)["source"]:
        used = np.unique(found)
        sources += [{"team": int(team), "source": int(s), "own": int(s) // each == team} for s in used]
        ends = np.concatenate([[number[0] - 1], used, [number[-1] + 1]])
        runs += [{"team": int(team), "first": int(a) + 1, "past": int(b)} for a, b in zip(ends[:-1], ends[1:]) if b > a + 1]
    return sources, runs


def _same(columns: Sequence[str], left: str, right: str) -> Column:
    return F.expr(" and ".join(f"{left}.`{c}` <=> {right}.`{c}`" for c in columns))


def _beside(part: pa.Table, columns: dict[str, Sequence], schema: T.StructType) -> pa.Table:
    """A table with the ``columns``, and those of the first row of ``part`` in every row."""
    arrow = to_arrow_schema(schema)
    some = {c: pa.array(v, arrow.field(c).type) for c, v in columns.items()}
    rows = len(next(iter(some.values())))
    first = part.take(pa.array(np.zeros(rows, np.int64)))
    return pa.table([some[c] if c in some else first.column(c).cast(arrow.field(c).type) for c in arrow.names], schema=arrow)


def _few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of blocks or pieces in small batches, as each of them holds many rows."""
    for batch in batches:
        for i in range(0, batch.num_rows, 64):
            yield batch.slice(i, 64)


def _line(own: np.ndarray) -> dict[str, list[bytes]]:
    """A block's knots, and their rows, ends and moments."""
    stretch = Stretches.of_knots(own, np.zeros(1, np.int64))
    line = np.concatenate([[own["n"].sum()], stretch.low, stretch.high, stretch.moments.ravel()])
    return {"knots": [own.tobytes()], "line": [line.tobytes()]}


class _Smoother:
    """The knots of all groups in blocks, and the jobs that fit them."""

    def __init__(self, rows: DataFrame, keys: Sequence[str], spans: Sequence[float]):
        self.keys, self.group = list(keys), [*keys, "frac"]
        counted = rows.groupBy(*keys, "x").agg(F.count("*").alias("n"), F.max(F.abs("y")).alias("largest"))
        numbered = with_row_index(counted, ["x"], keys, "__place")
        sizes = numbered.groupBy(*keys).agg(F.greatest(F.ceil(F.sqrt(F.count("*"))), F.lit(BLOCK_KNOTS)).alias("__size"))
        # staged, so that the planner sees that there is one row for each group
        sizes = stage(sizes, "lowess-sizes")
        knots = stage(attach(numbered, sizes, keys).withColumn("block", F.expr("__place div __size")), "lowess-knots")
        # the number of a row's block goes with it through all passes, and whether its knot is hot
        place = knots.select(*keys, "x", "block", (knots["n"] > HOT_ROWS).alias("hot"))
        on = [*keys, "x"]
        if planned_bytes(place) <= broadcast_limit(rows):
            placed = attach(rows, place, on)
        else:
            known = attach(rows, stage(place.filter("hot"), "lowess-hot"), on, "left")
            cold = attach(known.filter("hot is null").drop("block", "hot"), place, on, salts=1)
            placed = known.filter("hot").unionByName(cold)
        self.rows, self.hot = stage(placed, "lowess-rows"), place.filter("hot").select(*keys, "block", "x")
        self.old = self.packed = None
        layout = knots.groupBy(*keys, "block").agg(
            F.min("x").alias("low"), F.max("x").alias("high"), F.sum("n").alias("rows"), F.max("largest").alias("largest")
        )
        fields = [f for f in rows.schema.fields if f.name in keys]
        text = "frac double, k long, largest double, sources array<struct<team: long, source: long, own: boolean>>"
        wide = T.DataType.fromDDL(f"{text}, runs array<struct<team: long, first: long, past: long>>").fields
        schema = T.StructType([*fields, *wide])
        spans = [float(s) for s in spans]

        def plan(part: pa.Table) -> pa.Table:
            blocks = part.select(["block", "low", "high", "rows", "largest"]).to_pandas().sort_values("block")
            total, found = int(blocks["rows"].sum()), []
            for frac in spans:
                k = max(int(np.floor(frac * total + 1e-10)), 1)
                found.append((frac, k, blocks["largest"].max(), *_teams(blocks, min(k, total), TEAM_BLOCKS, TEAMS)))
            return _beside(part.select(keys), dict(zip([f.name for f in wide], zip(*found))), schema)

        self.reach = stage(layout.groupBy(*keys).applyInArrow(plan, schema), "lowess-reach")
        self.has_runs = not self.reach.filter("size(runs) > 0").isEmpty()
        self.fields = [*fields, wide[0]]
        self.spans = F.explode(F.array(*[F.lit(s) for s in spans])).alias("frac")
        # fits take about what the knots take; where they cannot be broadcast, no pass moves single rows
        self.parts = self.pieces = None
        if planned_bytes(knots) * len(spans) > broadcast_limit(rows):
            self.parts = stage(layout.selectExpr(*keys, "block", f"cast(ceil(rows / {PIECE_ROWS}) as long) as parts"), "lowess-parts")
            self.pieces = self._pieces()

    def _pieces(self) -> DataFrame:
        """The rows of every block in pieces of some ``PIECE_ROWS``, each one line: the distinct ``x``, their rows ``n``, and ``y`` in the order of x."""
        keys = self.keys
        # numbered as they were written, so that a row stays in its piece if a task is run again
        rows = self.rows.select(*keys, "block", "x", "y").withColumn("__id", F.monotonically_increasing_id())
        rows = attach(rows, self.parts, [*keys, "block"]).withColumn("piece", F.expr("pmod(__id, parts)"))

        def pack(part: pa.Table) -> pa.Table:
            x, y = part.column("x").to_numpy(), part.column("y").to_numpy()
            order = np.argsort(x, kind="stable")
            knots, n = np.unique(x, return_counts=True)
            line = {"x": knots, "n": n.astype(float), "y": y[order]}
            return _beside(part.select([*keys, "block", "piece"]), {c: [v.tobytes()] for c, v in line.items()}, schema)

        schema = T.StructType([*self.fields[:-1], *T.DataType.fromDDL("block long, piece long, x binary, n binary, y binary").fields])
        packed = rows.select(*keys, "block", "piece", "x", "y").groupBy(*keys, "block", "piece").applyInArrow(pack, schema)
        return stage(packed, "lowess-pieces")

    def start(self) -> DataFrame:
        """Fits without robust weights."""
        if self.pieces is None:
            return stage(self._fit_sums(self._sums(self.spread(), F.lit(1.0))), "lowess-fit")
        whole = self.pieces.select("*", self.spans, F.lit(None).cast("binary").alias("error"), F.lit(1.0).alias("scale"))
        return stage(self._fit_sums(self._piece_sums(whole)), "lowess-fit")

    def next(self, fits: DataFrame) -> DataFrame:
        """Fits with the robust weights of the errors of ``fits``."""
        errors = self.errors(fits)
        scale = exact_median(self.loose(errors), self.group, "error")
        scale = scale.selectExpr(*self.group, f"case when median > {ROUNDING!r}D then 6 * median end as scale")
        # both uses below would rank all errors anew
        scale = stage(scale, "lowess-scale")
        weighted = attach(errors, scale.filter("scale is not null"), self.group)
        settled = attach(fits, scale.filter("scale is null"), self.group, salts=1).drop("scale")
        if self.pieces is None:
            u = F.col("error") / F.col("scale")
            weight = F.when(u > OUTER, 0.0).when(u < INNER, 1.0).otherwise((1 - u * u) * (1 - u * u))
            sums = self._sums(weighted.withColumn("robust", weight), F.col("robust"))
        else:
            sums = self._piece_sums(weighted)
        return stage(self._fit_sums(sums).unionByName(settled), "lowess-fit")

    def spread(self) -> DataFrame:
        """All rows once for each span; multiplied only while they are read."""
        return self.rows.select("*", self.spans)

    def _sums(self, rows: DataFrame, weight: Column) -> DataFrame:
        """Every block's knots in one line, with the sums of the weighted rows."""
        group = self.group
        sums = rows.groupBy(*group, "block", "x").agg(
            F.count("*").cast("double").alias("n"), F.sum(weight).alias("s"), F.sum(weight * F.col("y")).alias("t")
        )

        def pack(part: pa.Table) -> pa.Table:
            own = np.empty(part.num_rows, KNOT)
            for c in KNOT.names:
                own[c] = part.column(c).to_numpy()
            return _beside(part.select([*group, "block"]), _line(own[np.argsort(own["x"], kind="stable")]), schema)

        schema = T.StructType([*self.fields, *_LINE])
        return sums.groupBy(*group, "block").applyInArrow(pack, schema)

    def _piece_sums(self, pieces: DataFrame) -> DataFrame:
        """As ``_sums``, of pieces weighted by their errors in shares of ``scale``."""
        group = self.group

        def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _few(batches):
                tables = []
                for x, n, y, error, scale in zip(*[batch.column(c).to_pylist() for c in ("x", "n", "y", "error", "scale")]):
                    x, n, y = np.frombuffer(x), np.frombuffer(n), np.frombuffer(y)
                    u = np.frombuffer(error) / scale if error is not None else np.zeros(len(y))
                    weight = np.where(u > OUTER, 0.0, np.where(u < INNER, 1.0, (1 - u * u) * (1 - u * u)))
                    starts = (np.cumsum(n) - n).astype(np.int64)
                    own = np.empty(len(x), KNOT)
                    own["x"], own["n"], own["s"], own["t"] = x, n, np.add.reduceat(weight, starts), np.add.reduceat(weight * y, starts)
                    tables.append(own.tobytes())
                yield pa.record_batch([*[batch.column(c) for c in (*group, "block")], pa.array(tables, pa.binary())], [*group, "block", "knots"])

        def pack(part: pa.Table) -> pa.Table:
            own = np.frombuffer(b"".join(part.column("knots").to_pylist()), KNOT)
            if part.num_rows > 1:
                x, at = np.unique(own["x"], return_inverse=True)
                whole = np.empty(len(x), KNOT)
                whole["x"] = x
                for c in ("n", "s", "t"):
                    whole[c] = np.bincount(at, own[c], len(x))
                own = whole
            return _beside(part.select([*group, "block"]), _line(own), schema)

        schema = T.StructType([*self.fields, *_LINE])
        tables = pieces.select(*group, "block", "x", "n", "y", "error", "scale").mapInArrow(weigh, T.StructType([*schema.fields[:-1]]))
        return tables.groupBy(*group, "block").applyInArrow(pack, schema)

    def _fit_sums(self, sums: DataFrame) -> DataFrame:
        """``fit`` per knot, null where no weight is left around it, and the ``largest`` |y| of its group; a line for each block if rows are in pieces."""
        group, fields, in_lines = self.group, self.fields, self.pieces is not None
        blocks = sums
        if in_lines:
            blocks, self.packed = stage_instead(sums, "lowess-packed", self.packed)

        def join(lines: pa.Table, reach: pa.Table) -> pa.Table:
            runs = pd.DataFrame([run for cell in reach.column("runs").to_pylist() for run in cell], columns=["team", "first", "past"])
            if not lines.num_rows or not len(runs):
                return to_arrow_schema(parts).empty_table()
            order = np.argsort(lines.column("block").to_numpy())
            line = np.frombuffer(b"".join(lines.column("line").take(order).to_pylist())).reshape(len(order), -1)
            whole = Stretches(line[:, 1], line[:, 2], np.ascontiguousarray(line[:, 3:].reshape(-1, 2, POWERS).swapaxes(0, 1)))
            upto = np.append(0.0, np.cumsum(line[:, 0]))
            first, past = runs["first"].to_numpy(np.int64), runs["past"].to_numpy(np.int64)
            run = whole.joined(first, past)
            table = np.column_stack([first, upto[past] - upto[first], run.low, run.high, run.moments.swapaxes(0, 1).reshape(len(first), -1)])
            teams = list(runs.groupby("team").indices.items())
            found = {
                "team": [int(t) for t, _ in teams], "source": [-1] * len(teams), "own": [False] * len(teams),
                "knots": [table[at].tobytes() for _, at in teams],
            }
            return _beside(reach.select([*group, "k", "largest"]), found, parts)

        wide = T.DataType.fromDDL("k long, largest double, team long, source long, own boolean, knots binary")
        parts = T.StructType([*fields, *wide.fields])
        near = self.reach.select(*group, "k", "largest", F.inline("sources")).alias("r").join(
            blocks.select(*group, F.col("block").alias("source"), "knots").alias("p"), _same([*group, "source"], "r", "p")
        )

        def fit(part: pa.Table) -> pa.Table:
            raw, others, own = {}, {}, []
            for source, is_own, cell in zip(*[part.column(c).to_pylist() for c in ("source", "own", "knots")]):
                if source < 0:
                    for line in np.frombuffer(cell).reshape(-1, 4 + 2 * POWERS):
                        others[int(line[0])] = line[1], Stretches(line[2:3], line[3:4], line[4:].reshape(2, 1, POWERS))
                else:
                    raw[source] = np.frombuffer(cell, KNOT)
                    own += [source] * is_own
            own.sort()
            knots = np.concatenate([raw[b] for b in own])
            found = _block_fits(knots, raw, others, part.column("k")[0].as_py())
            ends = np.cumsum([len(raw[b]) for b in own])
            if in_lines:
                found = {"x": [raw[b]["x"].tobytes() for b in own], "fit": [v.tobytes() for v in np.split(found, ends[:-1])], "block": own}
            else:
                found = {"x": knots["x"], "fit": found, "block": np.repeat(own, np.diff(ends, prepend=0))}
            return _beside(part.select([*group, "largest"]), found, schema)

        kind = "binary" if in_lines else "double"
        schema = T.StructType([*fields, *T.DataType.fromDDL(f"block long, x {kind}, fit {kind}, largest double").fields])
        # a row for each block that a team looks into, and one with the runs between these
        needed = near.select("r.*", "p.knots")
        if self.has_runs:
            lines = blocks.select(*group, "block", "line").groupBy(*group)
            needed = needed.unionByName(lines.cogroup(self.reach.groupBy(*group)).applyInArrow(join, parts))
        fitted = dealt(needed, *group, "team").groupBy(*group, "team").applyInArrow(fit, schema)
        return fitted if in_lines else fitted.withColumn("fit", F.nanvl("fit", F.lit(None).cast("double")))

    def scored(self, fits: DataFrame) -> DataFrame:
        """All rows with the fit of their knot: the rows of a hot knot are spread over tasks, the others joined plainly."""
        on = [*self.group, "block", "x"]
        if self.pieces is not None:
            fits = stage(self._single(fits), "lowess-fit")
        if planned_bytes(fits) <= broadcast_limit(fits):
            joined = attach(self.spread(), fits, on)
        else:
            # only fits of hot knots are repeated, so few; all of them are joined to the other rows
            few = stage(attach(self.hot.select("*", self.spans), fits, on, salts=1), "lowess-hot-fits")
            joined = attach(self.spread().filter("hot"), few, on).unionByName(attach(self.spread().filter("not hot"), fits, on, salts=1))
        return joined.withColumn("fitted", F.coalesce("fit", "y"))

    def _single(self, fits: DataFrame) -> DataFrame:
        """Lines of blocks as a row for each knot."""
        kept = [*self.group, "block"]

        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _few(batches):
                x, fit = [[np.frombuffer(v) for v in batch.column(c).to_pylist()] for c in ("x", "fit")]
                at = pa.array(np.repeat(np.arange(len(x)), [len(v) for v in x]))
                values = [pa.array(np.concatenate([np.empty(0), *v])) for v in (x, fit)]
                yield pa.record_batch([*[batch.column(c).take(at) for c in kept], *values], [*kept, "x", "fit"])

        schema = T.StructType([*self.fields, *T.DataType.fromDDL("block long, x double, fit double").fields])
        return fits.select(*kept, "x", "fit").mapInArrow(spread, schema).withColumn("fit", F.nanvl("fit", F.lit(None).cast("double")))

    def errors(self, fits: DataFrame) -> DataFrame:
        """All rows, or their pieces, with their ``error`` in shares of the largest |y|; written once where the fits took a join of all rows."""
        keys, group = self.keys, self.group
        if self.pieces is None:
            share = F.abs(F.col("y") - F.col("fitted")) / F.col("largest")
            found = self.scored(fits).withColumn("error", F.when(F.col("largest") > 0, share).otherwise(0.0))
            if planned_bytes(fits) > broadcast_limit(fits):
                found, self.old = stage_instead(found.select(*group, "block", "x", "y", "error"), "lowess-errors", self.old)
            return found
        # the line of a block goes to each of its pieces
        lines = attach(fits, self.parts, [*keys, "block"]).selectExpr(
            *[f"`{c}`" for c in group], "block", "largest", "x as at", "fit", "explode(sequence(0L, parts - 1)) as piece"
        )
        joined = attach(self.pieces, lines, [*keys, "block", "piece"], salts=1)
        kept = [*group, "block", "x", "n", "y"]

        def error(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _few(batches):
                found = []
                for x, n, y, at, fit, largest in zip(*[batch.column(c).to_pylist() for c in ("x", "n", "y", "at", "fit", "largest")]):
                    x, y = np.frombuffer(x), np.frombuffer(y)
                    fitted = np.frombuffer(fit)[np.searchsorted(np.frombuffer(at), x)]
                    away = np.abs(y - np.repeat(fitted, np.frombuffer(n).astype(np.int64)))
                    # without a fit a row keeps its value
                    found.append((np.where(np.isnan(away), 0.0, away) / largest if largest > 0 else np.zeros(len(y))).tobytes())
                yield pa.record_batch([*[batch.column(c) for c in kept], pa.array(found, pa.binary())], [*kept, "error"])

        binary = T.DataType.fromDDL("block long, x binary, n binary, y binary, error binary").fields
        found = joined.select(*kept, "at", "fit", "largest").mapInArrow(error, T.StructType([*self.fields, *binary]))
        found, self.old = stage_instead(found, "lowess-errors", self.old)
        return found

    def loose(self, errors: DataFrame) -> DataFrame:
        """A row for each ``error``."""
        if self.pieces is None:
            return errors
        group = self.group

        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _few(batches):
                error = [np.frombuffer(v) for v in batch.column("error").to_pylist()]
                at = pa.array(np.repeat(np.arange(len(error)), [len(v) for v in error]))
                yield pa.record_batch([*[batch.column(c).take(at) for c in group], pa.array(np.concatenate([np.empty(0), *error]))], [*group, "error"])

        schema = T.StructType([*self.fields, T.StructField("error", T.DoubleType())])
        return errors.select(*group, "error").mapInArrow(spread, schema)


def lowess_smooth(
    rows: DataFrame,
    keys: Sequence[str],
    spans: Sequence[float] = (1 / 3,),
    iterations: int = 3,
) -> DataFrame:
    """Smoothed ``fitted`` for every row and span (column ``frac``), sorted output left to the caller.

    A row around which the robust passes leave no weight keeps its own value. A group whose median
    error is no more than rounding keeps the fit it has.
    """
    known = rows.filter(F.col("x").isNotNull() & F.col("y").isNotNull()).withColumns(
        {"x": F.col("x").cast("double"), "y": F.col("y").cast("double")}
    )
    smoother = _Smoother(known, keys, spans)
    fits = smoother.start()
    for _ in range(iterations):
        fits = smoother.next(fits)
    return smoother.scored(fits).select(*rows.columns, "frac", "fitted")
