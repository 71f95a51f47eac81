"""A fixed random recurrent network (echo state network, Jaeger 2001) as the features of a linear read-out.

The hidden weights are drawn once from a seed and never trained, so they are the same in every task.
Each window runs through the network from rest; its last state is a non-linear summary of the
window in which late values weigh more. Only the read-out is fitted, by ridge regression on second
moments that are summed over all blocks, so training is one pass over the data whatever its size.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

WINDOWS_AT_ONCE = 8192


@dataclass(frozen=True)
class Reservoir:
    """``units`` neurons; ``memory`` is the largest eigenvalue of the recurrent weights, ``gain`` scales the input."""

    units: int = 50
    memory: float = 0.6
    gain: float = 1.5
    seed: int = 42

    @cached_property
    def weights(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        draw = np.random.default_rng(self.seed)
        entry = draw.uniform(-self.gain, self.gain, self.units)
        bias = draw.uniform(-1.0, 1.0, self.units)
        inner = draw.normal(size=(self.units, self.units))
        return entry, bias, inner * (self.memory / np.abs(np.linalg.eigvals(inner)).max())

    def states(self, windows: np.ndarray) -> np.ndarray:
        """Last state of every window (rows, oldest value first, values about 0 to 1), shape (windows, units)."""
        entry, bias, inner = self.weights
        found = np.zeros((len(windows), self.units))
        for at in range(0, len(windows), WINDOWS_AT_ONCE):
            part = 2.0 * windows[at : at + WINDOWS_AT_ONCE] - 1.0
            state = np.zeros((len(part), self.units))
            for step in part.T:
                state = np.tanh(np.outer(step, entry) + state @ inner + bias)
            found[at : at + WINDOWS_AT_ONCE] = state
        return found


def read_out(reservoir: Reservoir, window: Column, intercept: Column, weights: Column) -> Column:
    """Forecast from a window and the fitted read-out; null for a window with a missing value."""

    def batch(windows: pa.Array, intercepts: pa.Array, weights: pa.Array) -> pa.Array:
        if not len(windows):
            return pa.array([], pa.float64())
        table = np.array([[np.nan if v is None else v for v in w] for w in windows.to_pylist()], float)
        known = np.isfinite(table).all(axis=1)
        line = np.array(weights.to_pylist(), float)
        value = intercepts.to_numpy(zero_copy_only=False) + (reservoir.states(np.where(known[:, None], table, 0.0)) * line).sum(axis=1)
        return pa.array(value, mask=~known)

    batch.__annotations__ = {"windows": pa.Array, "intercepts": pa.Array, "weights": pa.Array, "return": pa.Array}
    return F.arrow_udf(batch, "double")(window, intercept, weights)
