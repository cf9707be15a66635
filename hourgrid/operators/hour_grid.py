"""Trailing windows by the clock, computed on a grid of hours per block.

A frame of clock hours slides over rows that may have gaps. Spark aggregates such a frame
again for every row, 168 steps for a week. Here the rows of a block are laid on a grid with
one slot per hour, empty where there is none, and the aggregates of the last 1, 2, 4, ...
hours are built by doubling, for all slots at once. A frame is put together from these: a
week takes eight doublings and two more steps for the whole block. Parts are merged as
counts, means and squared deviations, so nothing cancels.

Spark ships this module with the tasks, so the workers need numpy and pyarrow only.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

AGGREGATES = ("avg", "stddev", "min", "max")


@dataclass(frozen=True)
class Frame:
    """An aggregate of ``column`` over the last ``hours`` clock hours."""

    column: str
    hours: int
    agg: str


@dataclass(frozen=True)
class Parts:
    """Per slot: rows with a value, their mean, squared deviations, least and greatest."""

    n: np.ndarray
    mean: np.ndarray
    squares: np.ndarray
    least: np.ndarray
    most: np.ndarray

    def earlier(self, hours: int) -> Parts:
        """Each slot's parts of ``hours`` ago; before the grid there is nothing."""

        def moved(values: np.ndarray, empty: float) -> np.ndarray:
            out = np.full(len(values), empty)
            out[hours:] = values[: max(len(values) - hours, 0)]
            return out

        return Parts(
            moved(self.n, 0.0),
            moved(self.mean, 0.0),
            moved(self.squares, 0.0),
            moved(self.least, np.nan),
            moved(self.most, -np.inf),
        )

    def merged(self, other: Parts) -> Parts:
        n = self.n + other.n
        size = np.where(n > 0, n, 1.0)
        apart = other.mean - self.mean
        return Parts(
            n,
            self.mean + apart * other.n / size,
            self.squares + other.squares + apart * apart * self.n * other.n / size,
            # NaN ranks above all numbers: the least passes over it, the greatest keeps it.
            np.fmin(self.least, other.least),
            np.maximum(self.most, other.most),
        )

    def result(self, agg: str) -> tuple[np.ndarray, np.ndarray]:
        """Values and where they are missing."""
        if agg == "stddev":
            few = self.n < 2
            return np.sqrt(self.squares / np.where(few, 1.0, self.n - 1)), few
        values = {"avg": self.mean, "min": self.least, "max": self.most}[agg]
        return values, self.n == 0


def _laid_out(slots: np.ndarray, values: np.ndarray, missing: np.ndarray, size: int) -> Parts:
    """The rows on their slots; rows that share an hour share a slot."""
    slots, values = slots[~missing], values[~missing]
    n = np.bincount(slots, minlength=size).astype(float)
    mean = np.bincount(slots, values, size) / np.where(n > 0, n, 1.0)
    away = values - mean[slots]
    least, most = np.full(size, np.nan), np.full(size, -np.inf)
    np.fmin.at(least, slots, values)
    np.maximum.at(most, slots, values)
    return Parts(n, mean, np.bincount(slots, away * away, size), least, most)


def trailing(parts: Parts, lengths: Sequence[int]) -> dict[int, Parts]:
    """For each length in hours, the parts of every slot's last hours."""
    out: dict[int, Parts] = {}
    covered = dict.fromkeys(lengths, 0)
    power, width = parts, 1
    while width <= max(lengths):
        for length in lengths:
            if length & width:
                held = covered[length]
                out[length] = out[length].merged(power.earlier(held)) if held else power
                covered[length] = held + width
        power = power.merged(power.earlier(width))
        width *= 2
    return out


def rolled(
    frames: Mapping[str, Frame], at: str, own: str, drop: Sequence[str]
) -> Callable[[pa.Table], pa.Table]:
    """The grouped function that adds ``frames`` to a block and keeps its ``own`` rows.

    ``at`` numbers the hours. Rows without an hour are each other's only neighbours, as in
    a window of Spark: they share one slot.
    """

    def add(block: pa.Table) -> pa.Table:
        hours = block.column(at)
        if hours.null_count:
            slots = np.zeros(block.num_rows, np.int64)
        else:
            slots = hours.to_numpy()
            slots = slots - slots.min()
        size = int(slots.max()) + 1
        mine = block.column(own).to_numpy(zero_copy_only=False)
        columns = {name: block.column(name).filter(pa.array(mine)) for name in block.schema.names if name not in drop}
        made: dict[tuple[str, int], Parts] = {}
        for column in dict.fromkeys(frame.column for frame in frames.values()):
            values = block.column(column).cast(pa.float64())
            missing = values.is_null().to_numpy(zero_copy_only=False)
            laid = _laid_out(slots, values.to_numpy(), missing, size)
            lengths = sorted({f.hours for f in frames.values() if f.column == column})
            for length, parts in trailing(laid, lengths).items():
                made[column, length] = parts
        for name, frame in frames.items():
            values, missing = made[frame.column, frame.hours].result(frame.agg)
            columns[name] = pa.array(values[slots[mine]], pa.float64(), mask=missing[slots[mine]])
        return pa.table(columns)

    return add


cloudpickle.register_pickle_by_value(sys.modules[__name__])
