"""Counts, means and co-moments of all pairs of columns in one scan, over the rows where both are known.

Each task adds up its rows around their own means; two states merge by the exact formula for joined sets (the products of
the differences of means), so far-off columns lose no digits. States meet in two steps, so that neither one task nor the
driver sees more than about the square root of all tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreline.functions.expressions import finite


@dataclass
class CoMoments:
    """For each pair (i, j), over rows where both are known: rows ``n``, mean of i, squares of i and products of i and j
    around the means."""

    n: np.ndarray
    mean: np.ndarray
    square: np.ndarray
    product: np.ndarray

    @staticmethod
    def none(width: int) -> "CoMoments":
        return CoMoments(*np.zeros((4, width, width)))

    @staticmethod
    def of(x: np.ndarray) -> "CoMoments":
        """State of a matrix of doubles, NaN for a missing cell."""
        known = ~np.isnan(x)
        k = known.astype(np.float64)
        centre = np.where(known, x, 0).sum(axis=0) / np.maximum(k.sum(axis=0), 1)
        z = np.where(known, x - centre, 0)
        n = k.T @ k
        off = (z.T @ k) / np.maximum(n, 1)
        square, product = (z * z).T @ k - n * off * off, z.T @ z - n * off * off.T
        return CoMoments(n, off + centre[:, None] * (n > 0), np.maximum(square, 0), product)

    def merged(self, other: "CoMoments") -> "CoMoments":
        n = self.n + other.n
        share = self.n * other.n / np.maximum(n, 1)
        # where one side has no rows, the other's state stands as it is
        step = np.where(share > 0, other.mean - self.mean, 0)
        mean = np.where(self.n > 0, self.mean + step * other.n / np.maximum(n, 1), other.mean)
        return CoMoments(n, mean, self.square + other.square + step * step * share, self.product + other.product + step * step.T * share)

    def packed(self) -> bytes:
        return np.stack([self.n, self.mean, self.square, self.product]).tobytes()

    @staticmethod
    def unpacked(data: bytes) -> "CoMoments":
        flat = np.frombuffer(data, np.float64)
        width = math.isqrt(len(flat) // 4)
        return CoMoments(*flat.reshape(4, width, width))

    def pearson(self) -> np.ndarray:
        """r of each pair; NaN where one of them does not vary over the rows where both are known."""
        spread = np.sqrt(self.square) * np.sqrt(self.square.T)
        return np.where(spread > 0, self.product / np.where(spread > 0, spread, 1), np.nan)


def _row(state: CoMoments) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([state.packed()], pa.binary())], ["state"])


def _states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    state = None
    for batch in batches:
        x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
        state = CoMoments.of(x) if state is None else state.merged(CoMoments.of(x))
    if state is not None:
        yield _row(state)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    state = None
    for batch in batches:
        for data in batch.column(0).to_pylist():
            other = CoMoments.unpacked(data)
            state = other if state is None else state.merged(other)
    if state is not None:
        yield _row(state)


def comoments(df: DataFrame, columns: Sequence[str]) -> CoMoments:
    """The state of the whole table; infinities and NaN count as missing."""
    cells = df.select(*[finite(F.col(f"`{c}`").cast("double")).alias(f"c{i}") for i, c in enumerate(columns)])
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    states = cells.mapInArrow(_states, "state binary").repartition(max(2, math.isqrt(parts)))
    state = CoMoments.none(len(columns))
    for row in states.mapInArrow(_joined, "state binary").collect():  # a state a task of the second step
        state = state.merged(CoMoments.unpacked(bytes(row["state"])))
    return state
