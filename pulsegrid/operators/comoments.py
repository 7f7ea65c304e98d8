"""Count, means, ranges and co-moments of many columns in one pass.

Every task centres its batches and keeps one state (count, means, the matrix of
summed products of deviations, minima, maxima); two states merge by the
pairwise update of Chan, Golub and LeVeque, so nothing cancels as it would in
sums of squares. Standardisation, the first principal component, its sign and
the share of variance it explains are read from the merged matrix, without a
further pass over the rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: States that meet in one merging task, and at the driver (8 bytes a pair of columns each).
FAN_IN = 32


@dataclass
class Moments:
    n: int
    mean: np.ndarray
    products: np.ndarray  # summed products of deviations, columns x columns
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray) -> Moments:
        mean = x.mean(axis=0)
        off = x - mean
        return cls(len(x), mean, off.T @ off, x.min(axis=0), x.max(axis=0))

    @classmethod
    def empty(cls, d: int) -> Moments:
        return cls(0, np.zeros(d), np.zeros((d, d)), np.full(d, np.inf), np.full(d, -np.inf))

    def merged(self, other: Moments) -> Moments:
        n = self.n + other.n
        if not n:
            return self
        step = other.mean - self.mean
        products = self.products + other.products + np.outer(step, step) * (self.n * other.n / n)
        return Moments(n, self.mean + step * (other.n / n), products, np.minimum(self.low, other.low), np.maximum(self.high, other.high))

    def packed(self) -> tuple[int, bytes]:
        return self.n, np.concatenate([self.mean, self.products.ravel(), self.low, self.high]).tobytes()

    @classmethod
    def unpacked(cls, n: int, state: bytes, d: int) -> Moments:
        v = np.frombuffer(state)
        return cls(n, v[:d], v[d : d + d * d].reshape(d, d), v[d + d * d : 2 * d + d * d], v[2 * d + d * d :])

    def deviations(self) -> np.ndarray:
        """Population standard deviations; 1 where a column is constant."""
        if not self.n:
            return np.ones(len(self.mean))
        s = np.sqrt(np.maximum(np.diag(self.products), 0) / self.n)
        return np.where((self.low < self.high) & (s > 0), s, 1.0)

    def correlations(self) -> np.ndarray:
        """Correlations; 0 with a constant column."""
        s = self.deviations()
        varies = (self.low < self.high).astype(float)
        r = self.products / max(self.n, 1) / np.outer(s, s) * np.outer(varies, varies)
        np.fill_diagonal(r, varies)
        return r

    def first_component(self) -> tuple[np.ndarray, float]:
        """Loadings of the standardised columns and the share of variance explained."""
        r = self.correlations()
        values, vectors = np.linalg.eigh(r)
        whole = float(np.trace(r))
        return vectors[:, -1], float(values[-1] / whole) if whole > 0 else 0.0


_STATE = "part int, n long, state binary"


def _row(part: int, m: Moments) -> pa.RecordBatch:
    n, state = m.packed()
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([n]), pa.array([state])], names=["part", "n", "state"])


def comoments(df: DataFrame, cols: Sequence[str]) -> Moments:
    """The merged state of the numeric columns ``cols`` (no NULLs) over all rows."""
    d = len(cols)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, rows = Moments.empty(d), 0
        for batch in batches:
            if batch.num_rows:
                x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[:d]], axis=1)
                state = state.merged(Moments.of(x))
                rows += batch.num_rows
        if rows:
            yield _row(hash(state.packed()[1]) % FAN_IN, state)

    def merge(group: pa.Table) -> pa.Table:
        states = [Moments.unpacked(n, s, d) for n, s in zip(group.column("n").to_pylist(), group.column("state").to_pylist())]
        return pa.Table.from_batches([_row(group.column("part")[0].as_py(), reduce(Moments.merged, states))])

    states = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)]).mapInArrow(fold, _STATE)
    merged = states.groupBy("part").applyInArrow(merge, _STATE).collect()  # FAN_IN rows at most
    return reduce(Moments.merged, [Moments.unpacked(r.n, bytes(r.state), d) for r in merged], Moments.empty(d))
