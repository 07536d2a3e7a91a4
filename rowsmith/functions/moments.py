"""Counts, means and centred cross products of pairs of columns, in one pass and mergeable.

For columns i and j over the rows in which both have a value: n, the means of i (x) and of j (y), the sum of squares of i around its
mean (xx) and the sum of products (xy). Every batch is centred before anything is multiplied, and blocks are merged by the
differences of their means, so large means cost no digits. A null or NaN is a missing value. An infinite value makes
its column's entries NaN. The precision of a pair is relative to a column's spread in a whole batch.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rowsmith.functions.blocks import fold_blocks

NAMES = ("n", "x", "y", "xx", "xy")
# A column whose squares in a pair are below this share of all its squares is constant there, up to rounding.
CONSTANT = 1e-14

Parts = tuple[np.ndarray, ...]


def block_moments(x: np.ndarray) -> Parts:
    """The five d x d matrices of one block of rows; NaN is missing."""
    with np.errstate(invalid="ignore", over="ignore"):
        there = ~np.isnan(x)
        seen = there.astype(float)
        # A value of the column first, so that a constant column is exactly zero; then the mean of what is left.
        origin = np.nan_to_num(x[there.argmax(axis=0), np.arange(x.shape[1])], posinf=0.0, neginf=0.0)
        z = np.where(there, x - origin, 0.0)
        middle = z.sum(axis=0) / np.maximum(seen.sum(axis=0), 1)
        z = np.where(there, z - middle, 0.0)
        n = seen.T @ seen
        local = (z.T @ seen) / np.maximum(n, 1)
        xx = (z * z).T @ seen - n * local * local
        xy = z.T @ z - n * local * local.T
        mean = np.where(n > 0, (origin + middle)[:, None] + local, 0.0)
    return n, mean, mean.T, np.maximum(xx, 0.0), xy


def merge_moments(a: Parts, b: Parts) -> Parts:
    with np.errstate(invalid="ignore", over="ignore"):
        n = a[0] + b[0]
        share = b[0] / np.maximum(n, 1)
        dx, dy = b[1] - a[1], b[2] - a[2]
        weight = a[0] * share
        # A side without rows has means of zero, which must not count.
        x, y = (np.where(a[0] > 0, a[i] + d * share, b[i]) for i, d in ((1, dx), (2, dy)))
        return n, x, y, a[3] + b[3] + dx * dx * weight, a[4] + b[4] + dx * dy * weight


@dataclass(frozen=True)
class CoMoments:
    """``n``, ``mean`` (of the row's column), ``squares`` and ``products``: d x d each."""

    cols: tuple[str, ...]
    n: np.ndarray
    mean: np.ndarray
    squares: np.ndarray
    products: np.ndarray

    def covariance(self) -> np.ndarray:
        """Sample covariances; NaN with fewer than two rows."""
        return np.where(self.n > 1, self.products / np.maximum(self.n - 1, 1), np.nan)

    def correlation(self) -> np.ndarray:
        """Pearson's coefficients: 1 on the diagonal, NaN where a column is constant or has fewer than two rows."""
        whole = np.diag(self.squares)[:, None]
        squares = np.where(self.squares <= CONSTANT * whole, 0.0, self.squares)
        spread = np.sqrt(squares) * np.sqrt(squares.T)
        found = np.where(spread > 0, self.products / np.where(spread > 0, spread, 1.0), np.nan)
        found = np.clip((found + found.T) / 2, -1.0, 1.0)
        np.fill_diagonal(found, 1.0)
        return found


def co_moments(df: DataFrame, cols: Sequence[str]) -> CoMoments:
    """Moments of all pairs of columns, each pair over the rows in which both have a value."""
    cols, d = tuple(cols), len(cols)
    names = [f"c{i}" for i in range(d)]
    rows = df.select(*[F.col(c).cast("double").alias(n) for c, n in zip(cols, names)])

    def gather(batches: Iterator[pa.RecordBatch]) -> dict[int, Parts]:
        total: Parts | None = None
        for batch in batches:
            if batch.num_rows:
                here = block_moments(np.column_stack([batch.column(n).to_numpy(zero_copy_only=False) for n in names]))
                total = here if total is None else merge_moments(total, here)
        return {} if total is None else {i: tuple(part[i] for part in total) for i in range(d)}

    lines = fold_blocks(rows, gather, merge_moments, NAMES)
    none = tuple(np.zeros(d) for _ in NAMES)
    n, x, _, xx, xy = (np.array([lines.get(i, none)[p] for i in range(d)]).reshape(d, d) for p in range(len(NAMES)))
    return CoMoments(cols, n, x, xx, xy)
