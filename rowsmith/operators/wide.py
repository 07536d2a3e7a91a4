"""Leading principal components of wide vectors, without a matrix of columns x columns anywhere.

The leading directions are searched in a growing space of blocks: a pass over the rows multiplies a thin block of
directions (d x ``width``) with the covariance, task by task, and what is new in the result is the next block. The space is started with
random directions and so is a block Krylov space. The driver holds the directions found and their images, d x (width x
passes) each. How far a component is from an exact one is known without another pass: it is the length of
what the covariance does to it beyond scaling, ``residual``.

Defined cases. Rows without a vector, or with a null or NaN in it, are left out; vectors of different lengths are an error. With
fewer than two rows there is nothing to decompose: an error. A constant dimension has loading 0.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rowsmith.functions.blocks import array_rows, complete_vectors, fold_blocks

# Directions new to the space shorter than this share of the largest image are rounding.
NEW = 1e-10
# Lines of a block travel in groups of this many numbers.
LINE_NUMBERS = 16_384


@dataclass(frozen=True)
class WideComponents:
    """``loadings`` d x k, the variance along each (``values``), its share of all (``ratios``), how far each is from exact
    (``residuals``, in units of the largest value), ``scale`` of each dimension, and the passes over the rows."""

    loadings: np.ndarray
    values: np.ndarray
    ratios: np.ndarray
    residuals: np.ndarray
    scale: np.ndarray
    passes: int


def vector_moments(df: DataFrame, vector: str) -> tuple[float, np.ndarray, np.ndarray]:
    """Rows, mean and sample variance of every dimension, in one pass."""

    def merge(a, b):
        n = a[0] + b[0]
        gap = b[1] - a[1]
        return n, a[1] + gap * (b[0] / n), a[2] + b[2] + gap * gap * (a[0] * b[0] / n)

    def gather(batches: Iterator[pa.RecordBatch]):
        total = None
        for batch in batches:
            x = array_rows(batch)
            if len(x):
                z = x - x[0]
                middle = z.mean(axis=0)
                here = (np.full(1, float(len(x))), x[0] + middle, ((z - middle) ** 2).sum(axis=0))
                if total is not None and len(total[1]) != len(here[1]):
                    raise ValueError(f"vectors of different lengths: {len(total[1])} and {len(here[1])}")
                total = here if total is None else merge(total, here)
        return {} if total is None else {0: total}

    lines = fold_blocks(complete_vectors(df, vector), gather, merge, ("n", "mean", "squares"))
    n, mean, squares = lines.get(0, (np.zeros(1), np.zeros(0), np.zeros(0)))
    return float(n[0]), mean, squares / max(float(n[0]) - 1, 1.0)


def _image(rows: DataFrame, block: np.ndarray, mean: np.ndarray, scale: np.ndarray, n: float) -> np.ndarray:
    """Covariance (of the scaled dimensions) times a thin block, in one pass."""
    d, width = block.shape
    step = max(1, LINE_NUMBERS // width)

    def gather(batches: Iterator[pa.RecordBatch]):
        total = np.zeros((d, width))
        for batch in batches:
            x = array_rows(batch)
            if len(x):
                z = (x - mean) / scale
                total += z.T @ (z @ block)
        return {i: (total[i * step : (i + 1) * step].ravel(),) for i in range(-(-d // step))}

    lines = fold_blocks(rows, gather, lambda a, b: (a[0] + b[0],), ("sums",))
    return np.concatenate([lines[i][0] for i in sorted(lines)]).reshape(d, width) / (n - 1)


def fit_wide(
    df: DataFrame,
    vector: str,
    k: int,
    standardize: bool = False,
    width: int | None = None,
    tolerance: float = 1e-6,
    max_passes: int = 40,
    seed: int = 42,
) -> WideComponents:
    """The k leading components of an array column; of the correlation if standardised.

    ``width`` directions (default k + 10) are added in each pass, until every residual is at most ``tolerance`` or the
    space is exhausted; a search that ends at ``max_passes`` warns, and its residuals say how far it came.
    """
    n, mean, variance = vector_moments(df, vector)
    if n < 2:
        raise ValueError("components need at least two complete vectors")
    d = len(mean)
    k = min(k, d)
    scale = np.where(variance > 0, np.sqrt(variance), 1.0) if standardize else np.ones(d)
    total = float((variance / scale**2).sum())
    rows = complete_vectors(df, vector)
    start = np.random.default_rng(seed).normal(size=(d, min(d, width or k + 10)))
    block, _ = np.linalg.qr(start)
    basis, images = np.empty((d, 0)), np.empty((d, 0))
    for passes in range(1, max_passes + 1):
        image = _image(rows, block, mean, scale, n)
        basis, images = np.hstack([basis, block]), np.hstack([images, image])
        small = basis.T @ images
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1][:k], turn[:, ::-1][:, :k]
        loadings = basis @ turn
        largest = max(float(values[0]), np.finfo(float).tiny)
        residuals = np.linalg.norm(images @ turn - loadings * values, axis=0) / largest
        if len(values) == k and (residuals <= tolerance).all():
            break
        fresh = image
        for _ in range(2):
            fresh = fresh - basis @ (basis.T @ fresh)
        left, sizes, _ = np.linalg.svd(fresh, full_matrices=False)
        block = left[:, sizes > NEW * largest][:, : d - basis.shape[1]]
        if not block.shape[1]:
            # What the start did not touch: random directions beside the space, as long as it has fewer than k.
            if basis.shape[1] >= k:
                break
            more = np.random.default_rng(seed + passes).normal(size=(d, k - basis.shape[1]))
            for _ in range(2):
                more = more - basis @ (basis.T @ more)
            block, _ = np.linalg.qr(more)
    else:
        warnings.warn(f"components after {max_passes} passes are not within {tolerance}: {residuals.max():.2g}", stacklevel=2)
    top = loadings[np.abs(loadings).argmax(axis=0), np.arange(loadings.shape[1])]
    loadings = loadings * np.where(top < 0, -1.0, 1.0)
    values = np.maximum(values, 0.0)
    return WideComponents(loadings, values, values / total if total > 0 else values, residuals, scale, passes)


def wide_components(df: DataFrame, vector: str, k: int, standardize: bool = False, **search) -> DataFrame:
    """Rows (component, eigenvalue, ratio, residual, loadings): an array with one loading per dimension."""
    fit = fit_wide(df, vector, k, standardize, **search)
    rows = [
        (j + 1, float(fit.values[j]), float(fit.ratios[j]), float(fit.residuals[j]), fit.loadings[:, j].tolist())
        for j in range(len(fit.values))
    ]
    return df.sparkSession.createDataFrame(
        rows, "component int, eigenvalue double, ratio double, residual double, loadings array<double>"
    )


def wide_scores(vector: Column, fit: WideComponents) -> Column:
    """Array of the projections of a vector as it is (not centred); null for a null vector."""
    turn = fit.loadings / fit.scale[:, None]

    @F.pandas_udf("array<double>")
    def of(vectors: pd.Series) -> pd.Series:
        return pd.Series([None if v is None else np.asarray(v, dtype=float) @ turn for v in vectors], dtype=object)

    return of(vector)


def wide_project(df: DataFrame, vector: str, k: int, standardize: bool = False, name: str = "scores", **search) -> DataFrame:
    """Add the projections on the k leading components as an array column."""
    return df.withColumn(name, wide_scores(F.col(vector), fit_wide(df, vector, k, standardize, **search)))
