"""Aggregates whose state is a block of numbers: every task folds its rows into one block, blocks are folded in a tree.

A block travels as rows, one per line of a matrix, so that no row grows with the square of the columns. Folding is done in two levels:
blocks are shuffled by partition, the tasks behind the shuffle (whose number Spark adapts to their size) read them one after the
other, and one task reads theirs. Whatever the number of rows
or partitions, a task holds one block, whose size depends on the columns only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

Gather = Callable[[Iterator[pa.RecordBatch]], dict[int, tuple[np.ndarray, ...]]]
Merge = Callable[[tuple[np.ndarray, ...], tuple[np.ndarray, ...]], tuple[np.ndarray, ...]]


def _batch(part: int, lines: dict[int, tuple[np.ndarray, ...]], names: Sequence[str]) -> Iterator[pa.RecordBatch]:
    for line, values in lines.items():
        cells = [pa.array([v.tolist()], pa.list_(pa.float64())) for v in values]
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([line], pa.int32()), *cells], ["part", "line", *names])


def fold_blocks(df: DataFrame, gather: Gather, merge: Merge, names: Sequence[str]) -> dict[int, tuple[np.ndarray, ...]]:
    """The block of all rows: line number -> one array per name.

    ``gather`` folds the batches of a task into lines; ``merge`` folds two values of one line, in any order. Only the last block,
    whose size does not depend on the rows, reaches the driver.
    """
    schema = ", ".join(["part int", "line int", *[f"{n} array<double>" for n in names]])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batch(TaskContext.get().partitionId(), gather(batches), names)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines: dict[int, tuple[np.ndarray, ...]] = {}
        for batch in batches:
            cells = [batch.column(n) for n in names]
            for row, line in enumerate(batch.column("line").to_pylist()):
                here = tuple(c[row].values.to_numpy(zero_copy_only=False) for c in cells)
                lines[line] = merge(lines[line], here) if line in lines else here
        yield from _batch(0, lines, names)

    some = df.mapInArrow(first, schema).repartition("part").mapInArrow(fold, schema)
    rows = some.repartition(1).mapInArrow(fold, schema).drop("part").collect()
    return {r["line"]: tuple(np.asarray(r[n], dtype=float) for n in names) for r in rows}


def array_rows(batch: pa.RecordBatch, name: str = "v") -> np.ndarray:
    """A list column without nulls as a matrix; all lists must have one length."""
    column = batch.column(name)
    lengths = np.diff(column.offsets.to_numpy())
    if len(lengths) and (lengths != lengths[0]).any():
        raise ValueError(f"vectors of different lengths: {lengths.min()} and {lengths.max()}")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(lengths), -1) if len(lengths) else np.empty((0, 0))


def complete_vectors(df: DataFrame, vector: str) -> DataFrame:
    """The vectors as ``v``, an array of doubles, without rows that lack one or hold a null or NaN."""
    rows = df.select(F.col(vector).cast("array<double>").alias("v"))
    return rows.filter(F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull() | F.isnan(x)))
