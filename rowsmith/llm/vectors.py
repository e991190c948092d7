"""Integer vectors of a table, packed in blocks of rows so that tasks work on matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Vectors in one block.
BLOCK = 4096
#: Largest integer component: 64 squared differences of such still sum up within a long.
LARGEST = 1 << 27


def whole(vector: Column, dims: int) -> Column:
    """True for a vector of ``dims`` components, none of them null or not finite; false for a null vector."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) == dims) & fine, F.lit(False))


def whole_vectors(rows: DataFrame, id_col: str, vec_col: str, dims: int, label_col: str | None = None) -> DataFrame:
    """id (long), vector (array<double>) and, where asked for, label of the rows with a whole vector."""
    vector = F.col(vec_col).cast("array<double>")
    own = [F.col(id_col).cast("long").alias("id"), vector.alias("vector")]
    if label_col is not None:
        own.append(F.col(label_col).alias("label"))
    return rows.select(*own).where(whole(F.col("vector"), dims))


def integers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as int64; an error where a squared distance could not be a long."""
    out = np.floor(values.astype(np.float64) * scale)
    if out.size and np.abs(out).max() > LARGEST:
        raise ValueError(f"a component beyond {LARGEST / scale:g} in size: squared distances would not fit a long")
    return out.astype(np.int64)


def blocks_of(batches: Iterator[pa.RecordBatch], dims: int, scale: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The rows of a task in blocks of at most ``BLOCK``: the block's rows and its (n, dims) integers."""
    held, count = [], 0

    def cut(rows: list[pa.RecordBatch]) -> tuple[pa.RecordBatch, np.ndarray]:
        block = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
        values = block.column(1).flatten().to_numpy(zero_copy_only=False)
        return block, integers(values, scale).reshape(-1, dims)

    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, BLOCK - count)
            at += part.num_rows
            count += part.num_rows
            held.append(part)
            if count == BLOCK:
                yield cut(held)
                held, count = [], 0
    if held:
        yield cut(held)


def as_list(values: pa.Array) -> pa.Array:
    """A whole array as the one value of a list column."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def floor_means(sums: np.ndarray, counts: np.ndarray, before: np.ndarray) -> np.ndarray:
    """floor(sum / count) by component (floors go down); where the count is 0, what was there before."""
    counts = counts[..., None]
    return np.where(counts > 0, sums // np.maximum(counts, 1), before)


def exact_sum(column: str) -> Column:
    """The exact sum of longs, whatever its size."""
    return F.sum(F.col(column).cast("decimal(38,0)"))
