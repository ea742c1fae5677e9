"""Tables of vectors for the operators on embeddings.

A vector takes part if it is neither null nor holds a null, NaN or infinite
entry.  Vectors shorter than the longest that takes part count as followed by
zeros.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VECTOR = "_nx_vector"


def is_finite(vector: str) -> Column:
    """Whether the vector takes part."""
    column = F.col(f"`{vector}`")
    return column.isNotNull() & F.forall(
        column, lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) < F.lit(float("inf"))))


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """The vectors of an Arrow column as rows of ``width`` doubles."""
    size = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (size == width).all():
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width))
    out[np.arange(width) < size[:, None]] = flat
    return out


def row_chunks(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in batches of exactly ``limit`` rows (the last
    may be shorter)."""
    held, rows = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, limit - rows)
            held, rows, batch = [*held, part], rows + part.num_rows, batch.slice(part.num_rows)
            if rows == limit:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def slot_sums(table: DataFrame, per_task, slots: int, kind: str) -> np.ndarray:
    """``per_task(batches)`` gives an array of ``slots`` numbers for the rows of
    a task; their sum over all tasks.  ``kind``: ``long`` or ``double``."""
    def partial(batches: Iterable[pa.RecordBatch]):
        total = per_task(batches)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["slot", "value"])

    found = (table.mapInArrow(partial, f"slot long, value {kind}").groupBy("slot")
             .agg(F.sum("value").alias("value")).toArrow())  # at most ``slots`` rows
    out = np.zeros(slots, np.int64 if kind == "long" else np.float64)
    out[found["slot"].to_numpy()] = found["value"].to_numpy()
    return out
