"""Arrays of numbers added up over all rows, by key: the one distributed step of iterative fits.

Each task adds up the arrays of its own rows and passes one on per key; the parts of a key are added up one after the
other where its hash puts them. What comes to the driver is one array per key, whose number and sizes are those of the
models that are fitted, not of the data.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

Arrays = Iterator[tuple[int, np.ndarray]]


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """A list column whose lists all have ``width`` numbers as a matrix with a row per list."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)


def keyed_sums(rows: DataFrame, arrays: Callable[[pa.RecordBatch], Arrays]) -> dict[int, np.ndarray]:
    """The sums by key of the (key, array) pairs that ``arrays`` gives for each batch of rows."""
    def batch(total: dict[int, np.ndarray]) -> pa.RecordBatch:
        values = pa.array([v.ravel() for v in total.values()], pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), values], names=["key", "v"])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for key, v in arrays(b):
                total[key] = total[key] + v if key in total else v
        yield batch(total)

    def merge(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for key, v in zip(b.column(0).to_pylist(), b.column(1)):
                v = v.values.to_numpy()
                total[key] = total[key] + v if key in total else v
        yield batch(total)

    schema = "key int, v array<double>"
    summed = rows.mapInArrow(add, schema).repartition("key").mapInArrow(merge, schema).toArrow()
    return {key: np.array(v) for key, v in zip(*[c.to_pylist() for c in summed.columns])}
