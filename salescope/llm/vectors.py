"""Vector columns as little-endian float64 binaries, checked once."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """(rows, dim) float64 from a binary column of such vectors."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(len(column), dim)


def binary_rows(x: np.ndarray) -> pa.Array:
    bounds = np.arange(len(x) + 1, dtype=np.int32) * (8 * x.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(x), [
        None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(x, dtype="<f8"))])


def checked(vectors: DataFrame, column: str = "embedding", keep: tuple[str, ...] = ("vec_id",)) -> DataFrame:
    """The columns ``keep`` with dim and vec; dim is 0 and vec null where the vector is
    null, empty, zero, or holds a null or non-finite component."""
    rows = vectors.select(*keep, F.col(column).cast("array<double>").alias("embedding"))

    def check(batches):
        for batch in batches:
            lists = batch.column("embedding")
            size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = pc.list_flatten(lists).to_numpy(zero_copy_only=False).astype(np.float64)
            end = np.cumsum(size)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
            some = np.concatenate([[0], np.cumsum(flat != 0)])
            ok = (size > 0) & (bad[end] == bad[end - size]) & (some[end] > some[end - size])
            data = flat.astype("<f8").tobytes()
            vec = [data[8 * (e - s):8 * e] if k else None for k, s, e in zip(ok, size, end)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(np.where(ok, size, 0).astype(np.int32)),
                 pa.array(vec, pa.binary())], names=[*keep, "dim", "vec"])

    schema = rows.select(*keep).schema.add("dim", "integer").add("vec", "binary")
    return rows.mapInArrow(check, schema)
