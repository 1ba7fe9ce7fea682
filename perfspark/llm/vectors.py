"""Arrays behind the vector operators: valid rows and a random rotation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


def usable(df: DataFrame, vec: str = "embedding", uid: str = "vec_id",
           kind: str = "float64") -> DataFrame:
    """``(vec_id, dim, vec)`` of vectors that are not null, empty or zero and hold only finite
    numbers; ``vec`` is their numbers as bytes, doubles or of another ``kind``."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vec")
            size = lists.value_lengths().fill_null(0).to_numpy().astype("int64")
            x = lists.flatten().to_numpy(zero_copy_only=False).astype("float64")
            ends = np.cumsum(size)

            def count(marks: np.ndarray) -> np.ndarray:
                before = np.concatenate([[0], np.cumsum(marks)])
                return before[ends] - before[ends - size]

            ok = (size > 0) & (count(~np.isfinite(x)) == 0) & (count(x != 0) > 0)
            data = x[np.repeat(ok, size)].astype(kind)
            starts = np.concatenate([[0], np.cumsum(size[ok])]) * data.itemsize
            vecs = pa.Array.from_buffers(pa.binary(), int(ok.sum()), [
                None, pa.py_buffer(starts.astype("int32")), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").filter(pa.array(ok)), pa.array(size[ok].astype("int32")),
                 vecs], ["vec_id", "dim", "vec"])

    typed = df.select(F.col(uid).cast("long").alias("vec_id"), F.col(vec).alias("vec"))
    return typed.mapInArrow(rows, "vec_id long, dim int, vec binary")


def matrix(column: pa.ChunkedArray | pa.Array, dim: int, dtype: str = "float64") -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, dim)


def rotate(x: np.ndarray, seed: int = 11, rounds: int = 3) -> np.ndarray:
    """A random rotation of each row, zero-padded to a power of two.

    Rounds of random signs and a Walsh-Hadamard transform: every row is added up in the same
    order whatever its neighbours, so any task gets the same bits."""
    n, dim = x.shape
    width = 1 << max(0, dim - 1).bit_length()
    out = np.zeros((n, width))
    out[:, :dim] = x
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        out *= rng.choice([-1.0, 1.0], width)
        half = 1
        while half < width:
            pairs = out.reshape(n, -1, 2, half)
            low, high = pairs[:, :, 0], pairs[:, :, 1]
            out = np.stack([low + high, low - high], axis=2).reshape(n, width)
            half *= 2
        out /= np.sqrt(width)
    return out
