"""Sums over tasks of arrays of fixed size, such as gradients."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

PART = "block int, salt int, sums binary"
SALTS = 32
BLOCK_VALUES = 1 << 15


def part(values: np.ndarray) -> pa.RecordBatch:
    """One task's array, cut into blocks."""
    flat = values.astype(np.float32).ravel()
    cuts = range(0, len(flat), BLOCK_VALUES)
    salt = TaskContext.get().partitionId() % SALTS
    return pa.RecordBatch.from_arrays([
        pa.array(range(len(cuts)), pa.int32()), pa.array([salt] * len(cuts), pa.int32()),
        pa.array([flat[s:s + BLOCK_VALUES].tobytes() for s in cuts], pa.binary()),
    ], ["block", "salt", "sums"])


def _total(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = None
    for batch in batches:
        for value in batch.column("sums"):
            got = np.frombuffer(value.as_buffer(), np.float32).astype(np.float64)
            out = got if out is None else out + got
    values = [pa.array([key[0].as_py()], pa.int32()), pa.array([0], pa.int32()), pa.array([out.astype(np.float32).tobytes()], pa.binary())]
    yield pa.RecordBatch.from_arrays(values, ["block", "salt", "sums"])


def total(parts: DataFrame, size: int) -> np.ndarray:
    """The sum of all parts. Salted groups add up first; the driver gets `size` values, however many tasks there are."""
    once = parts.groupBy("block", "salt").applyInArrow(_total, PART)
    out = np.zeros(size)
    for row in once.groupBy("block").applyInArrow(_total, PART).collect():
        got = np.frombuffer(row.sums, np.float32)
        out[row.block * BLOCK_VALUES:row.block * BLOCK_VALUES + len(got)] = got
    return out
