"""Shared by the vector operators: which vectors are kept, their integers, chunks of rows, exact sums.

A component x stands for the integer floor(1024 * x), x as a double. Integers
beyond 2^27 (x beyond 131 072) raise: squared distances would not fit a long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE, LIMIT = 1024.0, 1 << 27


def finite(column: Column) -> Column:
    """Whether a vector is there and every component is a finite number (NaN stands above infinity in Spark)."""
    return F.coalesce(F.forall(column, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf")))), F.lit(False))


def integers(values: np.ndarray) -> np.ndarray:
    out = np.floor(values.astype(np.float64) * SCALE)
    if out.size and np.abs(out).max() > LIMIT:
        raise OverflowError(f"a vector component exceeds {LIMIT / SCALE:.0f}: squared distances would not fit a long")
    return out.astype(np.int64)


def matrix(column: pa.Array) -> np.ndarray:
    """Integers of a list column whose lists have one length and no nulls."""
    flat = integers(column.flatten().to_numpy(zero_copy_only=False))
    return flat.reshape(len(column), -1)


def gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Batches joined to tables of `rows` rows; the last one of a task may be shorter."""
    held, n = [], 0
    for b in batches:
        at = 0
        while at < b.num_rows:
            part = b.slice(at, rows - n)
            held.append(part)
            at += part.num_rows
            n += part.num_rows
            if n == rows:
                yield pa.Table.from_batches(held).combine_chunks()
                held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def narrow(x: np.ndarray) -> np.ndarray:
    """The same integers in the smallest little-endian type that holds them."""
    lo, hi = (int(x.min()), int(x.max())) if x.size else (0, 0)
    for kind in ("<i2", "<i4"):
        if np.iinfo(kind).min <= lo and hi <= np.iinfo(kind).max:
            return x.astype(kind)
    return x.astype("<i8")


def packed(x: np.ndarray) -> bytes:
    """Bytes of an integer array, one for the width of its type before them."""
    x = narrow(x)
    return bytes([x.itemsize]) + x.tobytes()


def unpacked(raw: bytes, columns: int | None = None) -> np.ndarray:
    x = np.frombuffer(raw, f"<i{raw[0]}", offset=1)
    return x if columns is None else x.reshape(-1, columns)


def exact_sum(name: str) -> Column:
    """Sum of longs as a decimal: cannot wrap whatever the number of rows."""
    return F.sum(F.col(name).cast("decimal(38,0)"))
