"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..checkpoints import ensure_checkpoint_dir, settled

__all__ = ["SLICE", "Memo", "ensure_checkpoint_dir", "hash_sample", "keys", "mixed", "raw", "settled", "slices", "unused"]

#: Rows of a batch that are turned into Python objects at a time.
SLICE = 512
#: Bytes of strings that are, unless a single row holds more.
SLICE_BYTES = 8 << 20


def hash_sample(df: DataFrame, most: int, *columns: Column) -> DataFrame:
    """Rows of ``df`` with the least hashes of ``columns``: all if they are at most ``most``, else about that many.

    The bound is a threshold on a uniform 64-bit hash (the expected number is
    ``most``), so nothing is sorted and the same rows are taken however the
    table is partitioned.
    """
    n = df.count()
    if n <= most:
        return df
    return df.where(F.xxhash64(*columns) <= F.lit(int((1 << 64) * most / n) - (1 << 63)))


def raw(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; a null is an empty text."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches of at most ``rows`` rows and ``size`` bytes of strings (or one row), so that few long texts are held at a time."""
    for batch in batches:
        ends = np.zeros(batch.num_rows + 1, np.int64)
        for column in batch.columns:
            if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
                ends[1:] += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(ends)
        at = 0
        while at < batch.num_rows:
            stop = int(np.searchsorted(ends, ends[at] + size, side="right")) - 1
            stop = max(at + 1, min(stop, at + rows))
            yield batch.slice(at, stop - at)
            at = stop


def mixed(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads 64-bit values (uint64 in, uint64 out)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Memo(dict):
    """A dictionary that computes missing values. It holds at most ``most`` keys in two halves; when the newer is full, the older goes."""

    def __init__(self, compute: Callable, most: int = 200_000):
        super().__init__()
        self.compute, self.half, self.older = compute, max(1, most // 2), {}

    def __missing__(self, key):
        if len(self) >= self.half:
            self.older = dict(self)
            self.clear()
        value = self.older[key] if key in self.older else self.compute(key)
        self[key] = value
        return value


def keys(*columns: Column) -> list[Column]:
    """128 bits, as columns k1 and k2, that stand for the values of a row; equal values have equal keys.

    Operators whose verdict depends on these values alone join on the keys, so
    repeated rows, repeated ids and null ids need no special case.
    """
    return [F.xxhash64(*columns).alias("k1"), F.xxhash64(F.lit("second"), *columns).alias("k2")]


def unused(df: DataFrame, count: int) -> list[str]:
    """Names that no column of ``df`` has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    return [n for n in (f"__{k}" for k in range(len(taken) + count)) if n not in taken][:count]
