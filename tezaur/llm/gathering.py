"""Arrays of fixed size gathered from all rows of a table."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

BLOCKS = 64


def _packed(x: np.ndarray) -> bytes:
    return zlib.compress(x.tobytes(), 1)


def gathered(df: DataFrame, size: int, dtype: str, fill: Callable[[np.ndarray, pd.DataFrame], None], merge: np.ufunc) -> np.ndarray:
    """One array of ``size`` (a multiple of BLOCKS) from all rows: each partition fills its own, blocks of them are merged in two levels.
    What comes to the driver has that size at any number of rows."""
    width = size // BLOCKS

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, some = np.zeros(size, dtype), False
        for pdf in batches:
            if len(pdf):
                some = True
                fill(own, pdf)
        part = TaskContext.get().partitionId() % 32
        if some:
            yield pd.DataFrame([(k, part, _packed(own[k * width : (k + 1) * width])) for k in range(BLOCKS)], columns=["block", "part", "raw"])

    def together(pdf: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros(width, dtype)
        for raw in pdf["raw"]:
            merge(out, np.frombuffer(zlib.decompress(raw), dtype), out=out)
        return pd.DataFrame([(int(pdf["block"].iloc[0]), 0, _packed(out))], columns=["block", "part", "raw"])

    schema = "block int, part int, raw binary"
    one = df.mapInPandas(build, schema).groupBy("block", "part").applyInPandas(together, schema).groupBy("block").applyInPandas(together, schema)
    out = np.zeros(size, dtype)
    for r in one.toLocalIterator():
        out[r.block * width : (r.block + 1) * width] = np.frombuffer(zlib.decompress(r.raw), dtype)
    return out


def bits_for(rows: int, per_row: int, most: int) -> int:
    """Bits of a bitmap: a power of two from 2^16 up to ``most``, ``per_row`` for each row where that suffices."""
    bits = 1 << 16
    while bits < min(rows * per_row, most):
        bits *= 2
    return bits


def _places(bitmap: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two bits of each 64-bit hash."""
    mask = np.uint64(len(bitmap) * 8 - 1)
    with np.errstate(over="ignore"):
        return hashes & mask, ((hashes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(29)) & mask


def mark(bitmap: np.ndarray, hashes: np.ndarray) -> None:
    for x in _places(bitmap, hashes):
        np.bitwise_or.at(bitmap, x >> np.uint64(3), np.uint8(1) << (x & np.uint64(7)).astype(np.uint8))


def marked(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may have been marked; true for every one that was."""
    one, two = ((bitmap[x >> np.uint64(3)] >> (x & np.uint64(7)).astype(np.uint8)) & 1 for x in _places(bitmap, hashes))
    return (one & two) == 1
