"""Bitmaps of hashes with a fixed size: filters without false negatives for Python workers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 26


def bitmap(codes: DataFrame, code: str, bits: int = BITS) -> np.ndarray:
    """One bit for each cell, the highest ``bits`` of a 64-bit code; 2^(bits - 3) bytes in all.

    Spark fills the pages, of 4 KB each; the driver receives pages, not codes.
    """
    cell = F.shiftrightunsigned(code, 64 - bits)
    page_bits = 15
    pages = codes.select(cell.alias("cell")).groupBy(
        F.shiftright("cell", page_bits).alias("page")).agg(
        F.bitmap_construct_agg(F.col("cell") % (1 << page_bits)).alias("filled"))
    held = np.zeros(1 << (bits - 3), dtype=np.uint8)
    size = 1 << (page_bits - 3)
    for row in pages.toLocalIterator():
        held[row["page"] * size:(row["page"] + 1) * size] = np.frombuffer(row["filled"], np.uint8)
    return held


def holds(held: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Whether the cell of each code is filled."""
    cells = (codes >> np.uint64(64 - (len(held).bit_length() + 2))).astype(np.int64)
    return (held[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1 == 1
