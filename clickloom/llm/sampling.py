"""Bounded samples to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null ids are in no fold."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def about(rows: DataFrame, n: int, *key: Column) -> DataFrame:
    """``rows`` if there are at most ``n``, else the share of them that makes about ``n``.

    Rows are chosen by a hash of ``key``, so the choice is the same in every run.
    """
    total = rows.count()
    if total <= n:
        return rows
    cells = 1 << 30
    return rows.where(F.pmod(F.xxhash64(*key, F.lit(17)), F.lit(cells)) < int(cells * n / total))
