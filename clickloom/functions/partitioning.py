"""Partitioning of the small sides of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame

_MANY = 1 << 20


def forget_partitioning(df: DataFrame) -> DataFrame:
    """The same rows in the same partitions, of which the planner no longer knows the keys.

    AQE splits the oversized partitions of a join only if both of its sides were shuffled for it. A
    side that comes straight from an aggregate on the join key would be joined as it is, and a key
    with a large share of the other side's rows would be left to one task. Shuffling the small
    side once more is what the split costs.
    """
    return df.coalesce(_MANY)
