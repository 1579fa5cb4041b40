"""Partition count helpers.

``repartition(n)`` with ``n`` = distinct values of a column spreads rows round
robin into ``n`` partitions; it does *not* put one value per partition. Passing
the column hash-partitions by it instead, so each value's rows land together
and a following ``partitionBy`` write makes one file per value and task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def distinct_values(df: DataFrame, column: str) -> int:
    """Distinct values of ``column``, null counted as a value (A3)."""
    return df.select(column).distinct().count()


def repartition_by_distinct(df: DataFrame, column: str, by_column: bool = False) -> DataFrame:
    """``df`` in as many partitions as ``column`` has distinct values."""
    n = max(1, distinct_values(df, column))
    return df.repartition(n, column) if by_column else df.repartition(n)


def num_partitions(df: DataFrame) -> int:
    """Partitions of the result (R2). Adaptive execution decides them while it
    runs, so this runs the shuffles of ``df``; a plain scan runs nothing."""
    return df.rdd.getNumPartitions()
