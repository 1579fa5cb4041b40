"""Mergeable distinct counts (A3): HyperLogLog sketches that are stored and added to.

A sketch per group is built map-side, is a few kilobytes whatever it has seen, and
merges with others: appended rows cost their own pass, and a total is a union of
stored sketches. No distinct exchange takes place. Null counts as a value, as in the
exact form (``partitioning.distinct_values``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: log2 of the registers of a sketch, and the relative standard error they give.
LG_K = 12
ERROR = 1.04 / (1 << LG_K) ** 0.5


def _text(column: str) -> Column:
    """One text for every value: null gets one that no value has."""
    value = F.col(column).cast("string")
    return F.when(value.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), value))


def distinct_sketches(df: DataFrame, column: str, by: str | Sequence[str] = ()) -> DataFrame:
    """(by..., sketch): a sketch of ``column``'s values for each group."""
    by = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*by).agg(F.hll_sketch_agg(_text(column), LG_K).alias("sketch"))


def append_sketches(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Stored sketches with those of appended rows."""
    by = [c for c in stored.columns if c != "sketch"]
    return stored.unionByName(fresh).groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"))


def distinct_estimate(sketches: DataFrame, by: str | Sequence[str] = ()) -> DataFrame:
    """(by..., n_distinct) from sketches, over all groups that share ``by``."""
    by = [by] if isinstance(by, str) else list(by)
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"))
