"""Equi-joins with an explicit, checked strategy.

``broadcast`` ships the small side to every task and skips the shuffle of the
large side; it is only safe when the small side is bounded. The size is Spark's
own estimate of the planned small side, which costs no job: file sizes for a
scan, and what follows from them for filters and aggregates. Above the bound no hint is given: both sides are then partitioned on the key, and adaptive
execution still turns the join into a broadcast if the small side, once
shuffled, proves small, and splits skewed partitions if not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Estimated bytes up to which a broadcast is hinted: files are compressed, so the
#: rows may take some ten times that in memory, far below an executor's share.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024

STRATEGIES = ("auto", "broadcast", "merge", "shuffle_hash")


def planned_bytes(df: DataFrame) -> int:
    """Spark's size estimate of ``df`` in bytes; plans only, runs no job."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def read_bytes(df: DataFrame) -> int:
    """Bytes that the plan of ``df`` reads: the sizes of its sources, where they are
    known, whatever is estimated above them; plans only, runs no job."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    unknown = int(df.sparkSession.conf.get("spark.sql.defaultSizeInBytes", str((1 << 63) - 1)))
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(n for n in sizes if n < unknown)


def fits_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """True when the plan of ``df`` is estimated at no more than ``max_bytes``."""
    return planned_bytes(df) <= max_bytes


def join(left: DataFrame, right: DataFrame, on, how: str = "inner",
         strategy: str = "auto", max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Join ``left`` with ``right``; ``right`` is the side considered for broadcast.

    * ``auto``: no hint, Spark chooses by sizes, at run time too;
    * ``broadcast``: hint it when the side fits, else as ``auto``;
    * ``merge`` / ``shuffle_hash``: shuffled join via a hint.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}, not {strategy!r}")
    if strategy == "broadcast":
        if how in ("right", "full", "full_outer", "right_outer", "outer"):
            raise ValueError(f"cannot broadcast the right side of a {how} join")
        if fits_broadcast(right, max_broadcast_bytes):
            return left.join(right.hint("broadcast"), on, how)
    if strategy in ("auto", "broadcast"):
        return left.join(right, on, how)
    return left.join(right.hint(strategy), on, how)


def join_strategy(df: DataFrame) -> str:
    """Physical join operator chosen for ``df``: read from ``explain`` text."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    plan = buf.getvalue()
    for name in ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin",
                 "BroadcastNestedLoopJoin", "CartesianProduct"):
        if name in plan:
            return name
    return "none"
