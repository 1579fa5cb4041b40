"""Written intermediate tables: lineage ends in the folder all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lakeshore.session import scratch_path


def written(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back: a
    lost executor costs one task of the reader, not the work above."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def blocks(df: DataFrame) -> int:
    """Number of blocks that block-wise operators cut their key space into: the
    session's shuffle partitions, at least one a scan split, so that a block's
    share of the input stays that of a split whatever its size."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), splits(df))


#: Bytes of a scan split.
SPLIT = 16 << 20


def splits(df: DataFrame) -> int:
    """Scan splits of ``df`` by the size of what its plan reads (files have theirs on
    record; estimates of joins above them do not count); runs no job. A source that
    knows no size counts its partitions."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    unknown = int(df.sparkSession.conf.get("spark.sql.defaultSizeInBytes", str((1 << 63) - 1)))
    total = 0
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        size = int(str(leaf.stats().sizeInBytes()))
        if size < unknown:
            total += -(-size // SPLIT)
        elif leaf.nodeName().startswith("Scan ExistingRDD"):
            total += int(leaf.rdd().getNumPartitions())
    return max(1, total)
