"""Layouts of written tables: sizes by volume, buckets for joins, clustering for
lookups (R1, K2, K11, J1, C5).

* :func:`rebalanced`: partitions by the size of what they hold, not by how many values
  a column has: a value with much data is dealt to several tasks (and files), small
  ones share a task.
* :class:`Bucketed`: a declared table in buckets of a key, sorted by it. Two of them
  with the same key and number of buckets join without moving a row.
* :func:`write_clustered`: rows in ranges of a key, sorted, with Bloom filters on it,
  so that a lookup of a few keys opens few row groups.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshore.sinks.catalog import _q

#: Bytes of a row group of a clustered table: what a lookup reads at least.
ROW_GROUP = 16 << 20


def rebalanced(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` in partitions of about ``spark.sql.adaptive.advisoryPartitionSizeInBytes``,
    rows of one value of ``columns`` together as far as that allows (adaptive execution
    splits a large value and joins small ones). Without columns only sizes count."""
    return df.hint("rebalance", *columns)


def write_rebalanced(df: DataFrame, path: str, partition_by: str, mode: str = "errorifexists") -> None:
    """Partitioned write with files by volume: one value's files are as many as its
    data needs."""
    rebalanced(df, partition_by).write.mode(mode).partitionBy(partition_by).parquet(path)


@dataclass
class Bucketed:
    """A declared table, ``buckets`` buckets of ``key``, sorted by it."""

    name: str
    path: str
    key: str
    buckets: int = 64
    comment: str = ""
    properties: dict[str, str] = field(default_factory=dict)

    def write(self, df: DataFrame) -> None:
        """Write and declare the table. Rows are dealt to the buckets first, so a bucket
        is one file; adaptive execution cuts one that is far larger than the advisory
        partition size (a hot key) into several files by several tasks. A join without an
        exchange still reads a bucket in one task: for keys too hot for that, read with
        ``spark.sql.sources.bucketing.enabled`` off, and the join may split them."""
        spark = df.sparkSession
        (df.hint("rebalance", self.buckets, self.key).write.mode("overwrite").bucketBy(self.buckets, self.key)
         .sortBy(self.key).option("path", self.path).saveAsTable(self.name))
        if self.comment:
            spark.sql(f"COMMENT ON TABLE {self.name} IS {_q(self.comment)}")
        if self.properties:
            pairs = ", ".join(f"{_q(k)} = {_q(str(v))}" for k, v in self.properties.items())
            spark.sql(f"ALTER TABLE {self.name} SET TBLPROPERTIES ({pairs})")

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name)


def write_clustered(df: DataFrame, path: str, key: str, then: str | None = None, mode: str = "errorifexists",
                    row_group: int = ROW_GROUP) -> None:
    """Ranges of ``key`` (and ``then``), sorted inside, with a Bloom filter on the key
    in every row group. A hot key is cut by ``then``."""
    order = [key] + ([then] if then else [])
    (df.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order).write.mode(mode)
     .option(f"parquet.bloom.filter.enabled#{key}", "true").option("parquet.block.size", str(row_group))
     .parquet(path))


def scanned_rows(df: DataFrame) -> int:
    """Rows that the file scans of ``df`` hand on after skipping row groups and pages;
    runs ``df``."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.executedPlan()
    total, todo = 0, [plan]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("Scan parquet"):
            total += int(node.metrics().apply("numOutputRows").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
        if hasattr(node, "plan") and node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
    return total
