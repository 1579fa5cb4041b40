"""Table sources: the parquet tables of a data directory, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """Scan one parquet table; filters and projections on the result reach the scan."""
    return spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, data_dir: str, names=TABLES) -> None:
    """Expose the tables as temp views for SQL (K9)."""
    for name in names:
        table(spark, data_dir, name).createOrReplaceTempView(name)
