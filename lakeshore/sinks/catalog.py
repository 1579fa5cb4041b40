"""Catalog side of datasets: schemas, declared tables over a location, views,
drops (K6, K7, K8, K10, K11).

A *dataset declaration* names a table, says where its files live, and carries
a comment and properties (such as ``quality = silver``), as pipeline table
declarations do. The table is external (``USING parquet LOCATION``), so
dropping it never deletes data files, and a writer that replaces the files
keeps the declaration valid.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from lakeshore.sinks import versioned


def _q(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    loc = f" LOCATION {_q(location)}" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{loc}")


def drop_schema(spark: SparkSession, name: str, cascade: bool = False) -> None:
    """Drop a schema; without ``cascade`` a schema still holding tables is
    refused (the reference drops a database before its table)."""
    spark.sql(f"DROP SCHEMA IF EXISTS {name}{' CASCADE' if cascade else ''}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def drop_view(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP VIEW IF EXISTS {name}")


def drop_function(spark: SparkSession, name: str, temporary: bool = False) -> None:
    spark.sql(f"DROP {'TEMPORARY ' if temporary else ''}FUNCTION IF EXISTS {name}")


@dataclass
class Dataset:
    """Declaration of a pipeline dataset."""

    name: str
    path: str
    comment: str = ""
    properties: dict[str, str] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()

    def register(self, spark: SparkSession, df: DataFrame | None = None) -> None:
        """Create the external table over ``path`` if absent (K6). The schema
        comes from the files there, or from ``df`` when none exist yet."""
        props = ", ".join(f"{_q(k)} = {_q(str(v))}" for k, v in self.properties.items())
        schema = ""
        if df is not None:
            schema = "(" + ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                                     for f in df.schema.fields) + ")"
        # Without a column list Spark infers the columns, partition columns
        # included, from the files; PARTITIONED BY needs the list.
        parts = (f" PARTITIONED BY ({', '.join(self.partition_by)})"
                 if self.partition_by and schema else "")
        sql = (f"CREATE TABLE IF NOT EXISTS {self.name} {schema} USING parquet{parts} "
               f"LOCATION {_q(self.path)}")
        if self.comment:
            sql += f" COMMENT {_q(self.comment)}"
        if props:
            sql += f" TBLPROPERTIES ({props})"
        spark.sql(sql)
        if self.partition_by:
            spark.sql(f"MSCK REPAIR TABLE {self.name}")  # pick up new partition folders

    def write(self, df: DataFrame, mode: str = "append") -> None:
        """Write ``df`` to the dataset's location and make sure it is declared.

        An overwrite is written beside the location and then takes its place, so
        ``df`` may read the dataset itself: the old files stay until the new ones
        are complete. (On a store without renames, use a versioned table.)"""
        spark = df.sparkSession
        replace = mode == "overwrite"
        target = f"{self.path.rstrip('/')}__new-{uuid.uuid4().hex[:8]}" if replace else self.path
        w = df.write.mode("errorifexists" if replace else mode)
        if self.partition_by:
            w = w.partitionBy(*self.partition_by)
        w.parquet(target)
        if replace:
            self._swap(spark, target)
        self.register(spark)
        spark.catalog.refreshTable(self.name)

    def _swap(self, spark: SparkSession, fresh: str) -> None:
        """Put the folder ``fresh`` in the dataset's place; a step that fails leaves
        the old or the new folder complete."""
        fs, new = versioned._fs(spark, fresh)
        _, here = versioned._fs(spark, self.path)
        _, old = versioned._fs(spark, f"{fresh}.old")
        had = fs.exists(here)
        if had and not fs.rename(here, old):
            raise OSError(f"cannot move {self.path} aside")
        if not fs.rename(new, here):
            if had:
                fs.rename(old, here)
            raise OSError(f"cannot move {fresh} to {self.path}")
        if had:
            fs.delete(old, True)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name)


def table_properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
