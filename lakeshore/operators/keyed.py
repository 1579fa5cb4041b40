"""Keyed tables kept up by differences: silver history and gold rows that cost what
has changed (T5, C2, C4).

A keyed history has three parquet tables under its root, all partitioned by a bucket
of the key: ``changes`` (one row per key and sequence, deletes included), ``history``
(SCD 2) and ``current`` (gold, the open versions). A run finds the buckets of its keys,
reads only those of ``changes``, and rewrites only those of the three tables, by a
dynamic partition overwrite; buckets left without rows are removed. Applying a batch
twice changes nothing, so a run that failed half-way is run again.

A batch with new columns adds them; older rows have null there.

The number of buckets is fixed when the table is made: about the table's size over
128 MB, so that a bucket is a file or a few. A key with more rows than a task takes is
split inside the SCD 2 operator, not by buckets.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeshore.operators import cdc
from lakeshore.sinks import overwrite, versioned

BUCKET = "__bucket"
_SCHEMA = "_schema.json"
#: Buckets reach the driver as a set: at most so many.
MOST_BUCKETS = 100_000


class KeyedHistory:
    """SCD 2 history and current rows of a change feed, by key bucket."""

    def __init__(self, root: str, keys, sequence_by, apply_as_deletes=None, except_columns: Sequence[str] = (),
                 buckets: int = 64):
        if not 0 < buckets <= MOST_BUCKETS:
            raise ValueError(f"buckets must be 1 to {MOST_BUCKETS}, not {buckets}")
        self.root, self.buckets = root.rstrip("/"), buckets
        self.keys, self.seq = cdc._names(keys), cdc._names(sequence_by)
        self.apply_as_deletes, self.except_columns = apply_as_deletes, tuple(except_columns)

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _fixed(self, spark: SparkSession) -> None:
        """The number of buckets stays that of the first run."""
        at = f"{self.root}/_buckets.json"
        text = versioned._read_text(spark, at)
        if text is None:
            versioned._write_text(spark, at, json.dumps(self.buckets))
        else:
            self.buckets = int(json.loads(text))

    def _there(self, spark: SparkSession, table: str) -> bool:
        """Does the table hold a bucket? (One whose rows have all gone does not.)"""
        fs, p = versioned._fs(spark, self.path(table))
        return fs.exists(p) and any(st.getPath().getName().startswith(BUCKET + "=") for st in fs.listStatus(p))

    def _replace(self, rows: DataFrame, table: str, touched: list[int]) -> None:
        """The buckets ``touched`` of ``table`` become ``rows``."""
        spark = rows.sparkSession
        rows = rows.withColumn(BUCKET, self._bucket())
        versioned._write_text(spark, f"{self.path(table)}/{_SCHEMA}", json.dumps(rows.schema.jsonValue()))
        rows = rows.repartition(F.col(BUCKET))
        if self._there(spark, table):
            overwrite.replace_where_partitions(self.path(table), rows, F.col(BUCKET).isin(touched), BUCKET, rows.schema)
        else:
            rows.write.mode("append").partitionBy(BUCKET).parquet(self.path(table))

    def apply(self, changes: DataFrame) -> list[int]:
        """Apply a batch of change rows (a written table or one that can be read
        again); returns the buckets that were rewritten."""
        spark = changes.sparkSession
        self._fixed(spark)
        valid, _ = cdc.split_changes(changes, self.keys, self.seq, self.apply_as_deletes)
        touched = sorted(r[0] for r in valid.select(self._bucket().alias("b")).distinct().collect())
        if not touched:
            return []
        if self._there(spark, "changes"):
            before = self._read(spark, "changes", touched)
            valid = valid.unionByName(before, allowMissingColumns=True)
        payload = cdc._payload(valid, self.keys, self.seq)
        merged = cdc._first_per(valid, self.keys + self.seq, cdc._latest_first(valid, payload))
        self._replace(merged, "changes", touched)
        merged = self._read(spark, "changes", touched).select(*valid.columns)
        history = cdc.scd2(merged, self.keys, self.seq, apply_as_deletes=F.col(cdc._DEL), assume_unique=True,
                           except_columns=self.except_columns + (cdc._DEL,))
        dropped = {c.lower() for c in self.except_columns} & {c.lower() for c in self.keys}
        if dropped:
            raise ValueError(f"key columns {sorted(dropped)} can't be left out of a keyed history")
        self._replace(history, "history", touched)
        history = self.history(spark, touched)
        self._replace(cdc.current_rows(history), "current", touched)
        return touched

    def _read(self, spark: SparkSession, table: str, touched: list[int] | None) -> DataFrame:
        schema = StructType.fromJson(json.loads(versioned._read_text(spark, f"{self.path(table)}/{_SCHEMA}")))
        rows = spark.read.schema(schema).parquet(self.path(table))  # a table may have no rows left
        if touched is not None:
            rows = rows.where(F.col(BUCKET).isin(touched))
        return rows.drop(BUCKET)

    def history(self, spark: SparkSession, touched: list[int] | None = None) -> DataFrame:
        """The SCD 2 history (of some buckets)."""
        return self._read(spark, "history", touched)

    def current(self, spark: SparkSession) -> DataFrame:
        """The gold rows."""
        return self._read(spark, "current", None)
