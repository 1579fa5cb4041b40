"""Streaming change apply kept in Spark's own state store.

The state is a streaming aggregate: for SCD 2 the greatest change of every (key,
sequence), for SCD 1 the greatest of every key, in the order of the batch form (a
delete wins, then the greatest payload). It is an idempotent maximum, combined
map-side, and Spark keeps it exactly once with the checkpoint: versioned, in RocksDB,
restored on any executor. Nothing else is written. The target is read back from the
checkpoint with the ``statestore`` source and shown as the batch form shows a feed.

Rows with a null key or sequence are left out. Columns are fixed by the first start:
a feed with others is refused. Map columns have no order and are
refused.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakeshore.operators import cdc
from lakeshore.sinks import versioned

#: Fixed value: Spark's provider that keeps state on disk instead of in the heap.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
_DEL = cdc._DEL


class StateApply:
    """A change apply target whose state is that of the streaming query at
    ``checkpoint``."""

    def __init__(self, checkpoint: str, keys, sequence_by, scd_type: int | str = 2,
                 apply_as_deletes: str | Column | None = None, except_columns: Sequence[str] = ()):
        self.checkpoint = checkpoint.rstrip("/")
        self.keys, self.seq = cdc._names(keys), cdc._names(sequence_by)
        self.scd_type = str(scd_type)
        if self.scd_type not in ("1", "2"):
            raise ValueError(f"scd_type must be 1 or 2, not {scd_type!r}")
        self.apply_as_deletes, self.except_columns = apply_as_deletes, tuple(except_columns)

    def _grouped(self) -> list[str]:
        return self.keys + (self.seq if self.scd_type == "2" else [])

    def start(self, stream: DataFrame, name: str | None = None, processing_time: str | None = None) -> StreamingQuery:
        """Take what is there and stop, or go on every ``processing_time``."""
        spark = stream.sparkSession
        valid, _ = cdc.split_changes(stream, self.keys, self.seq, self.apply_as_deletes)
        group = self._grouped()
        rest = ([] if self.scd_type == "2" else self.seq) + [_DEL] + cdc._payload(valid, self.keys, self.seq)
        held = [c for c in rest if cdc._has_map(valid.schema[c].dataType)]
        if held:
            raise ValueError(f"columns {held} hold maps, which have no order")
        at = f"{self.checkpoint}/feed_columns.json"  # the feed's column order goes with the state
        known = versioned._read_text(spark, at)
        if known is not None and json.loads(known) != stream.columns:
            raise ValueError(f"the state has columns {json.loads(known)}, the feed has {stream.columns}")
        versioned._write_text(spark, at, json.dumps(stream.columns))
        state = valid.groupBy(*group).agg(F.max(F.struct(*[F.col(c) for c in rest])).alias("latest"))
        before = spark.conf.get(_PROVIDER_KEY, None)
        spark.conf.set(_PROVIDER_KEY, PROVIDER)  # the query takes it over when it starts
        try:
            w = state.writeStream.outputMode("update").format("noop").option("checkpointLocation", self.checkpoint)
            if name:
                w = w.queryName(name)
            w = w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)
            return w.start()
        finally:
            spark.conf.unset(_PROVIDER_KEY) if before is None else spark.conf.set(_PROVIDER_KEY, before)

    def state(self, spark: SparkSession) -> DataFrame:
        """One row per (key, sequence), or per key for SCD 1: the feed's columns and the
        delete flag, deletes included."""
        rows = spark.read.format("statestore").load(self.checkpoint)
        latest = rows.schema["value"].dataType.fields[0].name
        key = [F.col(f"key.`{f.name}`").alias(c) for f, c in zip(rows.schema["key"].dataType.fields, self._grouped())]
        return rows.select(*key, F.col(f"value.`{latest}`").alias("latest")).select(*self._grouped(), "latest.*")

    def table(self, spark: SparkSession, **kwargs) -> DataFrame:
        """Current rows (SCD 1), or the history with ``__START_AT`` / ``__END_AT``."""
        state = self.state(spark)
        names = json.loads(versioned._read_text(spark, f"{self.checkpoint}/feed_columns.json"))
        shown = state.select(*names, _DEL)
        if self.scd_type == "1":
            return cdc._finish(shown.where(~F.col(_DEL)), names, self.except_columns)
        return cdc.scd2(shown, self.keys, self.seq, apply_as_deletes=F.col(_DEL), assume_unique=True,
                        except_columns=self.except_columns + (_DEL,), **kwargs)

    def current(self, spark: SparkSession) -> DataFrame:
        table = self.table(spark)
        return table if self.scd_type == "1" else cdc.current_rows(table)
