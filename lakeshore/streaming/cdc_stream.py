"""Streaming change apply (T3): SCD type 1 or 2 kept up to date from a
stream of change rows, equal to the batch form over everything seen so far.

State is log-structured, so a micro-batch costs the size of the batch, not of
the state, and nothing is ever deleted before its replacement is committed:

* ``log/__batch=<id>_<writer>/`` — each micro-batch appends its valid change
  rows (with a delete flag; for SCD 1 first reduced to one row per key,
  map-side) as its own partition, written by a dynamic partition overwrite, so
  a replayed batch (``foreachBatch`` is at-least-once) replaces its own earlier
  attempt, and several streams may feed one target. The writer is an id kept in
  the stream's checkpoint: a restart goes on under it, a new checkpoint (also
  one at the same path) makes a new one, whose batch 0 is not the old batch 0;
* ``base/`` — a compacted state, one row per (K, S) for SCD 2 (tombstones
  kept, so late rows older than a delete still order correctly) or one row per
  K for SCD 1, written once ``compact_every`` log partitions have piled up, as
  a new version folder (committed by ``_SUCCESS``) that records the partitions
  it folded; those are removed only after that commit. A compaction claims the
  number after the base it read before it reads it, so of two that started from
  one base only one can commit, and the other gives up;
* ``columns.json`` — the columns of the feed and their types, in order, for readers
  in other sessions. A batch with new columns puts them after the others; older
  rows have null there, and a batch without a column has null in it. A column that
  comes back with another type is refused.

The target is a view: base ∪ log partitions after the base's last batch,
reduced exactly as the batch operator reduces a change feed (a max over a fixed
total order, which is idempotent, so duplicates from replays or from a crash
between compaction and log clean-up change nothing). For SCD 2 that is the
batch window (one shuffle on the key, hot keys split into chunks); for SCD 1 a
map-side combined aggregate. Rows with a null key or sequence go to a
quarantine table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType

from lakeshore.operators import cdc
from lakeshore.sinks import versioned

BATCH = "__batch"
_DEL = cdc._DEL


class ChangeApply:
    """A declared change apply target fed by a stream."""

    def __init__(self, state_path: str, keys, sequence_by, scd_type: int | str = 2,
                 apply_as_deletes=None, except_columns: Sequence[str] = (),
                 compact_every: int = 10, quarantine_path: str | None = None,
                 writer: str | None = None):
        self.state_path = state_path.rstrip("/")
        self.keys = cdc._names(keys)
        # A sequence given as a Column expression becomes a hidden column.
        self.seq_spec = sequence_by
        items = ([sequence_by] if isinstance(sequence_by, (str, Column))
                 else list(sequence_by))
        self.seq = [f"__seq{i}" if isinstance(it, Column) else it
                    for i, it in enumerate(items)]
        self.hidden = [n for n, it in zip(self.seq, items) if isinstance(it, Column)]
        self.scd_type = str(scd_type)
        if self.scd_type not in ("1", "2"):
            raise ValueError(f"scd_type must be 1 or 2, not {scd_type!r}")
        self.apply_as_deletes = apply_as_deletes
        self.except_columns = tuple(except_columns)
        self.compact_every = int(compact_every)
        self.quarantine_path = quarantine_path or self.state_path + "_quarantine"
        self.log_path = self.state_path + "/log"
        self.base_path = self.state_path + "/base"
        self.schema: StructType | None = None
        self.writer = writer or uuid.uuid4().hex
        self._auto_batch = 0
        #: {batch id: (rows read, rows quarantined)} of this object's batches.
        self.counts: dict[int, tuple[int, int]] = {}

    # -- reduce --------------------------------------------------------------
    def _reduce_scd1(self, rows: DataFrame) -> DataFrame:
        """One row per key: the change of greatest (S, delete, payload)."""
        payload = cdc._payload(rows, self.keys, self.seq)
        latest = cdc.latest_of(rows, self.seq + [_DEL] + payload).alias("__r")
        return (rows.groupBy(*self.keys).agg(latest)
                .select(*self.keys, *[F.col(f"__r.{c}") for c in self.seq + [_DEL] + payload]))

    def _reduced(self, rows: DataFrame) -> DataFrame:
        if self.scd_type == "1":
            return self._reduce_scd1(rows)
        return cdc._dedupe(rows, self.keys, self.seq)

    # -- write ---------------------------------------------------------------
    def _part(self, batch_id: int) -> str:
        return f"{int(batch_id):012d}_{self.writer}"

    def apply_batch(self, batch: DataFrame, batch_id: int | None = None) -> None:
        """Append one batch of change rows to the state log as the partition
        ``<batch id>_<writer>``: a replay of the batch by the same query
        replaces its own partition, and several queries (writers) feeding one
        target never touch each other's. Compacts once ``compact_every``
        partitions have piled up. One job in the common case; quarantined rows
        are counted on the way and written only when there are some."""
        spark = batch.sparkSession
        if batch_id is None:
            batch_id, self._auto_batch = self._auto_batch, self._auto_batch + 1
        batch = self._known(spark, batch)
        batch, _ = cdc.with_sequence(batch, self.seq_spec)
        bad_flag = F.lit(False)
        for c in self.keys + self.seq:
            bad_flag = bad_flag | F.col(c).isNull()
        obs = Observation(f"quarantine_{batch_id}_{uuid.uuid4().hex}")
        observed = batch.observe(obs, F.count(F.lit(1)).alias("rows"),
                                 F.sum(F.when(bad_flag, 1).otherwise(0)).alias("bad"))
        valid, _ = cdc.split_changes(observed, self.keys, self.seq, self.apply_as_deletes)
        if self.scd_type == "1":
            # Map-side combined: a key holding much of the batch becomes one
            # row per task before the shuffle.
            valid = self._reduce_scd1(valid)
        else:
            valid = valid.select(*self.keys, *self.seq, _DEL,
                                 *cdc._payload(valid, self.keys, self.seq))
        tag = F.lit(self._part(batch_id))
        (valid.withColumn(BATCH, tag)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BATCH).parquet(self.log_path))
        n_rows, n_bad = int(obs.get.get("rows") or 0), int(obs.get.get("bad") or 0)
        self.counts[int(batch_id)] = (n_rows, n_bad)  # a replay counts once
        if n_bad > 0:
            _, bad = cdc.split_changes(batch, self.keys, self.seq, self.apply_as_deletes)
            (bad.drop(*self.hidden).withColumn(BATCH, tag)
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(BATCH).parquet(self.quarantine_path))
        if self.compact_every > 0 and len(self._log_parts(spark)) >= self.compact_every:
            self.compact(spark)

    def _log_parts(self, spark: SparkSession) -> list[str]:
        """Names of the log partitions (``<batch>_<writer>``) on disk."""
        fs, p = versioned._fs(spark, self.log_path)
        if not fs.exists(p):
            return []
        return sorted(st.getPath().getName().split("=", 1)[1] for st in fs.listStatus(p)
                      if st.isDirectory() and st.getPath().getName().startswith(BATCH + "="))

    def _stored(self, spark: SparkSession) -> StructType | None:
        """The feed's columns as kept with the state: every session shows the same."""
        text = versioned._read_text(spark, f"{self.state_path}/columns.json")
        return StructType.fromJson(json.loads(text)) if text else None

    def _known(self, spark: SparkSession, batch: DataFrame) -> DataFrame:
        """``batch`` with all columns of the feed so far, which it may add to."""
        stored = self._stored(spark)
        fields = list(stored.fields) if stored is not None else []
        types = {f.name.lower(): f.dataType for f in fields}
        for f in batch.schema.fields:
            known = types.get(f.name.lower())
            if known is None:
                fields.append(StructField(f.name, f.dataType))
            elif known != f.dataType:
                raise ValueError(f"column {f.name} was {known.simpleString()} and now is {f.dataType.simpleString()}")
        self.schema = StructType(fields)
        if stored is None or len(fields) > len(stored):
            versioned._write_text(spark, f"{self.state_path}/columns.json", json.dumps(self.schema.jsonValue()))
        have = {c.lower() for c in batch.columns}
        return batch.select(*[(F.col(f"`{f.name}`") if f.name.lower() in have else F.lit(None).cast(f.dataType))
                              .alias(f.name) for f in fields])

    def _folded(self, spark: SparkSession) -> set[str]:
        return set(versioned.read_meta(spark, self.base_path).get("folded", []))

    # -- read ----------------------------------------------------------------
    def _union(self, spark: SparkSession, parts: list[str] | None = None
               ) -> DataFrame | None:
        """Base ∪ the log partitions it does not hold (or ``parts``), not yet
        reduced. A partition read twice changes nothing: the reduce is an
        idempotent max, which is what makes every crash point safe."""
        frames = []
        has_base = versioned.current_path(spark, self.base_path) is not None
        if has_base:
            base = versioned.read_current(spark, self.base_path)
            frames.append(base)
        if parts is None:
            folded = self._folded(spark) if has_base else set()
            parts = [n for n in self._log_parts(spark) if n not in folded]
        if parts:
            paths = [f"{self.log_path}/{BATCH}={n}" for n in parts]
            # with the columns of today: a batch of before has null in newer ones
            frames.append(spark.read.schema(self._state_schema(spark)).parquet(*paths))
        if not frames:
            return None
        out = frames[-1]
        for f in frames[:-1]:
            out = out.unionByName(f, allowMissingColumns=True)
        return out

    def compact(self, spark: SparkSession) -> str | None:
        """Fold the log into a new base version, then drop the folded log
        partitions. Safe to interrupt anywhere: until the new version is
        committed the old base and the log stand; after it, leftover folded
        partitions are skipped by readers (and would be harmless if read).

        Several streams may compact: the number after the base is claimed before
        the base is read, so a base is the parent of one committed version only;
        who finds it claimed leaves the work to the other (None)."""
        with versioned.next_version(spark, self.base_path) as (number, parent):
            if number is None:
                return None
            parts = self._log_parts(spark)
            folded = self._folded(spark)
            fresh = [n for n in parts if n not in folded]
            path = None
            if fresh:
                path = versioned.write_version(
                    self._reduced(self._union(spark, fresh)), self.base_path,
                    meta={"folded": fresh, "parent": parent}, number=number)
            if path and versioned.current_path(spark, self.base_path) != path:
                return path  # a newer base holds all of it; the log is its owner's
            for n in parts:
                fs, p = versioned._fs(spark, f"{self.log_path}/{BATCH}={n}")
                if fs.exists(p):
                    fs.delete(p, True)
            if path:
                versioned.remove_old_versions(spark, self.base_path, keep=2)
        return path

    def _rows(self, spark: SparkSession) -> DataFrame:
        rows = self._union(spark)
        if rows is not None:
            return rows
        if self.schema is None:
            raise FileNotFoundError(f"no state under {self.state_path}")
        # Nothing applied yet (or only quarantined rows): an empty state.
        return self._empty(spark, self.schema)

    def _empty(self, spark: SparkSession, schema: StructType) -> DataFrame:
        src, _ = cdc.with_sequence(spark.createDataFrame([], schema), self.seq_spec)
        empty, _ = cdc.split_changes(src, self.keys, self.seq, self.apply_as_deletes)
        return empty.select(*self.keys, *self.seq, _DEL,
                            *cdc._payload(empty, self.keys, self.seq))

    def _state_schema(self, spark: SparkSession) -> StructType:
        """Columns of the log's files: the feed's, the hidden ones and the flag."""
        return self._empty(spark, self._stored(spark) or self.schema).schema

    def state(self, spark: SparkSession) -> DataFrame:
        """The reduced state (one row per key, or per key and sequence)."""
        return self._reduced(self._rows(spark))

    def table(self, spark: SparkSession, **kwargs) -> DataFrame:
        """The target as the batch form would give it: current rows for SCD 1,
        history with ``__START_AT`` / ``__END_AT`` for SCD 2."""
        rows = self._rows(spark)
        stored = self._stored(spark) or self.schema
        cols = stored.names if stored is not None else [c for c in rows.columns if c not in [_DEL] + self.hidden]
        if self.scd_type == "1":
            state = self._reduce_scd1(rows)
            return cdc._finish(state.where(~F.col(_DEL)), cols, self.except_columns)
        return cdc.scd2(rows.select(*cols, *self.hidden, _DEL), self.keys, self.seq,
                        apply_as_deletes=F.col(_DEL),
                        except_columns=self.except_columns + (_DEL, *self.hidden), **kwargs)

    def current(self, spark: SparkSession) -> DataFrame:
        t = self.table(spark)
        return t if self.scd_type == "1" else cdc.current_rows(t)

    # -- stream --------------------------------------------------------------
    def start(self, stream: DataFrame, checkpoint: str, available_now: bool = True,
              name: str | None = None, processing_time: str | None = None) -> StreamingQuery:
        """Run the apply over ``stream``: ``availableNow`` (take what is there,
        then stop) by default, or continuously every ``processing_time``."""
        self.schema = stream.schema
        # Kept in the checkpoint: goes on with it, and goes with it.
        spark = stream.sparkSession
        path = f"{checkpoint.rstrip('/')}/change_apply_writer"
        self.writer = versioned._read_text(spark, path) or uuid.uuid4().hex
        versioned._write_text(spark, path, self.writer)
        w = (stream.writeStream.foreachBatch(self.apply_batch)
             .option("checkpointLocation", checkpoint))
        if name:
            w = w.queryName(name)
        if available_now:
            w = w.trigger(availableNow=True)
        elif processing_time:
            w = w.trigger(processingTime=processing_time)
        return w.start()


def apply_changes_stream(stream: DataFrame, state_path: str, checkpoint: str, keys,
                         sequence_by, scd_type: int | str = 2, apply_as_deletes=None,
                         except_columns: Sequence[str] = (), compact_every: int = 10,
                         wait: bool = True) -> ChangeApply:
    """Run a change apply over ``stream`` (availableNow) and return its target."""
    target = ChangeApply(state_path, keys, sequence_by, scd_type, apply_as_deletes,
                         except_columns, compact_every)
    q = target.start(stream, checkpoint)
    if wait:
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    return target
