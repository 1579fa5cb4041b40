"""The change-data flow: bronze → silver (SCD 1, SCD 2) → clean → gold,
with an event log and its expectation report (T5, C3, K11, Q2, Q3).

Every step is a plain Spark job; a run takes what has landed and stops
(``availableNow``), so it can be scheduled like a batch job and re-run after a
failure: the stream checkpoints skip work already committed, the silver merge
is idempotent, and gold is written as a new version.

* bronze: CSV files of change rows → parquet, incrementally, read by their headers,
  optionally dropping rows that fail ``bronze_rules`` (counted per micro-batch);
  columns that files bring beside the schema are added to it and flow on;
* silver: a stream over bronze applied as SCD 1 and as SCD 2 (state tables),
  materialized as table versions once per run;
* clean: ``expect_or_drop(recent_record: __END_AT IS NULL)`` over the SCD 2
  history, a view;
* gold: the clean rows, written as a version; counts come from the same pass;
* every step appends a ``flow_progress`` event to the log, ``FAILED`` ones too.

A silver table is rewritten only when a run brought changes for it. With ``buckets``
the SCD 2 history and gold are keyed tables (``operators.keyed``): a run rewrites only
the buckets of the keys that it brought changes for.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakeshore.operators import eventlog, quality
from lakeshore.operators.keyed import KeyedHistory
from lakeshore.sinks import versioned
from lakeshore.sinks.catalog import Dataset
from lakeshore.streaming import ingest
from lakeshore.streaming.cdc_stream import ChangeApply

# The clean step's expectation (name, predicate).
RECENT_RECORD = ("recent_record", "__END_AT IS NULL")


class CdcFlow:
    """Declared datasets of the flow under ``root`` and one-shot runs of it."""

    def __init__(self, root: str, schema: StructType, keys, sequence_by,
                 apply_as_deletes=None, except_columns: Sequence[str] = (),
                 compact_every: int = 10, prefix: str = "customer",
                 max_files: int | None = None, materialize: bool = True,
                 log_compact_after: int = 100, bronze_rules=None, buckets: int | None = None):
        self.root = root.rstrip("/")
        self.schema = schema
        self.prefix = prefix
        self.max_files = max_files
        self.bronze = Dataset(f"{prefix}_bronze", f"{self.root}/tables/bronze",
                              "incremental change data ingested from the landing folder",
                              {"quality": "bronze"}, partition_by=(ingest.BATCH,))
        feed = dict(keys=keys, sequence_by=sequence_by, apply_as_deletes=apply_as_deletes,
                    except_columns=except_columns, compact_every=compact_every)
        self.scd1 = ChangeApply(f"{self.root}/tables/silver_scd1", scd_type=1, **feed)
        self.scd2 = ChangeApply(f"{self.root}/tables/silver_scd2", scd_type=2, **feed)
        self.keyed = KeyedHistory(f"{self.root}/tables/keyed_scd2", keys, sequence_by, apply_as_deletes,
                                  except_columns, buckets) if buckets else None
        self.gold_base = f"{self.root}/tables/gold_scd2"
        # Silver targets are views over their state; with ``materialize`` each
        # run also writes them as table versions, so the window over the whole
        # history runs once per run, not once per reader.
        self.materialize = materialize
        self.log_compact_after = int(log_compact_after)
        # Expectations on the bronze stream (drop), counted per micro-batch.
        self.bronze_rules = bronze_rules
        self.silver_bases = {"silver_scd1": f"{self.root}/tables/silver_scd1_table",
                             "silver_scd2": f"{self.root}/tables/silver_scd2_table"}
        self.log_path = f"{self.root}/system/events"

    def _ckpt(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"

    def _event(self, spark, dataset, rows, dropped=0, expectations=None, status="COMPLETED",
               message=None):
        eventlog.append_events(
            eventlog.flow_event(spark, dataset, status, rows, dropped, expectations, message,
                                level="ERROR" if status == "FAILED" else "INFO"), self.log_path)

    @contextmanager
    def _step(self, spark, dataset):
        """A step that fails leaves a ``FAILED`` event."""
        try:
            yield
        except Exception as e:
            self._event(spark, dataset, 0, status="FAILED",
                        message=f"Flow '{dataset}' is FAILED: {str(e)[:500]}")
            raise

    @staticmethod
    def _finished(query) -> None:
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()

    def run(self, spark: SparkSession, landing: str) -> str:
        """One run of every step; returns the gold version path."""
        with self._step(spark, self.bronze.name):
            self._bronze(spark, landing)
        for name, target in (("silver_scd1", self.scd1), ("silver_scd2", self.scd2)):
            with self._step(spark, f"{self.prefix}_{name}"):
                if self.keyed and target is self.scd2:
                    self._silver_keyed(spark, name)
                else:
                    self._silver(spark, name, target)
        with self._step(spark, f"{self.prefix}_gold"):
            path = self._gold(spark)
        # Each event is one small folder; fold them once there are many.
        if len(eventlog._tail_parts(spark, self.log_path)) >= self.log_compact_after:
            eventlog.compact_log(spark, self.log_path)
        return path

    def _bronze(self, spark: SparkSession, landing: str) -> None:
        seen: dict[int, Observation] = {}  # a batch that runs again counts once

        def counted(rows: DataFrame, batch_id: int) -> DataFrame:
            if self.bronze_rules:
                rows, seen[batch_id] = quality.expect(rows, self.bronze_rules, dataset=self.bronze.name)
                return rows
            seen[batch_id] = Observation(f"bronze_{uuid.uuid4().hex}")
            return rows.observe(seen[batch_id], F.count(F.lit(1)).alias("rows"))

        self._finished(ingest.HeaderIngest(
            landing, self.bronze.path, self._ckpt("bronze"), self.schema, unknown="add",
            max_files=self.max_files, transform=counted).start(spark))
        totals: dict[str, int] = {}
        for obs in seen.values():
            for k, v in obs.get.items():
                totals[k] = totals.get(k, 0) + int(v or 0)
        if self.bronze_rules:
            kept, read = totals.get("output_rows", 0), totals.get("input_rows", 0)
            self._event(spark, self.bronze.name, kept, read - kept, quality.stream_expectations(
                totals, self.bronze_rules, self.bronze.name))
        else:
            self._event(spark, self.bronze.name, totals.get("rows", 0))

    def _silver(self, spark: SparkSession, name: str, target: ChangeApply) -> None:
        """Apply what is new in bronze. The event's rows are those of the table
        that was written (of the feed, if none is), its dropped records the rows
        put into quarantine in this run."""
        src = self._bronze_stream(spark)
        target.counts.clear()
        self._finished(target.start(src, self._ckpt(name)))
        read = sum(n for n, _ in target.counts.values())
        dropped = sum(bad for _, bad in target.counts.values())
        rows = read - dropped
        base = self.silver_bases[name]
        if self.materialize and (target.counts or versioned.current_path(spark, base) is None):
            obs = Observation(f"{name}_{uuid.uuid4().hex}")
            table = target.table(spark).observe(obs, F.count(F.lit(1)).alias("rows"))
            versioned.write_version(table, base, meta={})
            versioned.remove_old_versions(spark, base, keep=2)
            rows = obs.get["rows"]
        elif self.materialize:
            rows = versioned.read_current(spark, base).count()
        self._event(spark, f"{self.prefix}_{name}", rows, dropped)

    def _bronze_stream(self, spark: SparkSession) -> DataFrame:
        schema = ingest.ingested_schema(spark, self.bronze.path) or self.schema
        return (spark.readStream.schema(StructType([*schema.fields, StructField(ingest.BATCH, StringType())]))
                .parquet(self.bronze.path).drop(ingest.BATCH))

    def _silver_keyed(self, spark: SparkSession, name: str) -> None:
        """Apply what is new in bronze to the keyed history and gold; the event's rows
        are those of the history."""
        bad: dict[int, int] = {}
        null = functools.reduce(lambda a, c: a | F.col(c).isNull(), self.keyed.keys + self.keyed.seq, F.lit(False))

        def apply(batch: DataFrame, batch_id: int) -> None:
            bad[batch_id] = batch.where(null).count()
            self.keyed.apply(batch)

        self._finished(self._bronze_stream(spark).writeStream.foreachBatch(apply)
                       .option("checkpointLocation", self._ckpt(name)).trigger(availableNow=True).start())
        self._event(spark, f"{self.prefix}_{name}", self.keyed.history(spark).count(), sum(bad.values()))

    def _gold(self, spark: SparkSession) -> str:
        if self.keyed:  # written with the history; the counts come from the files' footers
            kept, rows = self.keyed.current(spark).count(), self.keyed.history(spark).count()
            rule = {"dataset": f"{self.prefix}_gold", "name": RECENT_RECORD[0], "passed_records": kept,
                    "failed_records": rows - kept}
            self._event(spark, f"{self.prefix}_gold", kept, rows - kept, [rule])
            return self.keyed.path("current")
        gold, obs = self.clean(spark)
        path = versioned.write_version(gold, self.gold_base, meta={})
        versioned.remove_old_versions(spark, self.gold_base, keep=2)
        got = obs.get
        self._event(spark, f"{self.prefix}_gold", got["output_rows"],
                    got["input_rows"] - got["output_rows"],
                    quality.observed_expectations(obs, [RECENT_RECORD],
                                                  f"{self.prefix}_gold"))
        return path

    def clean(self, spark: SparkSession):
        """The clean step: open rows of the SCD 2 history, and their counts."""
        return quality.expect_or_drop(self.silver(spark, 2), *RECENT_RECORD,
                                      dataset=f"{self.prefix}_gold")

    def silver(self, spark: SparkSession, scd_type: int) -> DataFrame:
        """The silver SCD 1 table or SCD 2 history (materialized version when
        there is one, else the view over the state)."""
        if self.keyed and scd_type == 2:
            return self.keyed.history(spark)
        name, target = (("silver_scd1", self.scd1) if scd_type == 1
                        else ("silver_scd2", self.scd2))
        if self.materialize and versioned.current_path(spark, self.silver_bases[name]):
            return versioned.read_current(spark, self.silver_bases[name])
        return target.table(spark)

    def gold(self, spark: SparkSession) -> DataFrame:
        return self.keyed.current(spark) if self.keyed else versioned.read_current(spark, self.gold_base)

    def report(self, spark: SparkSession) -> DataFrame:
        return eventlog.expectation_report(eventlog.read_log(spark, self.log_path))

    def register_views(self, spark: SparkSession, schema: str | None = None) -> None:
        """Name every dataset for SQL users: bronze (declared table), the two
        silver targets, gold and the event log.

        Without ``schema`` they are temp views. With it they are persistent
        views in that schema carrying a comment and a ``quality`` property
        (bronze / silver / gold), as the pipeline's dataset declarations do;
        the silver and gold views point at the current materialized versions
        and are re-pointed by each call."""
        self.bronze.register(spark)
        names = {"silver_scd1": f"{self.prefix}_silver_scd_type_1",
                 "silver_scd2": f"{self.prefix}_silver_scd_type_2",
                 "gold": f"{self.prefix}_gold_scd_type_2"}
        clean = f"{self.prefix}_clean_scd_type_2"
        if schema is None or not self.materialize:
            self.silver(spark, 1).createOrReplaceTempView(names["silver_scd1"])
            self.silver(spark, 2).createOrReplaceTempView(names["silver_scd2"])
            self.silver(spark, 2).where(RECENT_RECORD[1]).createOrReplaceTempView(clean)
            self.gold(spark).createOrReplaceTempView(names["gold"])
        else:
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
            paths = {"silver_scd1": versioned.current_path(spark, self.silver_bases["silver_scd1"]),
                     "silver_scd2": versioned.current_path(spark, self.silver_bases["silver_scd2"]),
                     "gold": versioned.current_path(spark, self.gold_base)}
            shown = dict.fromkeys(names, "*")
            if self.keyed:
                for key, kind, rows in (("silver_scd2", "history", self.silver(spark, 2)),
                                        ("gold", "current", self.gold(spark))):
                    paths[key] = self.keyed.path(kind)
                    shown[key] = ", ".join(f"`{c}`" for c in rows.columns)
            comments = {"silver_scd1": "one row per customer, the latest change",
                        "silver_scd2": "every version of a customer with its validity",
                        "gold": "versions that are valid now, stored"}
            for key, view in names.items():
                quality_tag = "gold" if key == "gold" else "silver"
                spark.sql(f"CREATE OR REPLACE VIEW {schema}.{view} "
                          f"COMMENT '{comments[key]}' "
                          f"TBLPROPERTIES ('quality' = '{quality_tag}') "
                          f"AS SELECT {shown[key]} FROM parquet.`{paths[key]}`")
            spark.sql(f"CREATE OR REPLACE VIEW {schema}.{clean} "
                      "COMMENT 'versions that are valid now, over the silver history' "
                      f"AS SELECT * FROM {schema}.{names['silver_scd2']} WHERE {RECENT_RECORD[1]}")
        eventlog.read_log(spark, self.log_path).createOrReplaceTempView(
            f"{self.prefix}_event_log")
