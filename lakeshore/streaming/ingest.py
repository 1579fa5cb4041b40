"""Incremental file ingest into a table.

The file source lists the landing folder each micro-batch and takes only files
it has not seen; the sink's checkpoint records both the files read and the
batches committed, so a restarted query neither loses nor repeats rows. The
default trigger is ``availableNow``: take everything there is (split by
``max_files`` per batch), then stop, which suits scheduled jobs and tests.

Files with headers are read by them (:class:`HeaderIngest`): the stream carries the
names of new files, and each micro-batch reads its files by header and writes its
rows as a partition of its own, ``__batch=<id>_<writer>``. A batch that runs again
replaces its partition. What the columns are is kept in a schema log beside the
checkpoint and grows when files bring new ones.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from lakeshore.sinks import versioned
from lakeshore.sources import headers
from lakeshore.sources.files import CSV_OPTIONS, stream_csv

#: Partition column of a table that is ingested by header.
BATCH = "__batch"
#: The columns of Spark's file listing source.
_LISTING = "path string, modificationTime timestamp, length long, content binary"
_SCHEMA_FILE = "_schema.json"


#: How long an id is remembered after its file has landed.
REMEMBER = "7 days"


def once_within(stream: DataFrame, ids: list[str], remember: str = REMEMBER) -> DataFrame:
    """``stream`` over files without rows whose ``ids`` came before (T2): a file that
    lands again under another name adds nothing. Rows are dated by the time their file
    landed, so state is bounded by what lands within ``remember``, and no row is late
    by its own times. A file that shows up with a landing time more than that before
    the newest one is taken for a replay."""
    landed = stream.select("*", "_metadata.file_modification_time")
    return (landed.withWatermark("file_modification_time", remember).dropDuplicatesWithinWatermark(ids)
            .drop("file_modification_time"))


class HeaderIngest:
    """CSV files with headers, incrementally, into a parquet table.

    ``schema``: the table's columns; None takes all columns of the files. ``rescue``
    and ``unknown`` as in :func:`headers.read_by_header`; columns added by ``add``
    stay in the schema from then on. ``transform`` may change or filter a batch's
    rows; it is called with the rows and the batch id."""

    def __init__(self, source_dir: str, target_path: str, checkpoint: str, schema: StructType | str | None = None,
                 rescue: str | None = None, unknown: str | None = None, max_files: int | None = None,
                 archive_dir: str | None = None, sep: str = ",",
                 transform: Callable[[DataFrame, int], DataFrame] | None = None):
        self.source_dir, self.target, self.checkpoint = source_dir, target_path.rstrip("/"), checkpoint.rstrip("/")
        self.given = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.rescue, self.sep, self.max_files, self.archive_dir = rescue, sep, max_files, archive_dir
        self.unknown = unknown or ("rescue" if rescue and schema is not None else "add")
        self.transform = transform
        self.writer = ""

    # -- schema log ----------------------------------------------------------
    def _log(self, spark: SparkSession) -> list[str]:
        fs, p = versioned._fs(spark, f"{self.checkpoint}/schema_log")
        return sorted(st.getPath().toString() for st in fs.listStatus(p)) if fs.exists(p) else []

    def schema(self, spark: SparkSession) -> StructType | None:
        """The columns so far: the last entry of the log, else what was given."""
        log = self._log(spark)
        return StructType.fromJson(json.loads(versioned._read_text(spark, log[-1]))["schema"]) if log else self.given

    def _grow(self, spark: SparkSession, schema: StructType, batch_id: int) -> None:
        entry = {"batch": int(batch_id), "schema": schema.jsonValue()}
        versioned._write_text(spark, f"{self.checkpoint}/schema_log/{len(self._log(spark)):08d}.json", json.dumps(entry))

    # -- stream --------------------------------------------------------------
    def _apply(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        files = [r["path"] for r in batch.select("path").collect()]  # at most max_files
        if not files:
            return
        found = headers.file_headers(spark, [headers._literal(f) for f in files], self.sep)
        schema = self.schema(spark)
        if schema is None or self.unknown == "add":
            grown = headers.header_schema(found, schema)
            if schema is None or len(grown) > len(schema):
                self._grow(spark, grown, batch_id)
            schema = grown
        rows = headers.read_by_header(spark, [], schema, self.rescue, self.unknown, self.sep, CSV_OPTIONS, found)
        if self.transform:
            rows = self.transform(rows, int(batch_id))
        rows.write.mode("overwrite").parquet(f"{self.target}/{BATCH}={int(batch_id):012d}_{self.writer}")
        versioned._write_text(spark, f"{self.target}/{_SCHEMA_FILE}", json.dumps(rows.schema.jsonValue()))

    def start(self, spark: SparkSession, name: str | None = None, processing_time: str | None = None) -> StreamingQuery:
        """Take what has landed and stop, or go on every ``processing_time``."""
        path = f"{self.checkpoint}/ingest_writer"  # goes on with the checkpoint, and goes with it
        self.writer = versioned._read_text(spark, path) or uuid.uuid4().hex
        versioned._write_text(spark, path, self.writer)
        reader = spark.readStream.format("binaryFile").schema(_LISTING)
        if self.max_files:
            reader = reader.option("maxFilesPerTrigger", int(self.max_files))
        if self.archive_dir:
            reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", self.archive_dir)
        w = (reader.load(self.source_dir).select("path").writeStream.foreachBatch(self._apply)
             .option("checkpointLocation", self.checkpoint))
        if name:
            w = w.queryName(name)
        w = w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)
        return w.start()


def ingested_schema(spark: SparkSession, target_path: str) -> StructType | None:
    """The columns of a table ingested by header, without the batch; None before its
    first batch."""
    text = versioned._read_text(spark, f"{target_path.rstrip('/')}/{_SCHEMA_FILE}")
    return StructType.fromJson(json.loads(text)) if text else None


def ingested(spark: SparkSession, target_path: str, batch: bool = False) -> DataFrame:
    """A table ingested by header: all columns that any batch has brought (null
    where a batch did not have them), and the batch if wanted."""
    schema = ingested_schema(spark, target_path)
    if schema is None:
        raise FileNotFoundError(f"nothing ingested under {target_path}")
    rows = spark.read.schema(StructType([*schema.fields, StructField(BATCH, StringType())])).parquet(target_path)
    return rows if batch else rows.drop(BATCH)


def start_append(stream: DataFrame, target_path: str, checkpoint: str,
                 available_now: bool = True, name: str | None = None,
                 partition_by=None, processing_time: str | None = None) -> StreamingQuery:
    """Exactly-once parquet append of a stream."""
    w = (stream.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint))
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    if name:
        w = w.queryName(name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start(target_path)


def ingest_csv(spark: SparkSession, source_dir: str, target_path: str, checkpoint: str,
               schema=None, header: bool = True, max_files: int | None = None,
               table: str | None = None, wait: bool = True,
               archive_dir: str | None = None, rescue: str | None = None,
               unknown: str | None = None) -> StreamingQuery:
    """CSV folder → parquet table, incrementally (the bronze step). With headers the
    files are read by them and :func:`ingested` reads the table; without, by position
    into Spark's own file sink.

    With ``wait`` the call returns once all files present are ingested; only
    then is ``table`` registered over the target, so a reader never sees a
    table the stream has not written yet."""
    if header:
        q = HeaderIngest(source_dir, target_path, checkpoint, schema, rescue, unknown, max_files,
                         archive_dir).start(spark, table)
    else:
        stream = stream_csv(spark, source_dir, schema=schema, header=False, max_files=max_files,
                            archive_dir=archive_dir)
        q = start_append(stream, target_path, checkpoint, available_now=True, name=table)
    if wait:
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
        if table and header:
            ingested(spark, target_path).createOrReplaceTempView(table)
        elif table:
            versioned.register(spark, table, target_path)
    return q
