"""A Python data source of consecutive ids, batch and streaming, and the people
producer on top of it (S3, S10).

``id_range`` publishes the ids from ``start`` up to, not including, ``end``. Each task
makes its own ids as Arrow batches, ``rows_per_partition`` to a partition, so nothing
passes through the driver. As a stream its offset is the next id: what a checkpoint has
taken does not come again, and a restart with a larger ``end`` goes on where the last
run stopped. A range that ends before what was taken is refused. The reader holds no
state, so any driver and executor can go on with it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from lakeshore.sources import files

NAME = "id_range"
_BATCH = 1 << 16


class _Ids(InputPartition):
    def __init__(self, start: int, end: int):
        self.start, self.end = start, end


def _split(start: int, end: int, rows: int) -> list[_Ids]:
    return [_Ids(s, min(s + rows, end)) for s in range(start, end, rows)]


def _batches(part: _Ids):
    for s in range(part.start, part.end, _BATCH):
        yield pa.record_batch({"id": np.arange(s, min(s + _BATCH, part.end), dtype=np.int64)})


class _Options:
    def __init__(self, options):
        self.start, self.end = int(options.get("start", 0)), int(options["end"])
        self.rows = int(options.get("rows_per_partition", 1_000_000))
        if self.rows < 1:
            raise ValueError(f"rows_per_partition must be at least 1, not {self.rows}")


class _Batch(DataSourceReader):
    def __init__(self, options: _Options):
        self.options = options

    def partitions(self):
        o = self.options
        # Spark reads a source without partitions as one of its own
        return _split(o.start, o.end, o.rows) or [_Ids(o.start, o.start)]

    def read(self, partition):
        yield from _batches(partition)


class _Stream(DataSourceStreamReader):
    def __init__(self, options: _Options):
        self.options = options

    def initialOffset(self):
        return {"id": self.options.start}

    def latestOffset(self):
        return {"id": max(self.options.start, self.options.end)}

    def partitions(self, start, end):
        if end["id"] < start["id"]:
            raise ValueError(f"ids up to {start['id']} are taken, the range can't end at {end['id']}")
        return _split(start["id"], end["id"], self.options.rows)

    def read(self, partition):
        yield from _batches(partition)


class IdRange(DataSource):
    """``spark.read`` / ``spark.readStream`` ``.format("id_range").option("end", n)``."""

    @classmethod
    def name(cls):
        return NAME

    def schema(self):
        return "id bigint"

    def reader(self, schema):
        return _Batch(_Options(self.options))

    def streamReader(self, schema):
        return _Stream(_Options(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(IdRange)


def bounds(ids: DataFrame, column: str) -> tuple[int, int]:
    """First id of a table and the one after its last; (0, 0) for a table without ids."""
    low, high = ids.agg(F.min(column), F.max(column)).first()
    return (0, 0) if low is None else (int(low), int(high) + 1)


def stream_people(ids: DataFrame, column: str, end: int | None = None,
                  rows_per_partition: int = 1_000_000) -> DataFrame:
    """People rows as a stream, one for every id that the table ``ids`` holds (below
    ``end``, if given). The range runs over all ids between its first and last, so it
    suits ids that are mostly dense; those the table does not hold are dropped by a
    join with it, and repeated ids count once."""
    spark = ids.sparkSession
    register(spark)
    first, last = bounds(ids, column)
    stream = (spark.readStream.format(NAME).option("start", first)
              .option("end", last if end is None else max(first, min(end, last)))
              .option("rows_per_partition", rows_per_partition).load())
    held = ids.select(F.col(column).cast("long").alias("id"))
    return files.people_from_ids(stream.join(held, "id", "left_semi"))
