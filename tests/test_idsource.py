"""The id source: whole ranges in batch, each id once over restarts of a stream."""

import pytest
from pyspark.errors import StreamingQueryException

from lakeshore.sources import files, idsource
from lakeshore.streaming import ingest


def ids_of(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_batch_range(spark):
    idsource.register(spark)
    read = lambda **o: spark.read.format("id_range").options(**o).load()
    df = read(start=5, end=200_017, rows_per_partition=70_000)
    assert df.rdd.getNumPartitions() == 3
    assert ids_of(df) == list(range(5, 200_017))
    assert ids_of(read(start=3, end=3)) == []
    assert ids_of(read(start=-2, end=1)) == [-2, -1, 0]
    with pytest.raises(Exception, match="rows_per_partition"):
        read(end=3, rows_per_partition=0).collect()


def test_stream_goes_on_after_a_restart(spark, scratch):
    table = spark.createDataFrame([(i,) for i in [3, 4, 4, 9, 20, 21, 40, None]], "key long")
    target, checkpoint = scratch("people"), scratch("people-ckpt")
    for end, want in ((10, [3, 4, 9]), (10, [3, 4, 9]), (21, [3, 4, 9, 20]), (None, [3, 4, 9, 20, 21, 40])):
        stream = idsource.stream_people(table, "key", end=end, rows_per_partition=5)
        ingest.start_append(stream, target, checkpoint).awaitTermination()
        assert ids_of(spark.read.parquet(target)) == want
    got = {tuple(r) for r in spark.read.parquet(target).collect()}
    ids = table.where("key is not null").distinct()
    assert got == {tuple(r) for r in files.people_from_ids(ids, "key").collect()}
    shorter = idsource.stream_people(table, "key", end=10)
    with pytest.raises(StreamingQueryException, match="can't end at 10"):
        ingest.start_append(shorter, target, checkpoint).awaitTermination()


def test_empty_table(spark, scratch):
    none = spark.createDataFrame([], "key long")
    assert idsource.bounds(none, "key") == (0, 0)
    target = scratch("nobody")
    ingest.start_append(idsource.stream_people(none, "key"), target, scratch("nobody-ckpt")).awaitTermination()
    assert spark.read.schema("id long").parquet(target).count() == 0
