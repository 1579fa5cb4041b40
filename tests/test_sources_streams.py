"""CSV sources, schema capture, the people producer, ingest, joins, catalog."""

import pytest
from pyspark.sql import functions as F

from lakeshore.operators import joins, partitioning
from lakeshore.sinks import catalog
from lakeshore.sources import files
from lakeshore.streaming import ingest

from conftest import SF001


def test_csv_all_strings_and_glob(spark, scratch):
    path = scratch("csv")
    cust = spark.read.parquet(f"{SF001}/customer.parquet")
    files.write_csv_files(cust, path, files=3)
    df = files.read_csv(spark, path + "/*")
    assert {t for _, t in df.dtypes} == {"string"}
    assert df.count() == cust.count()
    # F2 trap: a string key compared as a number needs try_cast under ANSI mode
    n = df.where(F.expr("try_cast(c_custkey AS BIGINT) BETWEEN 10 AND 15")).count()
    assert n == 6


def test_people_producer(spark, scratch):
    ppl = files.people(spark, 1000)
    stats = ppl.agg(F.min("Age"), F.max("Age"), F.countDistinct("Country")).first()
    assert stats[0] >= 10 and stats[1] <= 60 and stats[2] == 6
    assert ppl.where("Name = '' OR Name IS NULL").count() == 0
    assert ppl.select("Name").distinct().count() == 1000


def test_stream_inferred_schema_and_restart(spark, scratch):
    landing, target, ckpt = scratch("land"), scratch("bronze"), scratch("ckpt")
    files.write_csv_files(files.people(spark, 20), landing, files=2)
    ingest.ingest_csv(spark, landing, target, ckpt, table="people_bronze")
    assert spark.table("people_bronze").count() == 20
    # header lines are not data rows
    assert spark.table("people_bronze").where("Age = 'Age'").count() == 0
    # a restart with no new file adds nothing; a new file is picked up once
    ingest.ingest_csv(spark, landing, target, ckpt)
    assert spark.read.parquet(target).count() == 20
    files.write_csv_files(files.people(spark, 10), landing, files=1)
    ingest.ingest_csv(spark, landing, target, ckpt)
    assert spark.read.parquet(target).count() == 30


def test_join_strategies(spark):
    o = spark.read.parquet(f"{SF001}/orders.parquet")
    c = spark.read.parquet(f"{SF001}/customer.parquet") \
        .withColumnRenamed("c_custkey", "o_custkey")
    b = joins.join(o, c, "o_custkey", strategy="auto")
    m = joins.join(o, c, "o_custkey", strategy="merge")
    assert joins.join_strategy(b) == "BroadcastHashJoin"
    assert joins.join_strategy(m) == "SortMergeJoin"
    assert b.count() == m.count() == o.count()
    small = joins.join(o, c, "o_custkey", strategy="broadcast", max_broadcast_bytes=10)
    assert small.count() == o.count()  # beyond the bound: Spark's choice, never an error
    with pytest.raises(ValueError):
        joins.join(o, c, "o_custkey", "full", strategy="broadcast")


def test_range_join_both_strategies_agree(spark):
    a, b = spark.range(1000), spark.range(1000)
    bj = joins.join(a, b, "id", strategy="broadcast")
    mj = joins.join(a, b, "id", strategy="merge")
    assert bj.count() == mj.count() == 1000


def test_distinct_and_partitions(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "c string")
    assert partitioning.distinct_values(df, "c") == 3
    assert df.select(F.count_distinct("c")).first()[0] == 2
    r = partitioning.repartition_by_distinct(df, "c")
    assert partitioning.num_partitions(r) == 3


def test_dataset_declaration(spark, scratch):
    catalog.create_schema(spark, "lk_test")
    ds = catalog.Dataset("lk_test.people", scratch("people"), "people rows",
                         {"quality": "bronze"})
    ds.write(files.people(spark, 10))
    ds.write(files.people(spark, 5))
    assert ds.read(spark).count() == 15
    assert catalog.table_properties(spark, "lk_test.people")["quality"] == "bronze"
    catalog.drop_table(spark, "lk_test.people")
    assert spark.read.parquet(ds.path).count() == 15  # external: files stay
    catalog.drop_schema(spark, "lk_test", cascade=True)


def test_ingest_archives_processed_files(spark, scratch):
    import os
    import time

    landing, target, ckpt, archive = scratch("land"), scratch("t"), scratch("c"), scratch("a")
    files.write_csv_files(files.people(spark, 30), landing, files=3)
    ingest.ingest_csv(spark, landing, target, ckpt, max_files=1, archive_dir=archive)
    assert spark.read.parquet(target).count() == 30

    def archived():
        return [n for _, _, names in os.walk(archive) for n in names if n.endswith(".csv")]
    # files of committed batches are moved out (the cleaner may run async)
    deadline = time.time() + 20
    while not archived() and time.time() < deadline:
        time.sleep(0.5)
    assert archived()


def test_partitioned_dataset_declaration(spark, scratch):
    catalog.create_schema(spark, "lk_part")
    ds = catalog.Dataset("lk_part.people", scratch("pp"), "people by country",
                         {"quality": "silver"}, partition_by=("Country",))
    ds.write(files.people(spark, 60))
    t = ds.read(spark)
    assert t.count() == 60
    assert t.where("Country = 'UK'").count() == files.people(spark, 60).where(
        "Country = 'UK'").count()
    catalog.drop_schema(spark, "lk_part", cascade=True)


def test_shuffle_hash_join_and_partitioned_stream_append(spark, scratch):
    o = spark.read.parquet(f"{SF001}/orders.parquet")
    c = spark.read.parquet(f"{SF001}/customer.parquet") \
        .withColumnRenamed("c_custkey", "o_custkey")
    sh = joins.join(o, c, "o_custkey", strategy="shuffle_hash")
    assert joins.join_strategy(sh) == "ShuffledHashJoin"
    assert sh.count() == o.count()
    landing, target = scratch("land"), scratch("t")
    files.write_csv_files(files.people(spark, 40), landing, files=2)
    stream = files.stream_csv(spark, landing)
    q = ingest.start_append(stream, target, scratch("ck"), partition_by="Country")
    q.awaitTermination()
    got = spark.read.parquet(target)
    assert got.count() == 40 and "Country" in got.columns


def test_broadcast_bound_runs_no_job(spark):
    c = spark.read.parquet(f"{SF001}/customer.parquet")
    group = "broadcast-bound"
    spark.sparkContext.setJobGroup(group, group)
    try:
        assert joins.fits_broadcast(c)
        assert not joins.fits_broadcast(c, max_bytes=10)
        joins.join(c, c.select("c_custkey"), "c_custkey", strategy="broadcast")
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
