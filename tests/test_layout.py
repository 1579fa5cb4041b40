"""Layouts: sizes by volume, bucketed joins without an exchange, skipping; sketches;
replayed files; drops."""

import os

import pytest
from pyspark.sql import functions as F

from lakeshore.operators import privacy, sketches
from lakeshore.plans import queries
from lakeshore.sinks import layout
from lakeshore.streaming import ingest

from conftest import SF001


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def files_of(path):
    path = path.removeprefix("file:")
    return {d: sum(f.endswith(".parquet") for f in os.listdir(f"{path}/{d}"))
            for d in os.listdir(path) if "=" in d}


def test_one_giant_value_gives_several_files_and_small_ones_share_tasks(spark, scratch):
    rows = spark.range(60000).select(
        F.when(F.col("id") < 50000, F.lit(0)).otherwise(F.col("id") % 1000).alias("p"),
        F.sha2(F.col("id").cast("string"), 256).alias("x"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        path = scratch()
        layout.write_rebalanced(rows.repartition(8), path, "p")
        found = files_of(path)
        assert found["p=0"] >= 4  # some 3.5 MB
        tasks = sum(found.values()) - found["p=0"]
        assert len(found) == 1000 and tasks <= 1100  # a thousand small values: hardly more files than values
        assert layout.rebalanced(rows, "p").rdd.getNumPartitions() < 50
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert spark.read.parquet(path).count() == 60000


def test_a_hot_key_is_written_by_several_tasks_into_its_bucket(spark, scratch):
    hot = "if(id % 3 = 0, 7L, id) AS k"
    rows = spark.range(60000, numPartitions=8).selectExpr(hot, "sha2(cast(id as string), 256) AS x")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    t = layout.Bucketed(f"hot_{os.getpid()}", scratch(), "k", 4)
    try:
        t.write(rows)
        files = [f for f in os.listdir(t.path.removeprefix("file:")) if f.endswith(".parquet")]
        assert len(files) > 4
        got, one = t.read(spark), spark.range(60000).withColumnRenamed("id", "k")
        assert got.count() == 60000 and got.exceptAll(rows).count() == 0
        assert "Exchange" not in plan(got.groupBy("k").count())  # still by buckets
        assert got.join(one, "k").count() == 60000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.sql(f"DROP TABLE IF EXISTS {t.name}")


def test_bucketed_tables_join_without_an_exchange(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cust, keys = queries.bucketed_customers(spark, SF001)
        enc = privacy.encrypt_columns(cust, keys, "c_custkey", ["c_name"])
        assert "SortMergeJoin" in plan(enc) and "Exchange" not in plan(enc)
        assert enc.count() == cust.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lookup_skips_row_groups(spark, scratch):
    rows = spark.range(400000).select((F.col("id") % 5000).alias("k"), "id", F.sha2(F.col("id").cast("string"), 256).alias("x"))
    path = scratch()
    layout.write_clustered(rows, path, "k", "id", row_group=1 << 18)
    one = spark.read.parquet(path).where("k = 77")
    assert one.count() == 80
    assert layout.scanned_rows(one) <= 40000 < layout.scanned_rows(spark.read.parquet(path))
    absent = spark.read.parquet(path).where("k = 100000")
    assert layout.scanned_rows(absent) == 0


def test_lookup_by_bloom_filter(spark, scratch):
    """Keys that a range does not rule out but the filter does."""
    rows = spark.range(100000).select((F.col("id") * 2).cast("string").alias("k"), "id")
    path = scratch()
    layout.write_clustered(rows, path, "k")
    assert layout.scanned_rows(spark.read.parquet(path).where("k = '50001'")) == 0


def test_sketches_merge_and_need_no_distinct_exchange(spark):
    rows = spark.range(50000).select((F.col("id") % 2).alias("g"), (F.col("id") % 9000).alias("v"))
    rows = rows.unionByName(spark.createDataFrame([(0, None), (1, None), (5, None)], "g long, v long"))
    stored = sketches.distinct_sketches(rows.where("v < 4000"), "v", "g")
    both = sketches.append_sketches(stored, sketches.distinct_sketches(rows.where("v >= 4000 or v is null"), "v", "g"))
    got = {r["g"]: r["n_distinct"] for r in sketches.distinct_estimate(both, "g").collect()}
    assert got[5] == 1  # null is a value
    assert abs(got[0] - 4501) < 4 * sketches.ERROR * 4501 and abs(got[1] - 4501) < 4 * sketches.ERROR * 4501
    total = sketches.distinct_estimate(both).first()[0]
    assert abs(total - 9001) < 4 * sketches.ERROR * 9001
    shape = plan(sketches.distinct_sketches(rows, "v", "g"))
    assert shape.count("Exchange hashpartitioning(g") == 1 and "hashpartitioning(v" not in shape


def test_files_landed_twice_across_a_restart(spark, scratch):
    source, target, ckpt = scratch("in"), scratch("out"), scratch("ckpt")
    rows = spark.createDataFrame([(i, f"v{i}") for i in range(50)], "id int, v string")
    for _ in range(2):
        rows.write.mode("append").parquet(source)  # the same rows under new names
        stream = spark.readStream.schema(rows.schema).parquet(source)
        ingest.start_append(ingest.once_within(stream, ["id"]), target, ckpt).awaitTermination()
        assert spark.read.parquet(target).count() == 50


@pytest.mark.parametrize("name", ["drops", "new_keys"])
def test_small_catalog_queries(spark, name):
    row = queries.QUERIES[name](spark, SF001).first().asDict()
    n = spark.read.parquet(f"{SF001}/customer.parquet").count()
    assert row in ({"n_rows": n, "n_left": 0, "n_schemas": 0}, {"n": n, "n_keys": n, "least_bytes": 32})
