"""CSV by header: order, missing and extra columns, rescue, schema growth, replay."""

import json
import os

import pytest
from pyspark.sql import functions as F

from lakeshore.sinks import overwrite
from lakeshore.sources import files, headers
from lakeshore.streaming import ingest
from lakeshore.streaming.cdc_stream import ChangeApply


def land(path, **contents):
    os.makedirs(path, exist_ok=True)
    for name, text in contents.items():
        with open(f"{path}/{name}.csv", "w") as f:
            f.write(text)


@pytest.fixture()
def mixed(tmp_path):
    d = str(tmp_path / "a [b] %20")
    land(d, a="id,name,city\n1,ann,paris\n2,bob,rome\n", b="\nid,Name,city,w\n3,cid,lima,x\nq,dan,bern,\n",
         c="id,city,name\n4,berlin,max\n5,oslo\n6,bonn,eva,zzz\n", e="")
    with open(f"{d}/f 1.csv", "w") as f:
        f.write("﻿city,id,id,\nulm,7,70,q\n")
    return d


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_each_file_by_its_own_header(spark, mixed):
    df = headers.read_by_header(spark, headers._literal(mixed), "id int, name string, city string")
    got = {(r["id"], r["name"], r["city"]): json.loads(r[headers.RESCUED] or "{}") for r in df.collect()}
    assert got[(1, "ann", "paris")] == got[(4, "max", "berlin")] == {}  # not swapped
    assert got[(3, "cid", "lima")]["w"] == "x" and "_file_path" in got[(3, "cid", "lima")]
    assert got[(None, "dan", "bern")]["id"] == "q"  # no number, kept as text
    assert got[(6, "eva", "bonn")]["_raw"] == "6,bonn,eva,zzz"
    assert got[(5, None, "oslo")]["_raw"] == "5,oslo"
    again = got[(7, None, "ulm")]  # a repeated and a nameless column
    assert again["id#2"] == "70" and again["#3"] == "q"
    assert len(got) == 8


def test_without_a_schema_all_columns_come(spark, mixed):
    df = files.read_csv(spark, headers._literal(mixed))
    assert df.columns[:3] == ["id", "name", "city"] and {"w"} <= set(df.columns)
    assert {t for _, t in df.dtypes} == {"string"}
    assert rows(df.where("id = '4'"), "name", "city", "w") == [("max", "berlin", None)]
    assert files.capture_schema(spark, headers._literal(mixed)).names == df.columns


def test_policies(spark, mixed):
    path = headers._literal(mixed)
    added = headers.read_by_header(spark, path, "id int, name string, city string", rescue=None)
    assert added.columns[:4] == ["id", "name", "city", "w"]
    with pytest.raises(ValueError, match="not in the schema"):
        headers.read_by_header(spark, path, "id int", unknown="fail")
    with pytest.raises(ValueError):
        headers.read_by_header(spark, path, "id int", rescue=None, unknown="rescue")


def test_nothing_to_read(spark, tmp_path):
    land(str(tmp_path), e="")
    df = headers.read_by_header(spark, str(tmp_path), "id int")
    assert df.columns == ["id", headers.RESCUED] and df.count() == 0


def test_values_only_in_needed_columns(spark, mixed):
    """Column pruning must not move values."""
    df = files.read_csv(spark, headers._literal(mixed))
    assert rows(df.where("city = 'berlin'"), "name") == [("max",)]


def test_plain_stream_refuses_another_header(spark, tmp_path, scratch):
    land(str(tmp_path / "in"), a="id,name\n1,x\n", b="name,id\ny,2\n")
    stream = files.stream_csv(spark, str(tmp_path / "in"), schema="id string, name string")
    q = ingest.start_append(stream, scratch(), scratch())
    with pytest.raises(Exception):
        q.awaitTermination()
        raise q.exception()


def test_stream_grows_rescues_and_restarts(spark, tmp_path, scratch):
    source, target, ckpt = str(tmp_path / "in"), scratch("bronze"), scratch("ckpt")
    land(source, a="id,name\n1,x\n")
    ingest.ingest_csv(spark, source, target, ckpt, table="grown")
    assert spark.table("grown").columns == ["id", "name"]
    land(source, b="name,extra,id\ny,e,2\n", c="id\n3\n")
    ingest.ingest_csv(spark, source, target, ckpt, max_files=1, table="grown")
    ingest.ingest_csv(spark, source, target, ckpt, table="grown")  # nothing new
    assert rows(spark.table("grown"), "id", "name", "extra") == [("1", "x", None), ("2", "y", "e"), ("3", None, None)]
    log = ingest.HeaderIngest(source, target, ckpt)._log(spark)
    assert len(log) == 2  # two schemas, in order


def test_replayed_batch_replaces_itself(spark, tmp_path, scratch):
    source, target, ckpt = str(tmp_path / "in"), scratch("bronze"), scratch("ckpt")
    land(source, a="id,name\n1,x\n2,y\n")
    job = ingest.HeaderIngest(source, target, ckpt, rescue=headers.RESCUED)
    q = job.start(spark)
    q.awaitTermination()
    listing = spark.createDataFrame([(f"file:{source}/a.csv",)], "path string")
    job._apply(listing, 0)  # the same batch runs again
    assert ingest.ingested(spark, target).count() == 2
    other = ingest.HeaderIngest(source, target, scratch("ckpt2"))  # a new checkpoint is another writer
    other.start(spark).awaitTermination()
    assert ingest.ingested(spark, target).count() == 4


# -- the two other silent losses -----------------------------------------------

def test_empty_text_never_replaces_the_null_partition(spark, scratch):
    path = scratch("parts")
    spark.createDataFrame([(1, None), (2, "A"), (3, None)], "id int, c string").write.partitionBy("c").parquet(path)
    incoming = spark.createDataFrame([(9, "")], "id int, c string")
    with pytest.raises(Exception, match="empty text"):
        overwrite.replace_where_partitions(path, incoming, "c = ''", "c")
    assert rows(spark.read.parquet(path), "id", "c") == [(1, None), (2, "A"), (3, None)]
    nulls = spark.createDataFrame([(9, None)], "id int, c string")
    overwrite.replace_where_partitions(path, nulls, "c IS NULL", "c")
    assert rows(spark.read.parquet(path), "id", "c") == [(2, "A"), (9, None)]


@pytest.mark.parametrize("scd_type", [1, 2])
@pytest.mark.parametrize("compact_every", [0, 2])
def test_feed_with_a_new_column(spark, scratch, scd_type, compact_every):
    path = scratch("state")
    make = lambda: ChangeApply(path, "k", "s", scd_type, compact_every=compact_every)
    first, second, third = make(), make(), make()
    first.apply_batch(spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "k int, s int, v string"), 0)
    second.apply_batch(spark.createDataFrame([(1, 2, "c", "w1")], "k int, s int, v string, w string"), 0)
    third.apply_batch(spark.createDataFrame([(3, 1, "d")], "k int, s int, v string"), 0)
    got = make().table(spark)
    assert got.columns[:4] == ["k", "s", "v", "w"]
    want = {(1, 2, "c", "w1"), (2, 1, "b", None), (3, 1, "d", None)} | ({(1, 1, "a", None)} if scd_type == 2 else set())
    assert {tuple(r)[:4] for r in got.collect()} == want
    with pytest.raises(ValueError, match="was string and now is int"):
        make().apply_batch(spark.createDataFrame([(1, 2, 3)], "k int, s int, v int"), 1)
    assert got.where(F.col("k") == 1).count() == (1 if scd_type == 1 else 2)
