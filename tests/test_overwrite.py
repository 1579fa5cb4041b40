"""replace_where in its three forms, versioned tables and partition replacement."""

import pytest
from pyspark.sql import functions as F

from lakeshore.sinks import overwrite, versioned

SCHEMA = "id long, p string, v long"


@pytest.fixture()
def existing(spark):
    return spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, "b", 3), (4, None, 4)], SCHEMA)


def _set(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_replace_where_semantics(spark, existing):
    incoming = spark.createDataFrame([(9, "a", 9)], SCHEMA)
    out = overwrite.replace_where(existing, incoming, "p = 'a'")
    assert _set(out) == _set(spark.createDataFrame(
        [(3, "b", 3), (4, None, 4), (9, "a", 9)], SCHEMA))
    # idempotent
    again = overwrite.replace_where(out, incoming, "p = 'a'")
    assert _set(again) == _set(out)


def test_empty_incoming_deletes(spark, existing):
    out = overwrite.replace_where(existing, spark.createDataFrame([], SCHEMA), "p = 'a'")
    assert sorted(r.id for r in out.collect()) == [3, 4]


def test_incoming_outside_predicate_fails(spark, existing):
    bad = spark.createDataFrame([(9, "b", 9)], SCHEMA)
    with pytest.raises(Exception, match="does not satisfy"):
        overwrite.replace_where(existing, bad, "p = 'a'").collect()


def test_versioned_write_and_failed_version_ignored(spark, existing, scratch):
    base = scratch("tbl")
    p1 = versioned.write_version(existing, base, table="vt")
    assert spark.table("vt").count() == 4
    # a folder without _SUCCESS (a crashed write) is ignored
    spark.range(1).write.parquet(versioned.version_path(base, 2))
    fs, p = versioned._fs(spark, versioned.version_path(base, 2) + "/_SUCCESS")
    fs.delete(p, False)
    assert versioned.current_path(spark, base) == p1
    incoming = spark.createDataFrame([(9, "a", 9)], SCHEMA)
    p3 = overwrite.replace_where_version(base, incoming, "p = 'a'", table="vt")
    assert p3.endswith("v00000003")
    assert sorted(r.id for r in spark.table("vt").collect()) == [3, 4, 9]
    # schema change on the same table is visible at once
    wider = versioned.read_current(spark, base).withColumn("w", F.lit(1))
    versioned.write_version(wider, base, table="vt")
    assert "w" in spark.table("vt").columns
    assert versioned.remove_old_versions(spark, base, keep=1)
    assert versioned.versions(spark, base) == [4]


def test_partition_replacement(spark, existing, scratch):
    path = scratch("parts")
    existing.write.partitionBy("p").parquet(path)
    incoming = spark.createDataFrame([(9, "a", 9)], SCHEMA)
    emptied = overwrite.replace_where_partitions(path, incoming, "p IN ('a', 'b')", "p")
    assert emptied == [{"p": "b"}]
    got = spark.read.parquet(path).select("id", "p", "v")
    assert sorted(r.id for r in got.collect()) == [4, 9]


def test_partition_replacement_escaped_values(spark, scratch):
    path = scratch("parts2")
    rows = [(1, "a/b", 1), (2, "c:d", 2), (3, "é x", 3), (4, None, 4), (5, "keep", 5)]
    spark.createDataFrame(rows, SCHEMA).write.partitionBy("p").parquet(path)
    incoming = spark.createDataFrame([(9, "c:d", 9)], SCHEMA)
    emptied = overwrite.replace_where_partitions(
        path, incoming, "p IN ('a/b', 'c:d', 'é x') OR p IS NULL", "p")
    assert sorted(e["p"] or "" for e in emptied) == ["", "a/b", "é x"]
    got = spark.read.parquet(path)
    assert sorted(r.id for r in got.collect()) == [5, 9]


def test_partition_replacement_int_partitions(spark, scratch):
    path = scratch("parts3")
    spark.range(20).selectExpr("id", "CAST(id % 4 AS INT) AS b") \
        .write.partitionBy("b").parquet(path)
    inc = spark.range(100, 103).selectExpr("id", "1 AS b")
    emptied = overwrite.replace_where_partitions(path, inc, "b <= 1", "b")
    assert emptied == [{"b": 0}]
    got = spark.read.parquet(path)
    assert got.where("b = 1").count() == 3 and got.count() == 3 + 10


def test_register_current_and_partitioned_version(spark, existing, scratch):
    base = scratch("pv")
    versioned.write_version(existing, base, partition_by="p")
    incoming = spark.createDataFrame([(9, "a", 9)], SCHEMA)
    overwrite.replace_where_version(base, incoming, "p = 'a'", partition_by="p")
    path = versioned.register_current(spark, "pv_current", base)
    assert path.endswith("v00000002")
    assert sorted(r.id for r in spark.table("pv_current").collect()) == [3, 4, 9]


@pytest.mark.parametrize("values", [("2023", "2024", "2025"), ("007", "7", "x1")])
def test_partition_replacement_of_digit_like_text(spark, scratch, values):
    """Partition values that Spark reads back as numbers: the rows written stay, the
    partition without rows goes, the others are left alone."""
    first, second, third = values
    path = scratch("digits")
    schema = "id string, year string"
    spark.createDataFrame([("1", first), ("2", second), ("3", third)], schema) \
        .write.partitionBy("year").parquet(path)
    incoming = spark.createDataFrame([("9", second)], schema)
    emptied = overwrite.replace_where_partitions(
        path, incoming, F.col("year").isin(first, second), "year")
    assert emptied == [{"year": first}]
    got = spark.read.option("basePath", path).schema(schema).parquet(path)
    assert sorted(map(tuple, got.collect())) == sorted([("9", second), ("3", third)])


def test_dataset_overwrite_of_itself(spark, scratch):
    from lakeshore.sinks.catalog import Dataset

    d = Dataset("lk_self", scratch("self"))
    d.write(spark.range(10))
    d.write(d.read(spark).where("id < 4"), mode="overwrite")
    assert sorted(r.id for r in d.read(spark).collect()) == [0, 1, 2, 3]
    with pytest.raises(Exception):  # a failing write leaves what was there
        d.write(d.read(spark).where(F.raise_error(F.lit("no")).isNull()), mode="overwrite")
    assert d.read(spark).count() == 4
    spark.sql("DROP TABLE lk_self")


def test_replace_keeps_metadata_and_refuses_clear_rows(spark, existing, scratch):
    base = scratch("meta")
    versioned.write_version(existing, base, meta={"encrypted": ["v"]})
    incoming = spark.createDataFrame([(9, "a", 9)], SCHEMA)
    with pytest.raises(ValueError, match="encrypted"):
        overwrite.replace_where_version(base, incoming, "p = 'a'")
    overwrite.replace_where_version(base, incoming, "p = 'a'", encrypted=True)
    assert versioned.read_meta(spark, base) == {"encrypted": ["v"]}


def test_check_sees_only_rows_that_filters_leave(spark, scratch):
    """A row that the incoming rows' own filter drops is not checked."""
    path = scratch("in")
    spark.createDataFrame([(1, 1, "a"), (2, None, "b"), (1, 3, "c")], "p int, s int, v string").coalesce(1).write.parquet(path)
    incoming = spark.read.parquet(path).where("s is not null")
    existing = spark.createDataFrame([(1, 0, "old"), (2, 0, "kept")], "p int, s int, v string")
    out = overwrite.replace_where(existing, incoming, "p = 1")
    assert sorted(r["v"] for r in out.collect()) == ["a", "c", "kept"]
    with pytest.raises(Exception, match="does not satisfy"):
        overwrite.replace_where(existing, spark.read.parquet(path), "p = 1").collect()


def test_columns_that_the_table_lacks_are_refused(spark, scratch):
    path = scratch("t")
    spark.createDataFrame([(1, "A")], "id int, c string").write.partitionBy("c").parquet(path)
    with pytest.raises(ValueError, match="no columns"):
        overwrite.replace_where_partitions(path, spark.createDataFrame([(2, "x", "A")], "id int, w string, c string"), "c = 'A'", "c")
