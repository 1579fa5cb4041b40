"""Expectations, observed counts, event log and the expectation report."""

import pytest
from pyspark.sql import functions as F

from lakeshore.operators import eventlog, quality


@pytest.fixture()
def rows(spark):
    return spark.createDataFrame([(1, 0.01), (2, 0.09), (3, None), (4, 0.05)],
                                 "id long, d double")


def test_drop_counts_null_as_failed(rows):
    kept, obs = quality.expect_or_drop(rows, "low", "d <= 0.05", dataset="t")
    assert sorted(r.id for r in kept.collect()) == [1, 4]
    got = obs.get
    assert got["passed:low"] == 2 and got["failed:low"] == 2
    assert got["input_rows"] == 4 and got["output_rows"] == 2


def test_warn_keeps_rows(rows):
    out, obs = quality.expect(rows, {"low": "d <= 0.05", "has_id": "id IS NOT NULL"},
                              action="warn")
    assert out.count() == 4
    recs = quality.observed_expectations(obs, {"low": "d <= 0.05",
                                               "has_id": "id IS NOT NULL"}, "t")
    assert {(r["name"], r["passed_records"], r["failed_records"]) for r in recs} == \
        {("low", 2, 2), ("has_id", 4, 0)}


def test_fail_raises(rows):
    out, _ = quality.expect(rows, {"low": "d <= 0.05"}, action="fail")
    with pytest.raises(Exception, match="expectation failed"):
        out.collect()


def test_passed_plus_failed_is_input(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    counts = quality.quality_counts(li, {"a": "l_discount <= 0.05", "b": "l_tax > 0.02"},
                                    dataset_col="l_returnflag")
    per = counts.groupBy("name").agg(F.sum(F.col("passed_records") + F.col("failed_records"))
                                     .alias("n")).collect()
    assert {r["n"] for r in per} == {li.count()}


def test_flow_event_roundtrip_report(spark, scratch):
    log = scratch("log")
    exps = [{"dataset": "gold", "name": "recent", "passed_records": 7, "failed_records": 3}]
    eventlog.append_events(eventlog.flow_event(spark, "gold", "COMPLETED", 7, 3, exps), log)
    eventlog.append_events(eventlog.flow_event(spark, "gold", "RUNNING", 0), log)
    eventlog.append_events(eventlog.flow_event(spark, "other", "COMPLETED", 5), log)
    full = eventlog.read_log(spark, log)
    assert full.count() == 3
    rep = eventlog.expectation_report(full).collect()
    assert len(rep) == 1
    r = rep[0]
    assert (r.output_records, r.dropped_records, r.status_update) == ("7", "3", "COMPLETED")
    assert r.expectations.name == "recent" and r.expectations.failed_records == 3
    assert eventlog.ordered_log(full).columns == list(eventlog.LOG_COLUMNS)


def test_malformed_details_yield_no_row(spark):
    log = spark.createDataFrame([("1", None, None, "x", "m", "INFO", "{not json")],
                                "id string, timestamp timestamp, sequence string, "
                                "event_type string, message string, level string, "
                                "details string")
    assert eventlog.expectation_report(log).count() == 0


def test_json_path(spark):
    df = spark.createDataFrame([('{"a": {"b": 3}}',)], "j string")
    assert df.select(eventlog.json_path("j", "a.b")).first()[0] == "3"


def test_log_compaction(spark, scratch):
    log = scratch("log")
    for i in range(3):
        eventlog.append_events(eventlog.flow_event(spark, "d", "COMPLETED", i), log)
    assert eventlog.read_log(spark, log).count() == 3
    assert eventlog.compact_log(spark, log)
    assert eventlog._tail_parts(spark, log) == []
    eventlog.append_events(eventlog.flow_event(spark, "d", "COMPLETED", 9), log)
    assert eventlog.read_log(spark, log).count() == 4
    eventlog.compact_log(spark, log)
    got = sorted(int(r.o) for r in eventlog.read_log(spark, log).selectExpr(
        "get_json_object(details, '$.flow_progress.metrics.num_output_rows') AS o").collect())
    assert got == [0, 1, 2, 9]


def test_column_predicates_and_partition_helpers(spark, rows):
    from lakeshore.operators import partitioning

    kept, obs = quality.expect(rows, [("low", F.col("d") <= 0.05)], action="drop")
    assert kept.count() == 2 and obs.get["failed:low"] == 2
    r = partitioning.repartition_by_distinct(rows, "id", by_column=True)
    assert partitioning.num_partitions(r) == 4


def test_event_time_is_utc_whatever_the_zone(spark, monkeypatch):
    import datetime as dt
    import time

    from lakeshore.operators import eventlog

    at = dt.datetime(2024, 5, 1, 12, 30, tzinfo=dt.timezone.utc)
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        for value in (at, at.replace(tzinfo=None), at.astimezone(dt.timezone(dt.timedelta(hours=9)))):
            event = eventlog.flow_event(spark, "d", "COMPLETED", 1, timestamp=value)
            assert event.selectExpr("unix_micros(timestamp) AS t").first()["t"] == int(at.timestamp()) * 10**6
            assert event.first()["sequence"]
    finally:
        monkeypatch.undo()
        time.tzset()
