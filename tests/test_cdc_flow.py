"""The bronze → silver → gold pipeline: re-runs, new files, deletes, report."""

import json

import pytest

from lakeshore.operators import eventlog
from lakeshore.plans.cdc_flow import CdcFlow
from lakeshore.sources import files

SCHEMA = ("customer_id long, first_name string, city string, operation string, "
          "ModifiedDate timestamp_ntz")


def _rows(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_cdc_flow_reruns_and_updates(spark, scratch):
    import datetime as dt

    t = [dt.datetime(2024, 1, d) for d in range(1, 6)]
    landing = scratch("landing")
    first = [(1, "ann", "oslo", "INSERT", t[0]), (2, "bob", "rome", "INSERT", t[0]),
             (1, "ann", "bern", "UPDATE", t[2]), (3, "cy", "nice", "INSERT", t[1])]
    files.write_csv_files(_rows(spark, first), landing, files=2)
    p = CdcFlow(scratch("cdc"), _rows(spark, first).schema, keys=["customer_id"],
                    sequence_by="ModifiedDate", apply_as_deletes="operation = 'DELETE'",
                    except_columns=["operation"], compact_every=2, prefix="customer",
                    log_compact_after=8)
    p.run(spark, landing)
    gold = {(r.customer_id, r.city) for r in p.gold(spark).collect()}
    assert gold == {(1, "bern"), (2, "rome"), (3, "nice")}
    # a re-run with no new file changes nothing
    p.run(spark, landing)
    assert {(r.customer_id, r.city) for r in p.gold(spark).collect()} == gold
    # late and delete rows arrive
    files.write_csv_files(_rows(spark, [(2, None, None, "DELETE", t[3]),
                                        (1, "ann", "graz", "UPDATE", t[1])]), landing, files=1)
    p.run(spark, landing)
    assert {(r.customer_id, r.city) for r in p.gold(spark).collect()} == {(1, "bern"), (3, "nice")}
    hist = p.scd2.table(spark)
    assert hist.where("customer_id = 1").count() == 3
    assert p.scd1.table(spark).count() == 2
    rep = p.report(spark).collect()
    assert len(rep) == 3  # one gold flow event per run
    last = max(rep, key=lambda r: r.timestamp)
    assert (last.output_records, last.dropped_records) == ("2", "3")
    p.register_views(spark)
    assert spark.sql("SELECT count(*) FROM customer_silver_scd_type_2").first()[0] == 5
    assert spark.sql("SELECT count(*) FROM customer_bronze").first()[0] == 6

    from lakeshore.sinks import catalog

    p.register_views(spark, schema="lk_pipe")
    assert catalog.table_properties(spark, "lk_pipe.customer_gold_scd_type_2")["quality"] == "gold"
    assert spark.table("lk_pipe.customer_silver_scd_type_1").count() == 2
    catalog.drop_schema(spark, "lk_pipe", cascade=True)


def test_bronze_expectations_on_the_stream(spark, scratch):
    import datetime as dt

    t = dt.datetime(2024, 1, 1)
    rows = [(1, "ann", "oslo", "INSERT", t), (None, "x", "nowhere", "INSERT", t),
            (2, "bob", "rome", "INSERT", t)]
    landing = scratch("landing")
    files.write_csv_files(_rows(spark, rows), landing, files=2)
    p = CdcFlow(scratch("cdc"), _rows(spark, rows).schema, keys=["customer_id"],
                sequence_by="ModifiedDate", apply_as_deletes="operation = 'DELETE'",
                except_columns=["operation"], prefix="c2", max_files=1,
                bronze_rules={"valid_id": "customer_id IS NOT NULL"})
    p.run(spark, landing)
    assert spark.read.parquet(p.bronze.path).count() == 2
    rep = {r.expectations.dataset: r for r in p.report(spark).collect()}
    silver = {r["message"].split("'")[1]: json.loads(r["details"])["flow_progress"]
              for r in eventlog.read_log(spark, p.log_path).collect()}
    assert silver["c2_silver_scd1"]["metrics"]["num_output_rows"] == p.silver(spark, 1).count()
    assert silver["c2_silver_scd2"]["metrics"]["num_output_rows"] == p.silver(spark, 2).count()
    b = rep["c2_bronze"]
    assert (b.expectations.passed_records, b.expectations.failed_records) == (2, 1)
    assert (b.output_records, b.dropped_records) == ("2", "1")
    assert {r.customer_id for r in p.gold(spark).collect()} == {1, 2}


def test_counts_of_more_batches_than_progress_keeps(spark, scratch):
    """Six micro-batches with a progress buffer of two; quarantined rows are
    dropped records; a failing step leaves an event."""
    import datetime as dt

    t = dt.datetime(2024, 1, 1)
    rows = [(k if k % 10 else None, f"n{k}", "oslo", "INSERT", t) for k in range(120)]
    landing = scratch("landing")
    files.write_csv_files(_rows(spark, rows).repartition(6), landing, files=6)
    p = CdcFlow(scratch("cdc"), _rows(spark, rows).schema, keys=["customer_id"],
                sequence_by="ModifiedDate", prefix="c3", max_files=1,
                bronze_rules={"odd": "customer_id IS NULL OR customer_id % 2 = 1"})
    old = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates", "100")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        p.run(spark, landing)
        p.run(spark, landing)
        p.run(spark, landing)
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", old)
    from lakeshore.sinks import versioned

    log = [(r["message"].split("'")[1], json.loads(r["details"])["flow_progress"])
           for r in eventlog.ordered_log(eventlog.read_log(spark, p.log_path)).collect()]
    bronze = [d for n, d in log if n == "c3_bronze"][0]
    kept = spark.read.parquet(p.bronze.path).count()
    assert (bronze["metrics"]["num_output_rows"], bronze["data_quality"]["dropped_records"]) == (kept, 120 - kept)
    silver = [d for n, d in log if n == "c3_silver_scd2"][0]
    assert silver["metrics"]["num_output_rows"] == p.silver(spark, 2).count() == 60
    assert silver["data_quality"]["dropped_records"] == 12  # null keys
    assert len(versioned.versions(spark, p.gold_base)) == 2  # older ones are removed
    assert eventlog.read_log(spark, p.log_path).where("sequence IS NULL").count() == 0
    with pytest.raises(Exception):
        p.run(spark, scratch("no such folder"))
    last = eventlog.read_log(spark, p.log_path).orderBy("sequence").collect()[-1]
    assert json.loads(last["details"])["flow_progress"]["status"] == "FAILED" and last["level"] == "ERROR"
