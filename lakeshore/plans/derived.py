"""Datasets derived from the driver's tables that stand in for the reference's
inputs (see FIXTURES.md): the change feeds, the event log, the quality rules.

Everything here is lazy DataFrame code over the given tables, so its work
grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshore.operators import cdc, eventlog, quality
from lakeshore.plans import cdc_flow
from lakeshore.sources import files
from lakeshore.sources.tables import table

# Fixed stand-in mapping of the change feeds.
EVENTS_FEED = dict(keys=["user_id"], sequence_by=["ts"],
                   apply_as_deletes="event_type = 'error'", except_columns=["event_type"])
ORDERS_FEED = dict(keys=["o_custkey"], sequence_by=["o_orderdate", "o_orderkey"],
                   apply_as_deletes="o_orderstatus = 'F'", except_columns=["o_orderstatus"])

# Fixed stand-in quality rules on lineitem, per dataset l_returnflag.
LINEITEM_RULES = {"valid_discount": "l_discount <= 0.05", "positive_quantity": "l_quantity > 0"}

# The clean step of the flow: keep open versions only (same fixed values as
# cdc_flow.RECENT_RECORD).
RECENT_RECORD = cdc_flow.RECENT_RECORD


def events_history(spark: SparkSession, data_dir: str, **kwargs) -> DataFrame:
    return cdc.apply_changes(table(spark, data_dir, "events"), scd_type=2,
                             **EVENTS_FEED, **kwargs)


def events_current(spark: SparkSession, data_dir: str) -> DataFrame:
    return cdc.apply_changes(table(spark, data_dir, "events"), scd_type=1, **EVENTS_FEED)


def orders_history(spark: SparkSession, data_dir: str) -> DataFrame:
    return cdc.apply_changes(table(spark, data_dir, "orders"), scd_type=2, **ORDERS_FEED)


def events_as_log(events: DataFrame) -> DataFrame:
    """Shape ``events`` as a pipeline event log (stand-in, FIXTURES.md):
    id = event_id, timestamp = ts, details from the props value k.

    ``k`` is parsed in its own projection, which the optimizer keeps (it is
    used several times), so the JSON text is read once per row."""
    base = events.select(
        "event_id", "ts", "event_type",
        F.get_json_object("props", "$.k").cast("long").alias("k"),
        F.when(F.col("event_type").isin("purchase", "click"), F.lit("COMPLETED"))
        .otherwise(F.lit("RUNNING")).alias("status"))
    k, status = F.col("k"), F.col("status")
    dataset = F.concat(F.lit("silver_"), F.col("event_type"))
    exp = F.when(F.col("event_type") != F.lit("click"), F.array(
        F.struct(dataset.alias("dataset"), (k % 7).alias("failed_records"),
                 F.lit("valid_value").alias("name"), k.alias("passed_records")),
        F.struct(dataset.alias("dataset"), F.lit(0).cast("long").alias("failed_records"),
                 F.lit("valid_user").alias("name"), (k * 2).alias("passed_records"))))
    return base.select(
        F.col("event_id").cast("string").alias("id"),
        F.col("ts").alias("timestamp"),
        F.col("event_id").cast("string").alias("sequence"),
        F.lit("flow_progress").alias("event_type"),
        F.concat(F.lit("Flow "), F.col("event_type"), F.lit(" is "), status).alias("message"),
        F.when(F.col("event_type") == "error", F.lit("ERROR")).otherwise(F.lit("INFO"))
        .alias("level"),
        eventlog.details_json(status, k, k % 7, exp).alias("details"))


def land_mixed_headers(spark: SparkSession, data_dir: str, path: str) -> None:
    """Customers as CSV files of three kinds: as they are, with the columns in another
    order and without the balance, and with one more column and nations that are no
    numbers."""
    cust = table(spark, data_dir, "customer")
    kind = lambda n: cust.where(F.pmod("c_custkey", F.lit(3)) == n)
    for part in (kind(0), kind(1).select("c_mktsegment", "c_name", "c_custkey", "c_nationkey"),
                 kind(2).withColumn("c_nationkey", F.concat(F.lit("n"), "c_nationkey"))
                 .withColumn("c_note", F.concat("c_name", F.lit("!")))):
        files.write_csv_files(part, path, files=2, by="c_custkey")


def clean_and_gold(history: DataFrame):
    """The clean view and gold table of the pipeline: expect_or_drop
    ``__END_AT IS NULL`` over the SCD 2 history (C4, Q1), with its counts."""
    name, pred = RECENT_RECORD
    return quality.expect_or_drop(history, name, pred, dataset="gold")
