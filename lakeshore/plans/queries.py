"""The registered queries: one per operator group of the inventory, each a
function ``(spark, data_dir) -> DataFrame`` over the driver's tables, each with
an equivalent DuckDB SQL oracle (same column names) where SQL can say it.

Queries that write (files, streams, versions, keys) do so under a fresh folder
below the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshore.operators import eventlog, joins, keyed, partitioning, privacy, quality, sketches
from lakeshore.plans import cdc_flow, derived, privacy_flow
from lakeshore.session import scratch_name, scratch_path
from lakeshore.sinks import catalog, layout, overwrite, versioned
from lakeshore.sources import files, headers, idsource
from lakeshore.sources.tables import table
from lakeshore.streaming import cdc_stream, ingest, state_apply

Query = Callable[[SparkSession, str], DataFrame]


# -- CDC ---------------------------------------------------------------------

def q_scd2_history(spark, d):
    return derived.events_history(spark, d)


def q_scd1_current(spark, d):
    return derived.events_current(spark, d)


def q_scd2_composite(spark, d):
    return derived.orders_history(spark, d)


def q_gold_current(spark, d):
    gold, _ = derived.clean_and_gold(derived.events_history(spark, d))
    return gold


def q_current_between(spark, d):
    return derived.events_current(spark, d).where(F.col("value").between(10.0, 20.0))


#: A subject of the change feed, and a range of them.
_KEY, _KEYS = 7, (10, 20)


def q_history_point_lookup(spark, d):
    """One key's history: the key filter reaches the scan, and a lookup needs no
    sample for hot keys (C5)."""
    return derived.events_history(spark, d, rows_per_task=None).where(F.col("user_id") == _KEY)


def q_current_key_range(spark, d):
    """Gold rows of a range of keys, in order (F2 on the key, O1)."""
    history = derived.events_history(spark, d, rows_per_task=None)
    return (history.where(F.col("user_id").between(*_KEYS) & F.col("__END_AT").isNull())
            .orderBy("user_id"))


def q_clean_view(spark, d):
    """The clean step as a named view over the silver history (T5, K9)."""
    derived.events_history(spark, d).createOrReplaceTempView("events_silver_scd2")
    name, predicate = cdc_flow.RECENT_RECORD
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW events_clean AS "
              f"SELECT * FROM events_silver_scd2 WHERE {predicate}")
    return spark.table("events_clean")


def q_partition_lookup(spark, d):
    """Equality on the partition column of a ``partitionBy`` table: only the
    matching partition folder is read (F1, K2, partition pruning)."""
    cust = table(spark, d, "customer")
    path = scratch_path(spark, "customer-by-segment")
    cust.write.partitionBy("c_mktsegment").parquet(path)
    return spark.read.parquet(path).where(F.col("c_mktsegment") == "BUILDING") \
        .select(*cust.columns)


def _landed(spark, d, name, by, files_n=6) -> tuple[str, DataFrame]:
    """Land a table as parquet files in random key order for a stream."""
    src = table(spark, d, name)
    landing = scratch_path(spark, f"landing-{name}")
    src.repartition(files_n, F.col(by)).write.parquet(landing)
    return landing, src


def _stream_apply(spark, d, scd_type, name="events", by="event_id",
                  feed=derived.EVENTS_FEED) -> cdc_stream.ChangeApply:
    landing, src = _landed(spark, d, name, by)
    stream = spark.readStream.schema(src.schema).option("maxFilesPerTrigger", 2) \
        .parquet(landing)
    return cdc_stream.apply_changes_stream(
        stream, scratch_path(spark, f"{name}-scd{scd_type}-state"),
        scratch_path(spark, f"{name}-scd{scd_type}-ckpt"), scd_type=scd_type,
        compact_every=2, **feed)


def q_scd1_stream(spark, d):
    return _stream_apply(spark, d, 1).table(spark)


def q_scd2_stream(spark, d):
    return _stream_apply(spark, d, 2).table(spark)


def q_scd2_composite_stream(spark, d):
    return _stream_apply(spark, d, 2, "orders", "o_orderkey", derived.ORDERS_FEED).table(spark)


# -- quality and event log ---------------------------------------------------

def q_expect_or_drop(spark, d):
    li = table(spark, d, "lineitem")
    kept, _ = quality.expect_or_drop(li, "valid_discount", "l_discount <= 0.05",
                                     dataset="lineitem")
    return kept


def q_dq_metrics(spark, d):
    return quality.quality_counts(table(spark, d, "lineitem"), derived.LINEITEM_RULES,
                                  dataset_col="l_returnflag")


def q_event_log(spark, d):
    return eventlog.ordered_log(derived.events_as_log(table(spark, d, "events")))


def q_expectation_report(spark, d):
    rep = eventlog.expectation_report(derived.events_as_log(table(spark, d, "events")))
    return rep.select("id", "timestamp", "output_records", "dropped_records",
                      "status_update", "expectations.dataset", "expectations.name",
                      "expectations.passed_records", "expectations.failed_records")


def q_json_path(spark, d):
    ev = table(spark, d, "events")
    return ev.select("event_id", eventlog.json_path("props", "k").alias("k"))


def q_explode_json(spark, d):
    """``from_json`` of the props text into a map and ``explode`` of it: one
    row per (event, property); null or malformed text yields no row (X4, X5)."""
    ev = table(spark, d, "events")
    props = F.from_json("props", "map<string, bigint>")
    return ev.select("event_id", F.explode(props).alias("prop_key", "prop_value"))


def q_gold_quality_report(spark, d):
    """silver SCD 2 → clean (expect_or_drop) → gold, the flow event of the
    gold write appended to an event log, and the report read back from it."""
    history = derived.events_history(spark, d)
    gold, obs = derived.clean_and_gold(history)
    base = scratch_path(spark, "gold")
    versioned.write_version(gold, base)
    got = obs.get
    exps = quality.observed_expectations(obs, [derived.RECENT_RECORD], "gold")
    log_path = scratch_path(spark, "event-log")
    eventlog.append_events(eventlog.flow_event(spark, "gold", "COMPLETED",
                                               got["output_rows"],
                                               got["input_rows"] - got["output_rows"], exps),
                           log_path)
    rep = eventlog.expectation_report(eventlog.read_log(spark, log_path))
    return rep.select("output_records", "dropped_records", "status_update",
                      "expectations.dataset", "expectations.name",
                      "expectations.passed_records", "expectations.failed_records")


def q_expectation_report_sql(spark, d):
    derived.events_as_log(table(spark, d, "events")).createOrReplaceTempView("event_log_raw")
    rep = eventlog.expectation_report_sql(spark, "event_log_raw")
    return rep.select("id", "timestamp", "output_records", "dropped_records",
                      "status_update", "expectations.dataset", "expectations.name",
                      "expectations.passed_records", "expectations.failed_records")


def q_cdc_flow(spark, d):
    """The whole CDC flow over ``events`` landed as CSV files; returns gold."""
    ev = table(spark, d, "events")
    landing = scratch_path(spark, "landing-cdc")
    files.write_csv_files(ev, landing, files=6, by="event_id")
    p = cdc_flow.CdcFlow(scratch_path(spark, "cdc"), ev.schema,
                         prefix="events", max_files=3, **derived.EVENTS_FEED)
    p.run(spark, landing)
    return p.gold(spark)


# -- privacy -----------------------------------------------------------------

def q_pseudonymize(spark, d):
    return privacy.pseudonymize(table(spark, d, "customer"), "c_name")


def q_ordered_limit(spark, d):
    return q_pseudonymize(spark, d).orderBy("c_custkey").limit(5)


def _keys(spark, d) -> DataFrame:
    cust = table(spark, d, "customer")
    return privacy.store_keys(cust, "c_custkey", scratch_path(spark, "keys"))


def q_subject_keys(spark, d):
    keys = _keys(spark, d)
    return keys.select("c_custkey",
                       F.length(F.unbase64(privacy.KEY_COLUMN)).alias("key_bytes"))


def q_encrypt_roundtrip(spark, d):
    cust = table(spark, d, "customer")
    keys = _keys(spark, d)
    enc_path = scratch_path(spark, "customer-enc")
    privacy.encrypt_columns(cust, keys, "c_custkey", ["c_name"]).write.parquet(enc_path)
    enc = spark.read.parquet(enc_path)
    return privacy.decrypt_columns(enc, keys, "c_custkey", ["c_name"])


def q_encrypt_hides(spark, d):
    cust = table(spark, d, "customer")
    keys = _keys(spark, d)
    enc = privacy.encrypt_columns(cust, keys, "c_custkey", ["c_name"]) \
        .select("c_custkey", F.col("c_name").alias("cipher"))
    both = enc.join(cust.select("c_custkey", "c_name"), "c_custkey")
    return both.agg(
        F.sum(F.when(F.col("cipher") == F.col("c_name"), 1).otherwise(0)).cast("long")
        .alias("n_same"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("cipher").alias("n_distinct_cipher"))


def q_admin_view(spark, d):
    """The whole privacy flow over ``customer``: pseudonym, keys, encrypted
    table version, decrypting admin view; returns the admin view."""
    out = privacy_flow.protect(spark, table(spark, d, "customer"),
                               scratch_path(spark, "gdpr"), "customer_protected",
                               "c_custkey", ["c_name"], pseudonym_of="c_name")
    return spark.table(out.clear_view)


def q_persistent_admin_view(spark, d):
    """The catalog route: a schema, external tables over the encrypted files and
    the keys, a stored function and a stored decrypting view (K6-K8, K10, G7, U4)."""
    cust = table(spark, d, "customer")
    schema = scratch_name(spark, "lk", "SCHEMA")
    catalog.create_schema(spark, schema)
    keys_path, data_path = scratch_path(spark, "keys"), scratch_path(spark, "customer-enc")
    keys = privacy.store_keys(cust, "c_custkey", keys_path)
    privacy.encrypt_columns(cust, keys, "c_custkey", ["c_name"]).write.parquet(data_path)
    catalog.Dataset(f"{schema}.customer", data_path, "customers, names encrypted").register(spark)
    privacy.register_keys_view(spark, f"{schema}.keys", keys_path, "c_custkey", persistent=True)
    _, clear = privacy.create_masked_and_clear_views(
        spark, f"{schema}.customer", f"{schema}.keys", "c_custkey", ["c_name"], schema=schema,
        persistent=True)
    return spark.table(clear)


def q_sql_decrypt(spark, d):
    """Decryption from SQL with the ``decrypt_val`` function over the
    protected table and its keys (G6), as a SQL user writes it."""
    out = privacy_flow.protect(spark, table(spark, d, "customer"),
                               scratch_path(spark, "gdpr-sql"), "customer_sql",
                               "c_custkey", ["c_name"], pseudonym_of="c_name")
    return spark.sql(f"""
        SELECT a.c_custkey AS ID, decrypt_val(a.c_name, e.encryption_key) AS email,
               a.customer_pseudo_id
        FROM {out.table} AS a INNER JOIN {out.keys_view} AS e ON e.c_custkey = a.c_custkey""")


# -- joins, aggregates, projections ------------------------------------------

def q_star_join(spark, d):
    c = table(spark, d, "customer")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    j = joins.join(c, n, c["c_nationkey"] == n["n_nationkey"], "inner")
    return j.select(*[c[x] for x in c.columns], n["n_name"])


def _orders_customers(spark, d, strategy):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"),
                                           "c_name", "c_mktsegment")
    return joins.join(o, c, "o_custkey", "inner", strategy=strategy)


def q_join_broadcast(spark, d):
    return _orders_customers(spark, d, "broadcast")


def q_join_sortmerge(spark, d):
    return _orders_customers(spark, d, "merge")


def q_distinct_count(spark, d):
    seg = table(spark, d, "customer").select("c_mktsegment").distinct()
    return seg.agg(F.count(F.lit(1)).alias("n_distinct"))


def q_people(spark, d):
    return files.people_from_ids(table(spark, d, "customer"), "c_custkey")


def q_people_stream(spark, d):
    """People rows for the customers' ids from the id source, as a stream that is
    stopped half-way through the ids and started again (S10, T1)."""
    cust = table(spark, d, "customer")
    first, last = idsource.bounds(cust, "c_custkey")
    target, checkpoint = scratch_path(spark, "people-stream"), scratch_path(spark, "people-stream-ckpt")
    for end in ((first + last) // 2, None):
        stream = idsource.stream_people(cust, "c_custkey", end=end)
        ingest.start_append(stream, target, checkpoint).awaitTermination()
    return spark.read.parquet(target)


# -- files, overwrite --------------------------------------------------------

def q_csv_roundtrip(spark, d):
    cust = table(spark, d, "customer")
    path = scratch_path(spark, "customer-csv")
    files.write_csv_files(cust, path, files=4, by="c_custkey")
    return files.read_csv(spark, path + "/*.csv", header=True, schema=cust.schema)


def q_stream_ingest(spark, d):
    ev = table(spark, d, "events")
    landing = scratch_path(spark, "landing-csv")
    files.write_csv_files(ev, landing, files=6, by="event_id")
    target = scratch_path(spark, "bronze")
    ingest.ingest_csv(spark, landing, target, scratch_path(spark, "bronze-ckpt"),
                      schema=ev.schema, max_files=2, table="events_bronze")
    return spark.table("events_bronze")


def q_stream_expect(spark, d):
    """Expectation on a stream: events landed as CSV, rows failing
    ``value <= 40`` dropped per micro-batch on their way to the table."""
    ev = table(spark, d, "events")
    landing = scratch_path(spark, "landing-expect")
    files.write_csv_files(ev, landing, files=6, by="event_id")
    stream = files.stream_csv(spark, landing, schema=ev.schema, max_files=2)
    kept, _ = quality.expect(stream, {"small_value": "value <= 40"}, dataset="events_bronze")
    target = scratch_path(spark, "bronze-expect")
    ingest.start_append(kept, target, scratch_path(spark, "bronze-expect-ckpt")) \
        .awaitTermination()
    return spark.read.parquet(target)


def _customer_csv(spark, d) -> tuple[str, list[str]]:
    cols = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
    path = scratch_path(spark, "customer-text")
    files.write_csv_files(table(spark, d, "customer").select(*cols), path, files=4, by="c_custkey")
    return path, cols


def q_csv_strings(spark, d):
    """CSV without a schema: every column is text."""
    path, _ = _customer_csv(spark, d)
    return files.read_csv(spark, path, header=True)


def q_stream_inferred(spark, d):
    """A stream whose schema is captured from the files that have landed."""
    path, _ = _customer_csv(spark, d)
    target = scratch_path(spark, "bronze-inferred")
    ingest.ingest_csv(spark, path, target, scratch_path(spark, "bronze-inferred-ckpt"), max_files=2)
    return ingest.ingested(spark, target)


def _rescued(rows: DataFrame) -> DataFrame:
    """The rescue column by its parts (the file's path differs from run to run), and
    -1 for nations that are no numbers."""
    part = lambda name: F.get_json_object(headers.RESCUED, f"$.{name}").alias(f"rescued_{name}")
    rows = rows.withColumn("c_nationkey", F.coalesce("c_nationkey", F.lit(-1)))
    return rows.select("*", part("c_nationkey"), part("c_note")).drop(headers.RESCUED)


def q_csv_by_header(spark, d):
    """Files with swapped, missing and extra columns in one folder, each read by its
    own header; what does not fit the schema is rescued (S1, S2)."""
    path = scratch_path(spark, "customer-mixed")
    derived.land_mixed_headers(spark, d, path)
    schema = table(spark, d, "customer").schema
    return _rescued(headers.read_by_header(spark, path + "/*", schema, options=files.CSV_OPTIONS))


def q_stream_rescue(spark, d):
    """The same files as a stream of several micro-batches."""
    path, target = scratch_path(spark, "landing-mixed"), scratch_path(spark, "bronze-mixed")
    derived.land_mixed_headers(spark, d, path)
    ingest.ingest_csv(spark, path, target, scratch_path(spark, "bronze-mixed-ckpt"),
                      table(spark, d, "customer").schema, max_files=2, rescue=headers.RESCUED)
    return _rescued(ingest.ingested(spark, target))


def q_scd1_stream_new_column(spark, d):
    """A change feed that gains a column with its second batch, then a batch without
    it (T3)."""
    ev = table(spark, d, "events")
    target = cdc_stream.ChangeApply(scratch_path(spark, "scd1-grows"), scd_type=1, compact_every=2,
                                    **derived.EVENTS_FEED)
    part = lambda n: ev.where(F.pmod("event_id", F.lit(3)) == n)
    for i, batch in enumerate((part(0).drop("props"), part(1), part(2).drop("props"))):
        target.apply_batch(batch, i)
    return target.table(spark)


def _events_in_files(spark, d) -> DataFrame:
    """Events as a stream of several files, in an order that is not theirs."""
    ev = table(spark, d, "events")
    path = scratch_path(spark, "events-files")
    ev.repartition(4, F.xxhash64("event_id")).write.parquet(path)
    return spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 2).parquet(path)


def _state_apply(spark, d, scd_type: int) -> DataFrame:
    target = state_apply.StateApply(scratch_path(spark, "state-ckpt"), scd_type=scd_type, **derived.EVENTS_FEED)
    target.start(_events_in_files(spark, d)).awaitTermination()
    return target.table(spark)


def q_scd2_state_stream(spark, d):
    """History kept in Spark's state store and read back from it."""
    return _state_apply(spark, d, 2)


def q_scd1_state_stream(spark, d):
    """Current rows kept in Spark's state store and read back from it."""
    return _state_apply(spark, d, 1)


def _keyed(spark, d) -> keyed.KeyedHistory:
    """Three runs over the events; the last brings the changes of a few users only."""
    ev = table(spark, d, "events")
    target = keyed.KeyedHistory(scratch_path(spark, "keyed"), buckets=16, **derived.EVENTS_FEED)
    few = F.col("user_id").between(*_KEYS) & (F.pmod("event_id", F.lit(2)) == 0)
    for part in (~few & (F.pmod("event_id", F.lit(3)) == 0), ~few & (F.pmod("event_id", F.lit(3)) != 0), few):
        target.apply(ev.where(part))
    return target


def q_cdc_flow_by_difference(spark, d):
    """The flow in two runs, silver history and gold by the buckets of what each run
    brought (T5, C4)."""
    ev = table(spark, d, "events")
    landing = scratch_path(spark, "landing-buckets")
    p = cdc_flow.CdcFlow(scratch_path(spark, "cdc-buckets"), ev.schema, prefix="b", buckets=8, **derived.EVENTS_FEED)
    few = F.col("user_id").between(*_KEYS)
    for part in (~few, few):
        files.write_csv_files(ev.where(part), landing, files=2, by="event_id")
        p.run(spark, landing)
    return p.gold(spark)


def q_gold_by_difference(spark, d):
    """Gold rows after three runs that rewrote only the buckets of their keys (T5, C4)."""
    return _keyed(spark, d).current(spark)


def q_history_by_difference(spark, d):
    """The history after the same runs."""
    return _keyed(spark, d).history(spark)


def q_replace_where_null_partition(spark, d):
    """Predicate overwrite beside a partition of nulls, which stays (K3)."""
    cust = table(spark, d, "customer").withColumn(
        "c_mktsegment", F.expr("nullif(c_mktsegment, 'AUTOMOBILE')"))
    path = scratch_path(spark, "customer-null-parts")
    cust.write.partitionBy("c_mktsegment").parquet(path)
    overwrite.replace_where_partitions(path, _incoming(cust), _REPLACE_PRED, "c_mktsegment")
    return spark.read.parquet(path).select(*cust.columns)


def q_stream_count(spark, d):
    return q_stream_ingest(spark, d).agg(F.count(F.lit(1)).alias("n"))


_REPLACE_PRED = "c_mktsegment = 'BUILDING'"


def _incoming(cust: DataFrame, pred: str = _REPLACE_PRED) -> DataFrame:
    return cust.where(pred).withColumn("c_acctbal", F.col("c_acctbal") + F.lit(100.0))


def q_replace_where(spark, d):
    cust = table(spark, d, "customer")
    return overwrite.replace_where(cust, _incoming(cust), _REPLACE_PRED)


def q_replace_where_version(spark, d):
    cust = table(spark, d, "customer")
    base = scratch_path(spark, "customer-rw")
    versioned.write_version(cust, base)
    overwrite.replace_where_version(base, _incoming(cust), _REPLACE_PRED,
                                    table="customer_rw")
    return spark.table("customer_rw")


def q_replace_where_partitions(spark, d):
    cust = table(spark, d, "customer")
    path = scratch_path(spark, "customer-parts")
    cust.write.partitionBy("c_mktsegment").parquet(path)
    overwrite.replace_where_partitions(
        path, _incoming(cust), "c_mktsegment IN ('BUILDING', 'MACHINERY')", "c_mktsegment")
    return spark.read.parquet(path).select(*cust.columns)


def _orders_csv(spark, d) -> DataFrame:
    """Orders as text from CSV, with the year as a column of digits."""
    path = scratch_path(spark, "orders-text")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority",
                                         F.date_format("o_orderdate", "yyyy").alias("year"))
    files.write_csv_files(o, path, files=4, by="o_orderkey")
    return files.read_csv(spark, path, header=True)


def _late(orders: DataFrame, year: str) -> DataFrame:
    return orders.where(F.col("year") == year).withColumn("o_orderpriority", F.lit("LATE"))


def q_replace_where_csv_partitions(spark, d):
    """Partitions of digits held as text: one replaced, one emptied (K3)."""
    orders = _orders_csv(spark, d)
    path = scratch_path(spark, "orders-years")
    orders.write.partitionBy("year").parquet(path)
    overwrite.replace_where_partitions(path, _late(orders, "1996"), "year IN ('1996', '1997')", "year")
    return spark.read.parquet(path).select(
        "o_orderkey", "o_custkey", "o_orderpriority", F.col("year").cast("string").alias("year"))


def q_partitioned_table_flow(spark, d):
    """Distinct count, repartition by it, partitioned write, declared table, replace
    (R1, K2, K6, K11, R3)."""
    orders = _orders_csv(spark, d)
    spread = partitioning.repartition_by_distinct(orders, "year", by_column=True)
    path = scratch_path(spark, "orders-flow")
    dataset = catalog.Dataset(scratch_name(spark, "orders"), path, "orders by year",
                              {"quality": "bronze"}, partition_by=("year",))
    dataset.write(spread)
    overwrite.replace_where_partitions(path, _late(orders, "1998"), "year = '1998'", "year")
    dataset.register(spark)
    spark.catalog.refreshTable(dataset.name)
    return dataset.read(spark).select(
        "o_orderkey", "o_custkey", "o_orderpriority", F.col("year").cast("string").alias("year"))


# -- layouts, sketches, replays ------------------------------------------------

def bucketed_customers(spark, d) -> tuple[DataFrame, DataFrame]:
    """Customers and their keys as tables in buckets of the customer."""
    cust = table(spark, d, "customer")
    out = []
    for kind, rows in (("customer", cust), ("keys", _keys(spark, d))):
        t = layout.Bucketed(scratch_name(spark, f"{kind}_buckets"), scratch_path(spark, f"{kind}-buckets"),
                            "c_custkey", 8, f"{kind} by customer", {"quality": "silver"})
        t.write(rows)
        out.append(t.read(spark))
    return tuple(out)


def q_bucketed_encrypt(spark, d):
    """Encryption and decryption by joins of bucketed tables, no row moved (J1, K11,
    G3-G5)."""
    cust, keys = bucketed_customers(spark, d)
    enc = layout.Bucketed(scratch_name(spark, "enc_buckets"), scratch_path(spark, "enc-buckets"), "c_custkey", 8)
    enc.write(privacy.encrypt_columns(cust, keys, "c_custkey", ["c_name"]))
    return privacy.decrypt_columns(enc.read(spark), keys, "c_custkey", ["c_name"])


def clustered_history(spark, d, row_group: int = layout.ROW_GROUP) -> DataFrame:
    path = scratch_path(spark, "history-clustered")
    layout.write_clustered(derived.events_history(spark, d), path, "user_id", "ts", row_group=row_group)
    return spark.read.parquet(path)


def q_lookup_skipping(spark, d):
    """One key's history and a range of keys, from a history clustered by key whose
    row groups are skipped (C5, F1, F2)."""
    history = clustered_history(spark, d)
    return history.where((F.col("user_id") == _KEY) | F.col("user_id").between(*_KEYS))


def q_rebalanced_write(spark, d):
    """Orders by year, files by volume instead of a partition a value."""
    path = scratch_path(spark, "orders-rebalanced")
    layout.write_rebalanced(_orders_csv(spark, d), path, "year")
    return spark.read.parquet(path).select(
        "o_orderkey", "o_custkey", "o_orderpriority", F.col("year").cast("string").alias("year"))


def q_distinct_sketch(spark, d):
    """Stored sketches of a table, added to by an append, against exact counts: within
    four standard errors (A3)."""
    li = table(spark, d, "lineitem").select("l_returnflag", "l_partkey", "l_orderkey")
    first = F.pmod("l_orderkey", F.lit(4)) > 0
    path = scratch_path(spark, "sketches")
    sketches.distinct_sketches(li.where(first), "l_partkey", "l_returnflag").write.parquet(path)
    both = sketches.append_sketches(spark.read.parquet(path),
                                    sketches.distinct_sketches(li.where(~first), "l_partkey", "l_returnflag"))
    about = sketches.distinct_estimate(both, "l_returnflag")
    exact = li.groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("n_exact"))
    return exact.join(about, "l_returnflag").select(
        "l_returnflag", "n_exact",
        (F.abs(F.col("n_distinct") - F.col("n_exact")) <= 4 * sketches.ERROR * F.col("n_exact") + 1).alias("near"))


def q_stream_dedup(spark, d):
    """Files landed twice, taken in once: ids seen within a week of landing are
    dropped, with bounded state (T2)."""
    ev = table(spark, d, "events")
    landing, target = scratch_path(spark, "landing-twice"), scratch_path(spark, "bronze-once")
    for _ in range(2):
        files.write_csv_files(ev, landing, files=3, by="event_id")
    once = ingest.once_within(files.stream_csv(spark, landing, schema=ev.schema, max_files=2), ["event_id"])
    ingest.start_append(once, target, scratch_path(spark, "bronze-once-ckpt")).awaitTermination()
    return spark.read.parquet(target)


def q_partition_count(spark, d):
    """Partitions of orders spread over as many as there are years (R2)."""
    orders = table(spark, d, "orders").select(F.year("o_orderdate").alias("year"))
    spread = partitioning.repartition_by_distinct(orders, "year")
    return spark.range(1).select(F.lit(partitioning.num_partitions(spread)).cast("long").alias("n"))


def q_new_keys(spark, d):
    """Keys made in SQL, one a customer: all different, 32 bytes."""
    table(spark, d, "customer").createOrReplaceTempView("customers_for_keys")
    privacy.register_sql_functions(spark)
    path = scratch_path(spark, "sql-keys")  # random: written before use
    spark.sql("SELECT c_custkey, new_encryption_key(c_custkey) AS k FROM customers_for_keys").write.parquet(path)
    return spark.read.parquet(path).agg(
        F.count("*").alias("n"), F.count_distinct("k").alias("n_keys"),
        F.min(F.length(F.unbase64("k"))).alias("least_bytes"))


def q_drops(spark, d):
    """Views, functions, tables and schemas that are dropped are gone; the files stay
    (K8)."""
    schema, path = scratch_name(spark, "lk", "SCHEMA"), scratch_path(spark, "customer-dropped")
    catalog.create_schema(spark, schema)
    table(spark, d, "customer").write.parquet(path)
    catalog.Dataset(f"{schema}.t", path).register(spark)
    spark.sql(f"CREATE VIEW {schema}.v AS SELECT * FROM {schema}.t")
    spark.sql(f"CREATE FUNCTION {schema}.f(x STRING) RETURNS STRING RETURN upper(x)")
    catalog.drop_view(spark, f"{schema}.v")
    catalog.drop_function(spark, f"{schema}.f")
    catalog.drop_table(spark, f"{schema}.t")
    left = spark.sql(f"SHOW TABLES IN {schema}").where("not isTemporary").count() + spark.sql(f"SHOW USER FUNCTIONS IN {schema}").where(
        F.col("function").contains(schema)).count()
    catalog.drop_schema(spark, schema)
    there = spark.sql(f"SHOW SCHEMAS LIKE '{schema}'").count()
    return spark.read.parquet(path).agg(F.count("*").alias("n_rows")).select(
        "n_rows", F.lit(left).cast("long").alias("n_left"), F.lit(there).cast("long").alias("n_schemas"))


def q_bronze_quality_report(spark, d):
    """Expectations on a stream of six micro-batches, in the event log (Q2, Q5)."""
    ev = table(spark, d, "events")
    landing = scratch_path(spark, "landing-quality")
    files.write_csv_files(ev, landing, files=6, by="event_id")
    p = cdc_flow.CdcFlow(scratch_path(spark, "cdc-quality"), ev.schema, prefix="q", max_files=1,
                         bronze_rules={"small_value": "value <= 40"}, **derived.EVENTS_FEED)
    p._bronze(spark, landing)
    return p.report(spark).select("output_records", "dropped_records", "status_update",
                                  "expectations.dataset", "expectations.name",
                                  "expectations.passed_records", "expectations.failed_records")


QUERIES: dict[str, Query] = {
    "csv_by_header": q_csv_by_header,
    "stream_rescue": q_stream_rescue,
    "scd1_stream_new_column": q_scd1_stream_new_column,
    "bucketed_encrypt": q_bucketed_encrypt,
    "lookup_skipping": q_lookup_skipping,
    "rebalanced_write": q_rebalanced_write,
    "distinct_sketch": q_distinct_sketch,
    "stream_dedup": q_stream_dedup,
    "partition_count": q_partition_count,
    "new_keys": q_new_keys,
    "drops": q_drops,
    "scd2_state_stream": q_scd2_state_stream,
    "scd1_state_stream": q_scd1_state_stream,
    "cdc_flow_by_difference": q_cdc_flow_by_difference,
    "gold_by_difference": q_gold_by_difference,
    "history_by_difference": q_history_by_difference,
    "replace_where_null_partition": q_replace_where_null_partition,
    "history_point_lookup": q_history_point_lookup,
    "current_key_range": q_current_key_range,
    "clean_view": q_clean_view,
    "persistent_admin_view": q_persistent_admin_view,
    "csv_strings": q_csv_strings,
    "stream_inferred": q_stream_inferred,
    "replace_where_csv_partitions": q_replace_where_csv_partitions,
    "partitioned_table_flow": q_partitioned_table_flow,
    "bronze_quality_report": q_bronze_quality_report,
    "scd2_history": q_scd2_history,
    "scd1_current": q_scd1_current,
    "scd2_composite": q_scd2_composite,
    "gold_current": q_gold_current,
    "partition_lookup": q_partition_lookup,
    "current_between": q_current_between,
    "scd1_stream": q_scd1_stream,
    "scd2_stream": q_scd2_stream,
    "scd2_composite_stream": q_scd2_composite_stream,
    "expect_or_drop": q_expect_or_drop,
    "dq_metrics": q_dq_metrics,
    "event_log": q_event_log,
    "expectation_report": q_expectation_report,
    "expectation_report_sql": q_expectation_report_sql,
    "cdc_flow": q_cdc_flow,
    "json_path": q_json_path,
    "explode_json": q_explode_json,
    "gold_quality_report": q_gold_quality_report,
    "pseudonymize": q_pseudonymize,
    "ordered_limit": q_ordered_limit,
    "subject_keys": q_subject_keys,
    "encrypt_roundtrip": q_encrypt_roundtrip,
    "encrypt_hides": q_encrypt_hides,
    "admin_view": q_admin_view,
    "sql_decrypt": q_sql_decrypt,
    "star_join": q_star_join,
    "join_broadcast": q_join_broadcast,
    "join_sortmerge": q_join_sortmerge,
    "distinct_count": q_distinct_count,
    "people": q_people,
    "people_stream": q_people_stream,
    "csv_roundtrip": q_csv_roundtrip,
    "stream_ingest": q_stream_ingest,
    "stream_count": q_stream_count,
    "stream_expect": q_stream_expect,
    "replace_where": q_replace_where,
    "replace_where_version": q_replace_where_version,
    "replace_where_partitions": q_replace_where_partitions,
}


# -- DuckDB oracles -----------------------------------------------------------

_EVENTS_CHANGES = """
  c AS (SELECT *, coalesce(event_type = 'error', false) AS is_del FROM events
        WHERE user_id IS NOT NULL AND ts IS NOT NULL)"""

_SCD2_EVENTS = f"""
WITH {_EVENTS_CHANGES},
  d AS (SELECT * FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id, ts
            ORDER BY is_del DESC, event_id DESC, event_type DESC, value DESC, props DESC) AS rn
          FROM c) WHERE rn = 1),
  h AS (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS end_at FROM d)
SELECT event_id, ts, user_id, value, props, ts AS __START_AT, end_at AS __END_AT
FROM h WHERE NOT is_del"""

_SCD1_EVENTS = f"""
WITH {_EVENTS_CHANGES},
  r AS (SELECT *, row_number() OVER (PARTITION BY user_id
          ORDER BY ts DESC, is_del DESC, event_id DESC, event_type DESC, value DESC,
                   props DESC) AS rn FROM c)
SELECT event_id, ts, user_id, value, props FROM r WHERE rn = 1 AND NOT is_del"""

_SCD2_ORDERS = """
WITH c AS (SELECT *, coalesce(o_orderstatus = 'F', false) AS is_del FROM orders
           WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL AND o_orderkey IS NOT NULL),
  h AS (SELECT *, lead(o_orderdate) OVER (PARTITION BY o_custkey
          ORDER BY o_orderdate, o_orderkey) AS end_at FROM c)
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority,
       o_orderdate AS __START_AT, end_at AS __END_AT
FROM h WHERE NOT is_del"""

_LOG_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"

_EVENT_LOG = f"""
WITH e AS (SELECT event_id, ts, event_type, {_LOG_K} AS k,
                  CASE WHEN event_type IN ('purchase', 'click') THEN 'COMPLETED'
                       ELSE 'RUNNING' END AS status FROM events)
SELECT CAST(event_id AS VARCHAR) AS id, ts AS "timestamp",
       CAST(event_id AS VARCHAR) AS sequence, 'flow_progress' AS event_type,
       'Flow ' || event_type || ' is ' || status AS message,
       CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
       '{{"flow_progress":{{"status":"' || status || '","metrics":{{"num_output_rows":'
         || CAST(k AS VARCHAR) || '}},"data_quality":{{"dropped_records":'
         || CAST(k % 7 AS VARCHAR)
         || CASE WHEN event_type <> 'click' THEN
              ',"expectations":[{{"dataset":"silver_' || event_type || '","failed_records":'
              || CAST(k % 7 AS VARCHAR) || ',"name":"valid_value","passed_records":'
              || CAST(k AS VARCHAR) || '}},{{"dataset":"silver_' || event_type
              || '","failed_records":0,"name":"valid_user","passed_records":'
              || CAST(k * 2 AS VARCHAR) || '}}]'
            ELSE '' END || '}}}}}}' AS details
FROM e"""

_REPORT_PART = """
SELECT CAST(event_id AS VARCHAR) AS id, ts AS "timestamp",
       CAST({k} AS VARCHAR) AS output_records, CAST({k} % 7 AS VARCHAR) AS dropped_records,
       'COMPLETED' AS status_update, 'silver_' || event_type AS dataset,
       '{name}' AS name, CAST({passed} AS BIGINT) AS passed_records,
       CAST({failed} AS BIGINT) AS failed_records
FROM events WHERE event_type = 'purchase'"""

_EXPECTATION_REPORT = (
    _REPORT_PART.format(k=_LOG_K, name="valid_value", passed=_LOG_K, failed=f"{_LOG_K} % 7")
    + "\nUNION ALL" +
    _REPORT_PART.format(k=_LOG_K, name="valid_user", passed=f"{_LOG_K} * 2", failed="0"))

_DQ_PART = """
SELECT l_returnflag AS dataset, '{name}' AS name,
       CAST(count_if(coalesce({pred}, false)) AS BIGINT) AS passed_records,
       CAST(count(*) - count_if(coalesce({pred}, false)) AS BIGINT) AS failed_records
FROM lineitem GROUP BY l_returnflag"""

_DQ_METRICS = "\nUNION ALL".join(_DQ_PART.format(name=n, pred=p)
                                 for n, p in derived.LINEITEM_RULES.items())

_GOLD_QUALITY_REPORT = f"""
WITH h AS ({_SCD2_EVENTS})
SELECT CAST(count_if(__END_AT IS NULL) AS VARCHAR) AS output_records,
       CAST(count_if(__END_AT IS NOT NULL) AS VARCHAR) AS dropped_records,
       'COMPLETED' AS status_update, 'gold' AS dataset, 'recent_record' AS name,
       CAST(count_if(__END_AT IS NULL) AS BIGINT) AS passed_records,
       CAST(count_if(__END_AT IS NOT NULL) AS BIGINT) AS failed_records
FROM h"""

_REPLACED = """
SELECT * FROM customer WHERE NOT coalesce(c_mktsegment = 'BUILDING', false)
UNION ALL
SELECT c_custkey, c_name, c_nationkey, c_acctbal + 100.0 AS c_acctbal, c_mktsegment
FROM customer WHERE c_mktsegment = 'BUILDING'"""

_JOIN_OC = """
SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, c.c_name, c.c_mktsegment
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"""

_CUSTOMER_TEXT = """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       c_mktsegment FROM customer"""

_BY_HEADER = """
SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 <> 2 THEN c_nationkey ELSE -1 END AS c_nationkey,
       CASE WHEN c_custkey % 3 <> 1 THEN c_acctbal END AS c_acctbal, c_mktsegment,
       CASE WHEN c_custkey % 3 = 2 THEN 'n' || c_nationkey END AS rescued_c_nationkey,
       CASE WHEN c_custkey % 3 = 2 THEN c_name || '!' END AS rescued_c_note
FROM customer"""

_ORDERS_TEXT = """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       {priority} AS o_orderpriority, strftime(o_orderdate, '%Y') AS year
FROM orders WHERE {where}"""

_PEOPLE = (
    "SELECT c_custkey AS id, (SELECT upper(n[1]) || n[2:] FROM (SELECT "
    "list_extract(s, CAST(c_custkey % 10 AS INT) + 1) || "
    "list_extract(s, CAST(c_custkey // 10 % 10 AS INT) + 1) || "
    "list_extract(s, CAST(c_custkey // 100 % 10 AS INT) + 1) AS n FROM (SELECT "
    "['an', 'bel', 'cor', 'da', 'el', 'fin', 'gus', 'ha', 'ir', 'jo'] AS s))) AS Name, "
    "CAST(10 + ((c_custkey * 7919) % 51) AS INTEGER) AS Age, "
    "list_extract(['USA', 'UK', 'Australia', 'Canada', 'India', 'dummy'], "
    "CAST(((c_custkey * 31 + 7) % 6) + 1 AS INTEGER)) AS Country FROM customer")

ORACLES: dict[str, str] = {
    "bucketed_encrypt": "SELECT * FROM customer",
    "lookup_skipping": (f"SELECT * FROM ({_SCD2_EVENTS}) WHERE user_id = {_KEY} "
                        f"OR user_id BETWEEN {_KEYS[0]} AND {_KEYS[1]}"),
    "rebalanced_write": _ORDERS_TEXT.format(priority="o_orderpriority", where="true"),
    "distinct_sketch": ("SELECT l_returnflag, count(DISTINCT l_partkey) AS n_exact, true AS near "
                        "FROM lineitem GROUP BY l_returnflag"),
    "stream_dedup": "SELECT * FROM events",
    "partition_count": "SELECT count(DISTINCT year(o_orderdate)) AS n FROM orders",
    "new_keys": "SELECT count(*) AS n, count(*) AS n_keys, 32 AS least_bytes FROM customer",
    "drops": "SELECT count(*) AS n_rows, 0::BIGINT AS n_left, 0::BIGINT AS n_schemas FROM customer",
    "scd2_state_stream": _SCD2_EVENTS,
    "scd1_state_stream": _SCD1_EVENTS,
    "cdc_flow_by_difference": f"SELECT * FROM ({_SCD2_EVENTS}) WHERE __END_AT IS NULL",
    "gold_by_difference": f"SELECT * FROM ({_SCD2_EVENTS}) WHERE __END_AT IS NULL",
    "history_by_difference": _SCD2_EVENTS,
    "csv_by_header": _BY_HEADER,
    "stream_rescue": _BY_HEADER,
    "scd1_stream_new_column": f"""
SELECT event_id, ts, user_id, value, CASE WHEN event_id % 3 = 1 THEN props END AS props
FROM ({_SCD1_EVENTS})""",
    "replace_where_null_partition": """
SELECT c_custkey, c_name, c_nationkey,
       c_acctbal + CASE WHEN c_mktsegment = 'BUILDING' THEN 100.0 ELSE 0.0 END AS c_acctbal,
       nullif(c_mktsegment, 'AUTOMOBILE') AS c_mktsegment FROM customer""",
    "history_point_lookup": f"SELECT * FROM ({_SCD2_EVENTS}) WHERE user_id = {_KEY}",
    "current_key_range": (f"SELECT * FROM ({_SCD2_EVENTS}) WHERE __END_AT IS NULL "
                          f"AND user_id BETWEEN {_KEYS[0]} AND {_KEYS[1]}"),
    "clean_view": f"SELECT * FROM ({_SCD2_EVENTS}) WHERE __END_AT IS NULL",
    "persistent_admin_view": "SELECT * FROM customer",
    "csv_strings": _CUSTOMER_TEXT,
    "stream_inferred": _CUSTOMER_TEXT,
    "replace_where_csv_partitions": _ORDERS_TEXT.format(
        priority="CASE WHEN year(o_orderdate) = 1996 THEN 'LATE' ELSE o_orderpriority END",
        where="year(o_orderdate) <> 1997"),
    "partitioned_table_flow": _ORDERS_TEXT.format(
        priority="CASE WHEN year(o_orderdate) = 1998 THEN 'LATE' ELSE o_orderpriority END",
        where="true"),
    "bronze_quality_report": """
SELECT CAST(count_if(value <= 40) AS VARCHAR) AS output_records,
       CAST(count(*) - count_if(value <= 40) AS VARCHAR) AS dropped_records,
       'COMPLETED' AS status_update, 'q_bronze' AS dataset, 'small_value' AS name,
       CAST(count_if(value <= 40) AS BIGINT) AS passed_records,
       CAST(count(*) - count_if(value <= 40) AS BIGINT) AS failed_records
FROM events""",
    "scd2_history": _SCD2_EVENTS,
    "scd1_current": _SCD1_EVENTS,
    "scd2_composite": _SCD2_ORDERS,
    "gold_current": f"SELECT * FROM ({_SCD2_EVENTS}) WHERE __END_AT IS NULL",
    "partition_lookup": "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'",
    "current_between": f"SELECT * FROM ({_SCD1_EVENTS}) WHERE value BETWEEN 10.0 AND 20.0",
    "scd1_stream": _SCD1_EVENTS,
    "scd2_stream": _SCD2_EVENTS,
    "scd2_composite_stream": _SCD2_ORDERS,
    "expect_or_drop": "SELECT * FROM lineitem WHERE coalesce(l_discount <= 0.05, false)",
    "dq_metrics": _DQ_METRICS,
    "event_log": _EVENT_LOG,
    "expectation_report": _EXPECTATION_REPORT,
    "expectation_report_sql": _EXPECTATION_REPORT,
    "cdc_flow": f"SELECT * FROM ({_SCD2_EVENTS}) WHERE __END_AT IS NULL",
    "json_path": "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events",
    "explode_json": ("SELECT e.event_id, j.prop_key, "
                     "CAST(json_extract(e.props, '$.' || j.prop_key) AS BIGINT) AS prop_value "
                     "FROM events e, unnest(json_keys(e.props)) AS j(prop_key)"),
    "gold_quality_report": _GOLD_QUALITY_REPORT,
    "pseudonymize": "SELECT *, sha256(c_name) AS customer_pseudo_id FROM customer",
    "ordered_limit": ("SELECT *, sha256(c_name) AS customer_pseudo_id FROM customer "
                      "ORDER BY c_custkey LIMIT 5"),
    "subject_keys": "SELECT DISTINCT c_custkey, 32 AS key_bytes FROM customer",
    "encrypt_roundtrip": "SELECT * FROM customer",
    "encrypt_hides": ("SELECT CAST(0 AS BIGINT) AS n_same, count(*) AS n_rows, "
                      "count(*) AS n_distinct_cipher FROM customer"),
    "admin_view": "SELECT *, sha256(c_name) AS customer_pseudo_id FROM customer",
    "sql_decrypt": ("SELECT c_custkey AS ID, c_name AS email, sha256(c_name) AS customer_pseudo_id "
                    "FROM customer"),
    "star_join": ("SELECT c.*, n.n_name FROM customer c "
                  "JOIN nation n ON c.c_nationkey = n.n_nationkey"),
    "join_broadcast": _JOIN_OC,
    "join_sortmerge": _JOIN_OC,
    "distinct_count": ("SELECT count(*) AS n_distinct FROM "
                       "(SELECT DISTINCT c_mktsegment FROM customer)"),
    "people": _PEOPLE,
    "people_stream": _PEOPLE,
    "csv_roundtrip": "SELECT * FROM customer",
    "stream_ingest": "SELECT * FROM events",
    "stream_count": "SELECT count(*) AS n FROM events",
    "stream_expect": "SELECT * FROM events WHERE coalesce(value <= 40, false)",
    "replace_where": _REPLACED,
    "replace_where_version": _REPLACED,
    "replace_where_partitions": """
SELECT * FROM customer WHERE NOT coalesce(c_mktsegment IN ('BUILDING', 'MACHINERY'), false)
UNION ALL
SELECT c_custkey, c_name, c_nationkey, c_acctbal + 100.0 AS c_acctbal, c_mktsegment
FROM customer WHERE c_mktsegment = 'BUILDING'""",
}
