"""Change apply: the inline edge cases of FIXTURES.md, batch and stream."""

import datetime as dt
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeshore.operators import cdc
from lakeshore.streaming.cdc_stream import ChangeApply

SCHEMA = "customer_id long, city string, operation string, seq long"
CASES = [
    # out of order
    (1, "a", "INSERT", 1), (1, "c", "UPDATE", 3), (1, "b", "UPDATE", 2),
    # delete last
    (2, "a", "INSERT", 1), (2, None, "DELETE", 5),
    # delete, re-insert
    (3, "a", "INSERT", 1), (3, None, "DELETE", 2), (3, "b", "INSERT", 4),
    # late row older than the delete
    (4, None, "DELETE", 5), (4, "a", "UPDATE", 3),
    # replay
    (5, "a", "INSERT", 1), (5, "a", "INSERT", 1),
    # null key or sequence: quarantined
    (None, "a", "INSERT", 1), (6, "a", "INSERT", None),
    # null operation: not a delete
    (7, "a", None, 1),
]
FEED = dict(keys=["customer_id"], sequence_by="seq",
            apply_as_deletes="operation = 'DELETE'", except_columns=["operation"])

SCD1 = {(1, "c"), (3, "b"), (5, "a"), (7, "a")}
SCD2 = {(1, "a", 1, 2), (1, "b", 2, 3), (1, "c", 3, None), (2, "a", 1, 5),
        (3, "a", 1, 2), (3, "b", 4, None), (4, "a", 3, 5), (5, "a", 1, None),
        (7, "a", 1, None)}


@pytest.fixture()
def changes(spark):
    return spark.createDataFrame(CASES, SCHEMA)


def _scd2_set(df):
    return {(r["customer_id"], r["city"], r["__START_AT"], r["__END_AT"]) for r in df.collect()}


def test_scd1_cases(changes):
    out = cdc.apply_changes(changes, scd_type=1, **FEED)
    assert out.columns == ["customer_id", "city", "seq"]
    assert {(r.customer_id, r.city) for r in out.collect()} == SCD1


def test_scd2_cases(changes):
    out = cdc.apply_changes(changes, scd_type=2, **FEED)
    assert out.columns == ["customer_id", "city", "seq", "__START_AT", "__END_AT"]
    assert _scd2_set(out) == SCD2


def test_scd2_hot_key_split_equals_plain(spark):
    # One key holds most rows; a tiny rows_per_task forces the chunked window.
    rows = [(1, f"c{i}", "DELETE" if i % 7 == 0 else "UPDATE", i) for i in range(400)]
    rows += [(k, "x", "INSERT", 1) for k in range(2, 40)]
    df = spark.createDataFrame(rows, SCHEMA)
    plain = cdc.scd2(df, rows_per_task=None, **{k: v for k, v in FEED.items()})
    split = cdc.scd2(df, rows_per_task=64, **{k: v for k, v in FEED.items()})
    assert _scd2_set(split) == _scd2_set(plain)
    assert len(_scd2_set(plain)) == 38 + 400 - len(range(0, 400, 7))


def test_scd2_more_than_65536_split_points(spark, monkeypatch):
    monkeypatch.setattr(cdc, "_SAMPLES_PER_CHUNK", 1)  # with rows_per_task=1, every row is a split point
    n = 70_000
    feed = spark.range(n, numPartitions=4).selectExpr("1L AS k", "id * 10 AS seq")
    pages = cdc._hot_key_splits(feed, ["k"], ["seq"], 1)
    rows = [-1, 0, 655_339, 655_340, 655_349, 655_350, 655_360, 655_375, 10 * n - 1]
    df = spark.createDataFrame([(1, r) for r in rows] + [(2, 5)], "k long, seq long")
    at = F.struct("seq")
    got = cdc._with_chunk(cdc._with_page(df, pages, ["k"], at), at, "seq").select("k", "seq", cdc._CHUNK, cdc._NEXT)
    want = [(1, r, r // 10 + 1, (r // 10 + 1) * 10 if r // 10 + 1 < n else None) for r in rows]
    assert sorted(map(tuple, got.collect())) == [*want, (2, 5, 0, None)]


@pytest.mark.parametrize("n", [7, 8, 40])
def test_scd2_more_split_points_than_a_search_reaches(spark, monkeypatch, n):
    monkeypatch.setattr(cdc, "_SAMPLES_PER_CHUNK", 1)
    monkeypatch.setattr(cdc, "_STEPS", 3)
    monkeypatch.setattr(cdc, "_PAGE", 7, raising=False)
    df = spark.range(n).selectExpr("1L AS customer_id", "'a' AS city", "'UPDATE' AS operation", "id AS seq")
    assert _scd2_set(cdc.scd2(df, rows_per_task=1, **FEED)) == {(1, "a", i, i + 1 if i + 1 < n else None) for i in range(n)}


def test_quarantine(changes):
    valid, bad = cdc.split_changes(changes, ["customer_id"], ["seq"], "operation = 'DELETE'")
    assert bad.count() == 2
    assert valid.count() == len(CASES) - 2


def test_current_rows_equals_scd1(changes):
    hist = cdc.apply_changes(changes, scd_type=2, **FEED)
    cur = cdc.current_rows(hist).select("customer_id", "city")
    assert {tuple(r) for r in cur.collect()} == SCD1


def test_versions_never_overlap(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    h = cdc.scd2(ev, ["user_id"], ["ts"], "event_type = 'error'")
    w = F.lead("__START_AT").over(Window.partitionBy("user_id").orderBy("__START_AT"))
    bad = h.withColumn("nxt", w).where(F.col("__END_AT") > F.col("nxt"))
    assert bad.count() == 0


def test_composite_sequence_ties(spark):
    d = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [(1, d, 10, "a"), (1, d, 11, "b"), (1, d + dt.timedelta(days=1), 5, "c")],
        "k long, d timestamp_ntz, n long, v string")
    h = cdc.scd2(df, ["k"], ["d", "n"])
    got = sorted((r["v"], r["__START_AT"], r["__END_AT"]) for r in h.collect())
    # tied first column: zero-length version
    assert got == [("a", d, d), ("b", d, d + dt.timedelta(days=1)),
                   ("c", d + dt.timedelta(days=1), None)]


@pytest.mark.parametrize("scd_type", [1, 2])
def test_stream_batches_equal_batch(spark, scratch, changes, scd_type):
    """Out-of-order batches and a replayed batch give the one-shot result."""
    target = ChangeApply(scratch("state"), scd_type=scd_type, compact_every=2, **FEED)
    rows = changes.collect()
    batches = [rows[8:], rows[:4], rows[4:8], rows[:4]]
    for i, b in enumerate(batches):
        target.apply_batch(spark.createDataFrame(b, SCHEMA), i)
    got = target.table(spark)
    want = cdc.apply_changes(changes, scd_type=scd_type, **FEED)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=repr) == \
        sorted(map(tuple, want.collect()), key=repr)
    # the two bad rows sit in batch 0 only
    assert spark.read.parquet(target.quarantine_path).count() == 2


def test_point_lookup_of_history_is_pushed_to_the_scan(spark):
    """One key's history; the key filter reaches the parquet scan through
    the window (the window is partitioned by the key)."""
    import contextlib
    import io

    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    hist = cdc.scd2(ev, ["user_id"], ["ts"], "event_type = 'error'")
    one = hist.where(F.col("user_id") == 7)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        one.explain()
    assert "EqualTo(user_id,7)" in buf.getvalue()
    assert one.count() == hist.where("user_id = 7").count() > 0


def test_hot_key_split_under_sampling(spark):
    """A key holding about a third of the rows, split from a real sample
    (fraction < 1), equals the unsplit window."""
    n = 30_000
    df = (spark.range(n)
          .select(F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 500 + 2)
                  .alias("customer_id"),
                  F.concat(F.lit("c"), F.col("id").cast("string")).alias("city"),
                  F.when(F.col("id") % 11 == 0, F.lit("DELETE")).otherwise(F.lit("UPDATE"))
                  .alias("operation"),
                  (F.col("id") * 7 % n).alias("seq")))
    plain = cdc.scd2(df, rows_per_task=None, **FEED)
    split = cdc.scd2(df, rows_per_task=1_000, **FEED)
    cols = ["customer_id", "seq", "__START_AT", "__END_AT"]
    assert split.select(*cols).exceptAll(plain.select(*cols)).count() == 0
    assert plain.select(*cols).exceptAll(split.select(*cols)).count() == 0
    splits = cdc._hot_key_splits(
        cdc.split_changes(df, ["customer_id"], ["seq"], "operation = 'DELETE'")[0],
        ["customer_id"], ["seq"], 1_000).collect()
    assert splits and max(len(r[cdc._SPLITS]) for r in splits) >= 5


def test_split_points_are_bounded_by_the_source(spark, scratch, monkeypatch):
    """A tiny rows_per_task on a feed of known size gives no more split points than
    MAX_SPLIT_POINTS, and the same history; without known size it stays as given."""
    monkeypatch.setattr(cdc, "MAX_SPLIT_POINTS", 10)
    monkeypatch.setattr(cdc, "_SAMPLES_PER_CHUNK", 1)
    path, n = scratch("feed"), 20_000
    spark.range(n, numPartitions=4).selectExpr(
        "if(id % 3 = 0, 1L, id) AS customer_id", "concat('c', id) AS city",
        "if(id % 11 = 0, 'DELETE', 'UPDATE') AS operation", "id * 7 % 20000 AS seq").write.parquet(path)
    feed = spark.read.parquet(path)
    valid = cdc.split_changes(feed, ["customer_id"], ["seq"])[0]
    assert cdc.rows_a_task(valid, 1) * 10 >= n and cdc.rows_a_task(valid, 10**9) == 10**9
    points = cdc._hot_key_splits(valid, ["customer_id"], ["seq"], 1).select(F.sum(F.size(cdc._SPLITS))).first()[0]
    assert (points or 0) <= 20  # a Bernoulli sample of 10 at most
    cols = ["customer_id", "city", "__START_AT", "__END_AT"]
    split = cdc.scd2(feed, rows_per_task=1, **FEED).select(*cols)
    plain = cdc.scd2(feed, rows_per_task=None, **FEED).select(*cols)
    assert split.exceptAll(plain).count() == 0 and plain.exceptAll(split).count() == 0
    local = spark.createDataFrame([(1, "a", "UPDATE", 1)], SCHEMA)
    assert cdc.rows_a_task(local, 64) == 64


def test_building_runs_no_job_and_splits_stay_home(spark, changes):
    """No job before an action; no split list goes through the window's shuffle; a
    key filter reaches the source."""
    import contextlib
    import io

    group = "cdc-build"
    spark.sparkContext.setJobGroup(group, group)
    try:
        hist = cdc.scd2(changes, rows_per_task=64, **FEED)
        cdc.scd1(changes, **FEED)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        hist.explain()
    plan = text.getvalue()
    exchange = next(i for i, line in enumerate(plan.splitlines()) if "Exchange hashpartitioning" in line)
    below = plan.splitlines()[exchange + 1]
    # the list is looked up there, and is no column of what is shuffled
    assert not re.search(rf"[\[ ]{cdc._SPLITS}#\d+(,|\])", below), below
    assert "WindowGroupLimit" in plan


def test_map_payload(spark):
    """Maps are not orderable; the tie-break compares them as JSON text."""
    rows = [(1, {"a": "1"}, "U", 1), (1, {"a": "2"}, "U", 1), (1, {"b": "0"}, "U", 2),
            (2, {"z": "9"}, "U", 1)]
    df = spark.createDataFrame(rows, "customer_id long, attrs map<string,string>, "
                                     "operation string, seq long")
    s2 = cdc.apply_changes(df, scd_type=2, **FEED)
    got = sorted((r["customer_id"], r["seq"], tuple(sorted(r["attrs"].items())))
                 for r in s2.collect())
    assert got == [(1, 1, (("a", "2"),)), (1, 2, (("b", "0"),)), (2, 1, (("z", "9"),))]
    s1 = cdc.apply_changes(df, scd_type=1, **FEED)
    assert {r["customer_id"]: r["attrs"] for r in s1.collect()} == {1: {"b": "0"}, 2: {"z": "9"}}


def test_stream_restart_continues(spark, scratch):
    """A second run with the same checkpoint takes only new files, continues
    the batch ids, and the target equals the batch form over all rows."""
    from lakeshore.streaming.cdc_stream import apply_changes_stream

    landing, state, ckpt = scratch("land"), scratch("state"), scratch("ckpt")
    rows = [(k % 7, f"c{k}", "DELETE" if k % 5 == 0 else "UPDATE", k) for k in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    df.where("seq < 30").repartition(3).write.parquet(landing)

    def run():
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1) \
            .parquet(landing)
        return apply_changes_stream(stream, state, ckpt, scd_type=2, compact_every=2, **FEED)

    run()
    df.where("seq >= 30").repartition(2).write.mode("append").parquet(landing)
    target = run()
    want = cdc.apply_changes(df, scd_type=2, **FEED)
    assert sorted(map(tuple, target.table(spark).collect()), key=repr) == \
        sorted(map(tuple, want.collect()), key=repr)


def test_two_streams_feed_one_target(spark, scratch):
    """Two queries (own checkpoints, same batch ids) append to one target
    without overwriting each other's partitions."""
    from lakeshore.streaming.cdc_stream import apply_changes_stream

    state = scratch("state")
    rows = [(k % 5, f"c{k}", "UPDATE", k) for k in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    targets = []
    for part in ("seq % 2 = 0", "seq % 2 = 1"):
        landing = scratch("land")
        df.where(part).repartition(2).write.parquet(landing)
        stream = spark.readStream.schema(df.schema).parquet(landing)
        targets.append(apply_changes_stream(stream, state, scratch("ckpt"), scd_type=2,
                                            compact_every=100, **FEED))
    want = cdc.apply_changes(df, scd_type=2, **FEED)
    got = targets[-1].table(spark)
    assert sorted(map(tuple, got.collect()), key=repr) == \
        sorted(map(tuple, want.collect()), key=repr)


@pytest.mark.parametrize("scd_type", [1, 2])
def test_sequence_as_column_expression(spark, scratch, scd_type):
    """sequence_by given as a Column (here: a text date parsed to a timestamp,
    so ordering is by time, not by text) in batch and stream forms."""
    rows = [(1, "a", "U", "2024-01-09 00:00:00"), (1, "b", "U", "2024-01-10 00:00:00"),
            (2, "c", "U", "2024-01-02 00:00:00"), (2, None, "D", "2024-01-03 00:00:00")]
    df = spark.createDataFrame(rows, "customer_id long, city string, operation string, "
                                     "ModifiedDate string")
    seq = F.to_timestamp("ModifiedDate")
    feed = dict(keys=["customer_id"], sequence_by=seq,
                apply_as_deletes="operation = 'D'", except_columns=["operation"])
    out = cdc.apply_changes(df, scd_type=scd_type, **feed)
    assert not [c for c in out.columns if c.startswith("__seq")]
    target = ChangeApply(scratch("s"), scd_type=scd_type, **feed)
    target.apply_batch(df.where("customer_id = 2"), 0)
    target.apply_batch(df.where("customer_id = 1"), 1)
    got = target.table(spark)
    assert got.columns == out.columns
    assert sorted(map(tuple, got.collect()), key=repr) == \
        sorted(map(tuple, out.collect()), key=repr)
    if scd_type == 1:
        assert [(r.customer_id, r.city) for r in out.collect()] == [(1, "b")]


def test_change_apply_state_and_current(spark, scratch, changes):
    t2 = ChangeApply(scratch("s2"), scd_type=2, **FEED)
    t2.apply_batch(changes, 0)
    assert {(r["customer_id"], r["city"]) for r in t2.current(spark).collect()} == SCD1
    # state keeps tombstones: one row per (key, sequence), deletes included
    assert t2.state(spark).where("__is_delete").count() == 3
    t1 = ChangeApply(scratch("s1"), scd_type=1, **FEED)
    t1.apply_batch(changes, 0)
    assert {(r["customer_id"], r["city"]) for r in t1.current(spark).collect()} == SCD1


def test_hot_group_of_copies(spark):
    """One (K, S) copied thousands of times (a replayed file, say) is
    detected by the sample and collapsed map-side; result equals the plain
    window."""
    base = [(1, f"c{i}", "UPDATE", i) for i in range(200)]
    copies = [(1, "z", "UPDATE", 50)] * 5000
    df = spark.createDataFrame(base + copies, SCHEMA)
    plain = cdc.scd2(df, rows_per_task=None, **FEED)
    split = cdc.scd2(df, rows_per_task=64, **FEED)
    assert _scd2_set(split) == _scd2_set(plain)
    assert split.count() == 200


def _stream(spark, df, landing, **options):
    return spark.readStream.schema(df.schema).options(**options).parquet(landing)


def _equal(got, want):
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=repr) == \
        sorted(map(tuple, want.collect()), key=repr)


def test_checkpoint_reset_at_the_same_path(spark, scratch):
    """A stream started anew with a fresh checkpoint at the old path: its batch 0
    is not taken for the old one, before and after a compaction."""
    from lakeshore.sinks import versioned
    from lakeshore.streaming.cdc_stream import apply_changes_stream

    state, ckpt = scratch("state"), scratch("ckpt")
    rows = [(k % 4, f"c{k}", "UPDATE", k) for k in range(20)]
    df = spark.createDataFrame(rows, SCHEMA)
    for part in ("seq < 10", "seq >= 10"):
        landing = scratch("land")
        df.where(part).coalesce(1).write.parquet(landing)
        fs, p = versioned._fs(spark, ckpt)
        if fs.exists(p):
            fs.delete(p, True)
        target = apply_changes_stream(_stream(spark, df, landing), state, ckpt, scd_type=2,
                                      compact_every=1, **FEED)
    want = cdc.apply_changes(df, scd_type=2, **FEED)
    _equal(target.table(spark), want)
    target.compact(spark)
    # a reader of another session sees the same rows and columns
    _equal(ChangeApply(state, scd_type=2, **FEED).table(spark), want)


def test_two_writers_compact(spark, scratch, monkeypatch):
    """B compacts between A's read and A's commit: A gives up, nothing is lost."""
    from lakeshore.sinks import versioned

    state = scratch("state")
    rows = [(k, f"c{k}", "UPDATE", k) for k in range(6)]
    df = spark.createDataFrame(rows, SCHEMA)
    a = ChangeApply(state, scd_type=2, compact_every=0, **FEED)
    b = ChangeApply(state, scd_type=2, compact_every=0, **FEED)
    a.apply_batch(df.where("seq < 2"), 0)
    a.compact(spark)
    a.apply_batch(df.where("seq = 2"), 1)
    b.apply_batch(df.where("seq > 2"), 0)
    union, seen = ChangeApply._union, []

    def between(self, *args):
        out = union(self, *args)
        if self is a and not seen:
            seen.append(b.compact(spark))
        return out

    monkeypatch.setattr(ChangeApply, "_union", between)
    a.compact(spark)
    monkeypatch.undo()
    assert seen == [None]  # the base was claimed
    b.compact(spark)
    want = cdc.apply_changes(df, scd_type=2, **FEED)
    _equal(ChangeApply(state, scd_type=2, **FEED).table(spark), want)
    # a claim of a dead writer is taken over
    a.apply_batch(df.where("seq = 5"), 9)
    n = versioned.versions(spark, a.base_path)[-1] + 1
    assert versioned.try_claim(spark, a.base_path, n)
    assert a.compact(spark) is None
    monkeypatch.setattr("lakeshore.sinks.versioned.STALE", -1)
    assert a.compact(spark).endswith(f"{n:08d}")
    _equal(ChangeApply(state, scd_type=2, **FEED).table(spark), want)


def test_versions_step_over_many_dead_claims(spark, scratch):
    from lakeshore.sinks import versioned

    base = scratch("dead")
    for n in range(1, 130):
        assert versioned.try_claim(spark, base, n)
    assert versioned.write_version(spark.range(3), base).endswith("v00000130")
