"""Change apply on the state store, and keyed tables kept up by differences."""

import os
import random

import pytest
from pyspark.sql import functions as F

from lakeshore.operators import cdc, keyed
from lakeshore.streaming.state_apply import StateApply

SCHEMA = "k int, s int, op string, v string"
FEED = dict(keys="k", sequence_by="s", apply_as_deletes="op = 'D'", except_columns=["op"])


def some_changes(seed, n=120, users=25):
    rng = random.Random(seed)
    rows = [(rng.randrange(users), rng.randrange(40), rng.choice("UUUD"), f"v{i}") for i in range(n)]
    return rows + rows[:10] + [(None, 1, "U", "x"), (1, None, "U", "y")]


def same(a, b):
    key = lambda df: sorted(map(str, df.select(sorted(df.columns)).collect()))
    return key(a) == key(b)


@pytest.mark.parametrize("scd_type", [1, 2])
def test_state_store_equals_batch(spark, scratch, scd_type):
    rows = some_changes(scd_type)
    random.Random(7).shuffle(rows)
    source, ckpt = scratch("feed"), scratch("ckpt")
    seen = []
    for part in (rows[:50], rows[50:90], rows[20:60], rows[90:]):  # restarts, and a replayed part
        seen += part
        spark.createDataFrame(part, SCHEMA).repartition(2).write.mode("append").parquet(source)
        target = StateApply(ckpt, scd_type=scd_type, **FEED)
        q = target.start(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source))
        q.awaitTermination()
        assert q.exception() is None
        want = cdc.apply_changes(spark.createDataFrame(seen, SCHEMA), scd_type=scd_type, **FEED)
        got = StateApply(ckpt, scd_type=scd_type, **FEED).table(spark)
        assert got.columns == want.columns and same(got, want)
    state = target.state(spark)
    assert state.count() == len({r[:1] if scd_type == 1 else r[:2] for r in seen if None not in r[:2]})


def test_state_store_refuses_other_columns(spark, scratch):
    source, ckpt = scratch("feed"), scratch("ckpt")
    spark.createDataFrame([(1, 1, "U", "a")], SCHEMA).write.parquet(source)
    StateApply(ckpt, **FEED).start(spark.readStream.schema(SCHEMA).parquet(source)).awaitTermination()
    with pytest.raises(ValueError, match="the feed has"):
        StateApply(ckpt, **FEED).start(spark.readStream.schema(SCHEMA + ", w int").parquet(source))
    with pytest.raises(ValueError, match="maps"):
        StateApply(scratch(), "k", "s").start(spark.readStream.schema("k int, s int, m map<string,int>").parquet(source))


def folders(path):
    out = {}
    for d in os.listdir(path.removeprefix("file:")):
        if d.startswith(keyed.BUCKET):
            out[d] = sorted(f for f in os.listdir(f"{path.removeprefix('file:')}/{d}") if f.endswith(".parquet"))
    return out


def test_keyed_history_rewrites_only_its_buckets(spark, scratch):
    rows = some_changes(3, 400, 200)
    target = keyed.KeyedHistory(scratch("keyed"), buckets=50, **FEED)
    target.apply(spark.createDataFrame(rows, SCHEMA))
    before = {t: folders(target.path(t)) for t in ("changes", "history", "current")}
    # ten changed keys; one of them is deleted, one is new
    more = [(k, 100, "U", "new") for k in range(8)] + [(8, 100, "D", "gone"), (999, 1, "U", "first")]
    touched = target.apply(spark.createDataFrame(more, SCHEMA))
    assert len(touched) <= 10
    for t, old in before.items():
        now = folders(target.path(t))
        changed = {d for d in old.keys() | now.keys() if old.get(d) != now.get(d)}
        assert changed <= {f"{keyed.BUCKET}={b}" for b in touched}
    want = cdc.scd2(spark.createDataFrame(rows + more, SCHEMA), "k", "s", "op = 'D'", ["op"])
    again = keyed.KeyedHistory(target.root, buckets=7, **FEED)  # the number of buckets stays
    assert same(again.history(spark), want) and same(again.current(spark), cdc.current_rows(want))
    assert again.apply(spark.createDataFrame(more, SCHEMA)) == touched  # twice is once
    assert same(again.history(spark), want)
    assert target.apply(spark.createDataFrame([(None, 1, "U", "x")], SCHEMA)) == []


def test_keyed_history_empties_a_bucket_and_takes_late_rows(spark, scratch):
    target = keyed.KeyedHistory(scratch("keyed"), buckets=4, **FEED)
    target.apply(spark.createDataFrame([(1, 5, "U", "a")], SCHEMA))
    target.apply(spark.createDataFrame([(1, 6, "D", "b")], SCHEMA))
    assert target.current(spark).count() == 0 and target.history(spark).count() == 1
    target.apply(spark.createDataFrame([(1, 3, "U", "late")], SCHEMA))  # older than a delete
    assert target.current(spark).count() == 0
    assert sorted((r["v"], r[cdc.START_AT], r[cdc.END_AT]) for r in target.history(spark).collect()) == [
        ("a", 5, 6), ("late", 3, 5)]
    target.apply(spark.createDataFrame([(1, 9, "U", "back")], SCHEMA))
    assert [r["v"] for r in target.current(spark).where(F.col("k") == 1).collect()] == ["back"]


def test_keyed_history_takes_new_columns(spark, scratch):
    target = keyed.KeyedHistory(scratch("keyed"), buckets=3, **FEED)
    target.apply(spark.createDataFrame([(k, 1, "U", "a") for k in range(9)], SCHEMA))
    target.apply(spark.createDataFrame([(1, 2, "U", "b", "new")], SCHEMA + ", w string"))
    target.apply(spark.createDataFrame([(k, 3, "U", "c") for k in range(3)], SCHEMA))
    got = {(r["k"], r["s"], r["w"]) for r in target.history(spark).collect()}
    assert got == {(k, 1, None) for k in range(9)} | {(1, 2, "new")} | {(k, 3, None) for k in range(3)}


def test_flow_by_difference_takes_a_new_column(spark, scratch, tmp_path):
    from lakeshore.plans.cdc_flow import CdcFlow

    landing = tmp_path / "in"
    landing.mkdir()
    schema = spark.createDataFrame([], SCHEMA).schema
    flow = CdcFlow(scratch("flow"), schema, prefix="t", buckets=8, **FEED)
    (landing / "a.csv").write_text("k,s,op,v\n" + "".join(f"{k},1,U,a\n" for k in range(40)))
    flow.run(spark, str(landing))
    before = folders(flow.keyed.path("current"))
    (landing / "b.csv").write_text("v,w,s,k,op\nb,new,2,7,U\n,,2,8,D\nx,,,9,U\n")
    flow.run(spark, str(landing))
    changed = {d for d in before if before[d] != folders(flow.keyed.path("current")).get(d)}
    assert len(changed) <= 2
    gold = {r["k"]: (r["v"], r["w"]) for r in flow.gold(spark).collect()}
    assert gold == {k: ("a", None) for k in range(40) if k not in (7, 8)} | {7: ("b", "new")}
    assert flow.silver(spark, 1).where("k = 7").first()["w"] == "new"
    flow.register_views(spark)
    assert spark.sql("SELECT count(*) FROM t_gold_scd_type_2").first()[0] == 39
    report = flow.report(spark).collect()
    assert {r["expectations"]["name"] for r in report} == {"recent_record"}
