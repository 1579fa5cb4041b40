"""Property checks on random change feeds (hypothesis, few examples: each
example runs Spark jobs)."""

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from lakeshore.operators import cdc
from lakeshore.streaming.cdc_stream import ChangeApply

SCHEMA = "k long, v string, op string, s long"
FEED = dict(keys=["k"], sequence_by="s", apply_as_deletes="op = 'D'")

change = st.tuples(st.one_of(st.none(), st.integers(0, 4)),
                   st.sampled_from(["a", "b", "c", None]),
                   st.sampled_from(["U", "D", None]),
                   st.one_of(st.none(), st.integers(0, 6)))
feeds = st.lists(change, min_size=1, max_size=25)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@settings(max_examples=6, deadline=None, phases=[Phase.explicit, Phase.generate],
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(feed=feeds, cut=st.integers(0, 25), seed=st.randoms())
def test_stream_equals_batch_for_any_split(spark, scratch, feed, cut, seed):
    whole = spark.createDataFrame(feed, SCHEMA)
    shuffled = list(feed)
    seed.shuffle(shuffled)
    cut = min(cut, len(shuffled))
    for scd in (1, 2):
        target = ChangeApply(scratch("p"), scd_type=scd, compact_every=2, **FEED)
        parts = [shuffled[:cut], shuffled[cut:], shuffled[:cut]]  # last one replays
        for i, part in enumerate(parts):
            target.apply_batch(spark.createDataFrame(part, SCHEMA), i)
        want = cdc.apply_changes(whole, scd_type=scd, **FEED)
        assert _rows(target.table(spark)) == _rows(want)


@settings(max_examples=6, deadline=None, phases=[Phase.explicit, Phase.generate],
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(feed=feeds)
def test_scd1_is_current_scd2(spark, feed):
    df = spark.createDataFrame(feed, SCHEMA)
    s1 = cdc.apply_changes(df, scd_type=1, **FEED).select("k", "v", "op", "s")
    s2 = cdc.current_rows(cdc.apply_changes(df, scd_type=2, **FEED)).select("k", "v", "op", "s")
    assert _rows(s1) == _rows(s2)


def test_empty_and_all_quarantined_batches(spark, scratch):
    target = ChangeApply(scratch("e"), scd_type=2, **FEED)
    target.apply_batch(spark.createDataFrame([], SCHEMA), 0)
    target.apply_batch(spark.createDataFrame([(None, "a", "U", 1)], SCHEMA), 1)
    assert target.table(spark).count() == 0
    assert spark.read.parquet(target.quarantine_path).count() == 1
