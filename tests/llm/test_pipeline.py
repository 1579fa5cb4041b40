"""The pipeline's stages against plain versions, each on its own input."""

from collections import Counter

import pytest

import corpus_pipeline as cp
from lakeshore.llm import langid
from lakeshore.llm.store import written

from . import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """{name: (input, output)} over a whole small table."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in cp.STAGES:
        found = written(stage(spark, docs, SF), f"test-{name}")
        out[name] = (docs, found)
        docs = found
    return out


def plain(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_order_and_columns(stages):
    assert [n for n, _ in cp.STAGES] == ["language_id", "simhash_dedup", "substring_dedup", "source_mix", "bpe"]
    for name, (docs, found) in list(stages.items())[:-1]:
        assert found.columns == docs.columns and found.dtypes == docs.dtypes, name


def test_language_keeps_clean_documents(stages):
    docs, found = stages["language_id"]
    kept = set(plain(found))
    for row in plain(docs):
        assert (row in kept) == any(c.isalpha() for c in row[1] or "")


def test_language_rejects_what_was_not_learned(spark):
    import random
    import string
    rng = random.Random(2)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    finnish = ("kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki "
               "ja omatunto ja heidän on toimittava toisiaan kohtaan veljeyden hengessä").split()
    gibberish = lambda: "".join(rng.choice(string.ascii_lowercase) for _ in range(rng.randrange(2, 10)))
    bad = [" ".join(w() for _ in range(n)) for n in (10, 30, 100, 500)
           for w in (lambda: rng.choice(finnish), gibberish)]
    clean = [(lang, " ".join(text.split()[:n])) for lang, text in docs.where("lang is not null and n_chars > 800")
             .orderBy("doc_id").limit(20).select("lang", "text").collect() for n in (5, 10, 40)]
    rows = [(10**6 + i, t, None, "x", len(t)) for i, t in enumerate([*bad, *[t for _, t in clean]])]
    found = cp.language_id(spark, docs.unionByName(spark.createDataFrame(rows, docs.schema)), SF)
    kept = {r[0] - 10**6 for r in found.where(f"doc_id >= {10**6}").select("doc_id").collect()}
    assert kept == set(range(len(bad), len(rows)))


def test_near_dedup_keeps_one_of_each_group(stages):
    docs, found = stages["simhash_dedup"]
    groups = brute.simhash_components(plain(docs))
    assert sorted(r[0] for r in plain(found)) == sorted({c for _, _, c in groups})


def test_substrings_are_cut(stages):
    docs, found = stages["substring_dedup"]
    words = lambda t: brute.WORD.findall(t or "")
    got = {i: words(t) for i, t in plain(found)}
    want = brute.substrings(plain(docs))
    assert {i: (len(words(t)) - len(got[i])) for i, t in plain(docs)} == {i: gone for i, _, gone, _ in want}
    assert {i: t for i, t in plain(found)}.keys() == {i for i, _ in plain(docs)}


def test_mix_repeats_whole_documents(stages):
    docs, found = stages["source_mix"]
    size = {i: len(brute.WORD.findall(t or "")) for i, t in plain(docs)}
    times = Counter(i for i, _ in plain(found))
    assert set(times) <= set(size) and max(times.values()) <= 3
    source = dict(docs.select("doc_id", "source").collect())
    total, taken = Counter(), Counter()
    for i, n in size.items():
        total[source[i]] += n
    for i, n in times.items():
        taken[source[i]] += n * size[i]
    from .test_ops import brute_targets
    largest = max(size.values())
    for s, goal in brute_targets(total).items():
        assert abs(taken[s] - goal) <= largest + 16 * 32


def test_bpe_of_what_is_left(stages):
    docs, found = stages["bpe"]
    import hashlib

    import public_tokenizers
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = dict(plain(docs))
    rows = found.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["ids"] == library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["decoded_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest()


def test_run_is_the_stages(spark, stages):
    got = cp.run(spark, SF)
    want = stages["bpe"][1]
    pick = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert brute.rows_of(got, *pick) == brute.rows_of(want, *pick)


def test_odd_and_empty_documents(spark):
    odd = brute.odd_documents(spark).select("doc_id", "text", "lang", "source", "n_chars")
    clashing = odd.selectExpr("*", "1 AS score", "'x' AS lang_pred", "2 AS row", "3 AS rest", "4 AS copy", "5 AS h",
                              "6 AS size", "7 AS kept", "8 AS `a.b`")
    for docs in (clashing, odd.limit(0)):
        for name, stage in cp.STAGES:
            before, docs = docs, written(stage(spark, docs, SF), f"odd-{name}")
            if name != "bpe":
                assert docs.columns == before.columns, name
        assert docs.columns[0] == "doc_id"
    repeated = spark.createDataFrame([(1, "a b c", "en", "s", 5)] * 3 + [(2, "x y z", "en", "s", 5)] * 2, odd.schema)
    assert sorted(r[0] for r in plain(cp.near_dedup(spark, repeated, SF))) == [1, 2]
    assert langid.UNKNOWN == "und"
