"""Operators 11, 12 and 13: brute force, recall, certain bounds, odd inputs."""

import collections
import re

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lakeshore.llm import collocations as col
from lakeshore.llm import negatives as neg
from lakeshore.llm import search
from lakeshore.llm.strips import Best

SF = "/root/testdata/sf0.001"


def vectors(spark, rows, extra=False):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    if extra:  # names that the operators use inside
        for c in ("x", "rid", "a", "g", "cell", "kind", "dim", "list", "n", "query", "anchor"):
            df = df.withColumn(c, F.lit(c))
    return df


def some_vectors(n=260, dim=8, seed=5):
    rng = np.random.default_rng(seed)
    x = np.round(rng.standard_normal((n, dim)), 1)  # ties
    x[200:230] = x[50]  # copies of one vector, an anchor among them
    rows = [(i, x[i].tolist(), int(rng.integers(0, 4))) for i in range(n)]
    rows += [(50, x[50].tolist(), 1), (7, x[7].tolist(), 2)]  # ids that come again
    rows += [(1000, None, 1), (1001, x[0].tolist(), None), (None, x[0].tolist(), 1), (1002, [], 1),
             (1003, [float("nan")] * dim, 1), (1004, [float("inf")] + [0.0] * (dim - 1), 1),
             (1005, [None] + [1.0] * (dim - 1), 1), (1050, [0.0] * dim, 1), (1100, [1.0, 2.0], 1),
             (1101, [1.0, 1.5], 2), (1102, [2.0, 2.0], 1)]
    return rows


# -- operator 13 --------------------------------------------------------------

def brute_negatives(rows, anchor, positives=5, negatives=3, low=50, high=95, scale=256):
    rows = [(i, v, np.array([int(np.floor(scale * c)) for c in x], object), lab) for i, (v, x, lab) in enumerate(rows)
            if v is not None and lab is not None and x and all(c is not None and np.isfinite(c) for c in x)]
    out = []
    for i, v, x, lab in rows:
        if not anchor(v):
            continue
        scored = [(-int((x * y).sum()), w, j, m) for j, w, y, m in rows if j != i and len(y) == len(x)]
        for ps, pv, _, _ in sorted(s for s in scored if s[3] == lab)[:positives]:
            mine = sorted(s for s in scored if s[3] != lab and low * -ps <= 100 * -s[0] <= high * -ps)[:negatives]
            out += [(v, pv, r + 1, nv, -ps, -ns) for r, (ns, nv, _, _) in enumerate(mine)]
    return sorted(out)


def test_negatives_brute_force_and_odd_rows(spark):
    rows = some_vectors()
    got = neg.hard_negatives(vectors(spark, rows, extra=True), F.col("vec_id") % 50 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == brute_negatives(rows, lambda v: v % 50 == 0)


def test_negatives_over_several_strips(spark, monkeypatch):
    monkeypatch.setattr("lakeshore.llm.strips.QUERY_STRIP", 200)
    rows = some_vectors(seed=6)
    table = vectors(spark, rows).repartition(7)
    got = neg.hard_negatives(table, F.col("vec_id") % 10 == 0, positives=2, negatives=4, low=20, high=120)
    assert sorted(map(tuple, got.collect())) == brute_negatives(rows, lambda v: v % 10 == 0, 2, 4, 20, 120)


def test_negatives_of_large_and_empty_input(spark):
    big = [(i, [float(i % 3 + 1) * 2e6, float(i)], i % 2) for i in range(60)] + [(100, [1e9, 0.0], 0)]
    got = sorted(map(tuple, neg.hard_negatives(vectors(spark, big), F.col("vec_id") % 50 == 0).collect()))
    assert got == brute_negatives(big[:60], lambda v: v % 50 == 0)  # a squared length beyond 2^62 takes no part
    assert neg.hard_negatives(vectors(spark, []), F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("dim", [1, 3, 64, 65, 130])
def test_intervals_hold_the_product(dim):
    rng = np.random.default_rng(dim)
    x = rng.integers(-300, 300, (40, dim))
    x[3] = 0
    code, align, norm = neg.codes(x)
    low, high = neg.Planes(x[:10]).intervals(slice(0, 10), code, align, norm)
    exact = x[:10] @ x.T
    assert (low <= exact).all() and (exact <= high).all()
    assert code.shape == (40, -(-dim // 64))
    if dim == 64:  # and they are no trivial bounds
        lengths = np.linalg.norm(x, axis=1)
        assert (high - low)[:, 20:].mean() < 1.5 * (lengths[:10, None] * lengths[20:]).mean()


def test_best_breaks_ties_by_id():
    best = Best(2, 2, np.int64)
    best.add(np.array([0, 0, 1]), np.array([5, 5, 1]), np.array([9, 3, 4]), np.array([0, 1, 2]))
    best.add(np.array([0, 0]), np.array([5, 4]), np.array([1, 0]), np.array([3, 4]))
    i, score, vid, _ = best.rows()
    assert list(zip(i.tolist(), score.tolist(), vid.tolist())) == [(0, 5, 1), (0, 5, 3), (1, 1, 4)]


# -- operator 11 --------------------------------------------------------------

def cosines(x, y):
    x, y = np.array(x, float), np.array(y, float)
    return float((x * y).sum() / (np.sqrt((x * x).sum()) * np.sqrt((y * y).sum())))


def test_nearest_recall_and_scores(spark):
    t = pq.read_table(f"{SF}/embeddings.parquet").to_pydict()
    got = collections.defaultdict(list)
    for r in search.op11_nearest_neighbours(spark, SF).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    by = dict(zip(t["vec_id"], t["embedding"]))
    asked = [v for v in by if v % 50 == 0]
    assert sorted(got) == sorted(asked)
    hits = 0
    for q in asked:
        want = sorted((-cosines(by[q], x), v) for v, x in by.items() if v != q)[:5]
        rows = sorted(got[q])
        assert [r for r, _, _ in rows] == [1, 2, 3, 4, 5]
        assert rows == sorted(rows, key=lambda r: (-r[2], r[1]))
        assert all(abs(s - cosines(by[q], by[v])) < 1e-12 for _, v, s in rows)
        hits += len({v for _, v in want} & {v for _, v, _ in rows})
    assert hits >= 0.9 * 5 * len(asked)


def test_nearest_odd_rows(spark):
    rows = some_vectors()
    got = search.nearest(vectors(spark, rows, extra=True), F.col("vec_id") % 50 == 0).collect()
    assert not {r["query_id"] for r in got} & {1050, 1000, None}  # zero, null
    assert not {r["vec_id"] for r in got} & {None, 1002, 1003, 1004, 1005}
    # the copies of vector 50 are its nearest, smallest ids first; its other row is one
    mine = sorted((r["rank"], r["vec_id"]) for r in got if r["query_id"] == 50)
    assert mine == sorted([(1, 50), (2, 200), (3, 201), (4, 202), (5, 203)] * 2)
    # two other vectors of length 2: all candidates
    assert [(r["rank"], r["vec_id"]) for r in got if r["query_id"] == 1100] == [(1, 1101), (2, 1102)]
    assert search.nearest(vectors(spark, []), F.col("vec_id") % 50 == 0).count() == 0
    assert search.nearest(vectors(spark, [(1, [1.0], 1)]), F.col("vec_id") % 50 == 0).count() == 0


def test_nearest_magnitudes(spark):
    rows = [(0, [1e-200, 1e-200, 0.0], 0), (1, [1e200, 1e200, 0.0], 0), (2, [1.0, 1.0, 1e-3], 0), (3, [0.0, 0.0, 5.0], 0)]
    got = search.nearest(vectors(spark, rows), F.col("vec_id") == 0).collect()
    assert [r["vec_id"] for r in got] == [1, 2, 3] and got[0]["score"] == pytest.approx(1.0, abs=1e-15)


def test_nearest_over_several_strips_and_clusters(spark, monkeypatch):
    monkeypatch.setattr("lakeshore.llm.strips.QUERY_STRIP", 4000)
    rng = np.random.default_rng(2)
    centre = rng.standard_normal((20, 24))
    x = centre[rng.integers(0, 20, 3000)] + 0.2 * rng.standard_normal((3000, 24))
    got = collections.defaultdict(set)
    df = vectors(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)]).repartition(5)
    for r in search.nearest(df, F.col("vec_id") % 50 == 0).collect():
        got[r["query_id"]].add(r["vec_id"])
    u = x / np.linalg.norm(x, axis=1)[:, None]
    hits = 0
    for q in range(0, 3000, 50):
        c = u @ u[q]
        c[q] = -2
        hits += len(set(np.argsort(-c)[:5].tolist()) & got[q])
    assert hits >= 0.9 * 300


# -- operator 12 --------------------------------------------------------------

def brute_collocations(rows, top, least, share=50):
    out = []
    counts = collections.defaultdict(collections.Counter)
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                counts[lang or "und"].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        found = []
        for p, a in f.items():
            if len(p) == 1 or a < least:
                continue
            if len(p) == 2 and any(100 * c >= share * a for q, c in f.items()
                                   if len(q) == 3 and c >= least and p in (q[:2], q[1:])):
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, x, y, n, -s) for i, (s, a, p, x, y) in enumerate(sorted(found)[:top])]
    return sorted(out)


def invented(seed, docs=150, words=25):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["Größe", "NEW", "york", "city", "a.b", "x\x00y", "🙂"]
    rows = []
    for _ in range(docs):
        w = [vocabulary[int(i)] for i in (rng.zipf(1.3, int(rng.integers(0, 60))) - 1) % len(vocabulary)]
        for _ in range(int(rng.integers(0, 3))):
            w += ["NEW", "York", "City"][:int(rng.integers(2, 4))]
        text = "".join(x + str(rng.choice([" ", "  ", "\t", ", ", ".", "\n", "! "], p=[.7, .05, .05, .08, .05, .05, .02])) for x in w)
        rows.append((text, ["en", "de", None, "und"][int(rng.integers(0, 4))]))
    return rows + [(None, "en"), ("", "fr"), ("lone", "it"), rows[0], rows[0]]


def table(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string")
    for c in ("h", "h1", "word", "n", "a", "l", "floor", "bucket", "score"):
        df = df.withColumn(c, F.lit("clash"))
    return df


@pytest.mark.parametrize("seed,top,least", [(1, 2000, 2), (2, 5, 3), (3, 1, 2)])
def test_collocations_brute_force(spark, seed, top, least):
    rows = invented(seed)
    got = col.collocations(table(spark, rows), top=top, least=least)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute_collocations(rows, top, least)


def test_collocations_ties_and_rounds(spark):
    """All pairs of the best scores are dropped by longer phrases, so the first floor
    does not settle the rank and deeper rounds follow; scores tie."""
    rows = [(f"a{i} b{i} c{i}", "en") for i in range(30) for _ in range(3)]
    rows += [(f"p{i} q{i}. p{i} z. q{i}", "en") for i in range(10) for _ in range(3)]
    got = col.collocations(table(spark, rows), top=32, least=2)
    assert sorted(map(tuple, got.collect())) == brute_collocations(rows, 32, 2)


def test_collocations_of_nothing(spark):
    assert col.collocations(table(spark, []), top=3).count() == 0
    assert col.collocations(table(spark, [(None, None), ("", "en")]), top=3).count() == 0


@pytest.mark.parametrize("size", [1, 7, 40])
def test_slices_count_like_the_whole(size):
    """Long texts are cut into slices: no phrase is lost or counted twice."""
    rows = invented(9, docs=12)
    batch = pa.RecordBatch.from_arrays([pa.array([r[1] for r in rows], pa.string()), pa.array([r[0] for r in rows], pa.string())],
                                       ["lang", "text"])

    def phrases(size):
        out = collections.Counter()
        for _, h, at, run, skip in col._stream(batch, {}, 0, size):
            for width in (1, 2, 3):
                for i in range(max(0, skip - width + 1), len(h) - width + 1):
                    if run[i] == run[i + width - 1]:
                        out[(int(at[i]), *h[i:i + width].tolist())] += 1
        return out

    assert phrases(size) == phrases(1 << 20)


def test_added_survives_hash_ties(monkeypatch):
    monkeypatch.setattr(col, "_mixed", lambda keys: np.zeros(len(keys[0]), np.uint64))
    keys = [np.array([1, 2, 1, 2, 1], np.uint64), np.array([5, 5, 6, 5, 5], np.uint64)]
    first, n = col._added(keys, np.ones(5, np.int64))
    assert {(int(keys[0][i]), int(keys[1][i])): int(c) for i, c in zip(first, n)} == {(1, 5): 2, (1, 6): 1, (2, 5): 2}
