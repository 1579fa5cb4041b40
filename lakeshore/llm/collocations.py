"""Phrase collocation mining by best-first branch-and-bound growth (operator 12).

Phrases grow word by word, and a prefix is grown only while it can matter:

* a word below ``least`` occurrences starts and ends no candidate;
* a prefix ``x y`` with ``c`` occurrences bounds every phrase ``x y z``: its count is
  at most ``min(c, M)``, with ``M`` the largest count of a pair that starts with
  ``y``, so its score is at most ``10^6 min(c, M) / f(x)`` (cut after ``x``);
* the frontier is grown best first, per language, in batches: the pairs of the best
  scores set a floor that is twice as deep in each round, all prefixes whose bound
  reaches the floor are grown, and also those that may hold a phrase that drops a
  pair above the floor. Above the floor everything is then settled; the rounds end
  for a language when ``top`` survivors stand there (ties included, as a floor is a
  score) or nothing is left below.

A round is one more pass over the texts. Tasks know its prefixes as a bitmap of fixed
size (``BITS``): a false hit grows a prefix that need not be, which changes nothing.

Counting is exact: words are told by 64-bit hashes that are checked to be free of
collisions over the whole vocabulary (another seed is taken otherwise), phrases by
the hashes of their words. Occurrences are added up by numpy within a task and again
per bucket of phrases after the shuffle; a phrase is one entry a task however often
it occurs, and a bucket has a bounded number of entries.

Texts are cut into slices with the last two words carried over, whatever their length.
A null text is empty, a null language ``und``; repeated rows and ids count each; an
empty table gives an empty table; extra columns are never read. Counts of 10^15 and
more end the job with an overflow.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeshore.llm.store import written
from lakeshore.llm.textkit import LOWER, PASS_BYTES, Words, give_back_memory, mix, texts_of

#: Fixed values of the contract: what ends a piece, and what stands between words.
ENDS = np.zeros(256, bool)
ENDS[[ord(c) for c in ".,;:!?"]] = True
ENDS[0x0A:0x0E] = True
IN_WORD = ~ENDS
IN_WORD[[0x20, 0x09]] = False
#: Scores are parts of this.
UNIT = 1_000_000

#: Bits of the bitmaps that tasks hold (2 MB), whatever the corpus.
BITS = 24
#: Entries that a task gathers before it adds them up; words a bucket, on average.
GATHER = 2_000_000
BUCKET_WORDS = 2_000_000
#: Floors start at so many times ``top`` pairs.
FIRST_FLOOR = 2
#: Hash seeds tried.
SEEDS = 8

_U = np.uint64


def _hashes(w: Words, seed: int) -> np.ndarray:
    """A 64-bit hash of each word: the sum of a random number for every byte and
    place."""
    if not len(w):
        return np.zeros(0, np.uint64)
    lens = w.ends - w.starts
    at = np.cumsum(lens) - lens
    inside = np.arange(int(lens.sum())) - np.repeat(at, lens)
    each = w.buf[np.repeat(w.starts, lens) + inside].astype(np.uint64) + (inside.astype(np.uint64) << _U(8))
    each = mix(each + _U((seed + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    return mix(np.add.reduceat(each, at) + lens.astype(np.uint64))


def _slices(buf: np.ndarray, size: int):
    """Bounds of slices of about ``size`` bytes that cut no word."""
    a, n = 0, len(buf)
    while a < n:
        b = min(a + size, n)
        while b < n:
            gap = np.flatnonzero(~IN_WORD[buf[max(a, b - 65536):b]])
            if len(gap):
                b = max(a, b - 65536) + int(gap[-1]) + 1
                break
            b = min(b + 65536, n)
        yield a, b
        a = b


def _stream(batch: pa.RecordBatch, langs: dict[str, int], seed: int, size: int = PASS_BYTES):
    """Slices of a batch (lang, text): (words, their hashes, languages, and run, and
    how many words at the head are carried over). Words stand in one piece of a text
    if their run is the same."""
    buf, offsets = texts_of(batch.column(1))
    names = batch.column(0).to_pylist()
    lang = np.array([langs.setdefault("und" if x is None else x, len(langs)) for x in names], np.int64)
    carry = [np.zeros(0, t) for t in (np.uint64, np.int64, np.int64)]
    run = 0
    for a, b in _slices(buf, size):
        part = LOWER[buf[a:b]]
        inner = offsets[(offsets > a) & (offsets < b)] - a
        w = Words(part, np.concatenate([[0], inner, [b - a]]), IN_WORD)
        steps = ENDS[part].astype(np.int64)
        np.add.at(steps, inner, 1)  # a text begins
        steps = np.cumsum(steps) + run
        if a and a in offsets:
            steps += 1
        run = int(steps[-1])
        doc = np.searchsorted(offsets, w.starts + a, side="right") - 1
        now = [_hashes(w, seed), lang[doc], steps[w.starts]]
        held = len(carry[0])
        both = [np.concatenate(p) for p in zip(carry, now)]
        yield w, *both, held
        carry = [p[-2:] for p in both]


def _added(keys: list[np.ndarray], n: np.ndarray):
    """Entries of equal keys added up: (the first of each, counts). Sorted by a hash
    of the keys, or by the keys themselves if two of them share it."""
    g = _mixed(keys)
    order = np.argsort(g, kind="stable")
    for exact in (False, True):
        if exact:
            order = np.lexsort(keys[::-1])
        new = np.zeros(len(order), bool)
        new[:1] = True
        for k in keys:
            new[1:] |= k[order][1:] != k[order][:-1]
        if exact or not (new[1:] & (g[order][1:] == g[order][:-1])).any():
            break
    first = np.flatnonzero(new)
    return order[first], (np.add.reduceat(n[order], first) if len(first) else n[:0])


def _mixed(keys: list[np.ndarray]) -> np.ndarray:
    g = np.zeros(len(keys[0]), np.uint64)
    for k in keys:
        g = mix(g * _U(0x9E3779B97F4A7C15) + k.astype(np.uint64))
    return g


def _place(*h: np.ndarray) -> np.ndarray:
    """Bit of a word or pair; :func:`_bit` is the same in Spark."""
    x = h[0] if len(h) == 1 else h[0] ^ (h[1] << _U(17) | h[1] >> _U(47))
    return (x >> _U(64 - BITS)).astype(np.int64)


def _bit(*names: str) -> Column:
    x = F.col(names[0])
    if len(names) == 2:
        y = F.col(names[1])
        x = x.bitwiseXOR(F.shiftleft(y, 17).bitwiseOR(F.shiftrightunsigned(y, 47)))
    return F.shiftrightunsigned(x, 64 - BITS)


def _bitmap(df: DataFrame, *names: str) -> np.ndarray:
    """A bitmap of the words or pairs of ``df``: 2^BITS bits, whatever their number."""
    at = df.select(_bit(*names).alias("at"))
    bits = (at.groupBy(F.shiftright("at", 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits"))).toArrow()
    out = np.zeros(1 << BITS - 6, np.uint64)
    out[bits["word"].to_numpy()] = bits["bits"].to_numpy().view(np.uint64)
    return out


def _in(bitmap: np.ndarray, at: np.ndarray) -> np.ndarray:
    return bitmap[at >> 6] >> (at & 63).astype(np.uint64) & _U(1) == 1


def _words(docs: DataFrame, seed: int) -> DataFrame:
    """(lang, h, word, n): all words and their occurrences."""
    def run(batches):
        langs: dict[str, int] = {}
        held: list[tuple] = []

        def out():
            h, at, n = (np.concatenate([p[i] for p in held]) for i in range(3))
            text = pa.concat_arrays([p[3] for p in held])
            names = pa.array(list(langs), pa.string())
            first, n = _added([h, at], n)
            return pa.RecordBatch.from_arrays(
                [names.take(pa.array(at[first])), pa.array(h[first].view(np.int64)), text.take(pa.array(first)), pa.array(n)],
                ["lang", "h", "word", "n"])

        for batch in batches:
            for w, h, at, _, skip in _stream(batch, langs, seed):
                h, at = h[skip:], at[skip:]
                if not len(h):
                    continue
                first, n = _added([h, at], np.ones(len(h), np.int64))
                lens = (w.ends - w.starts)[first]
                begin = np.cumsum(lens) - lens
                index = np.arange(int(lens.sum())) + np.repeat(w.starts[first] - begin, lens)
                text = pa.LargeStringArray.from_buffers(
                    len(first), pa.py_buffer(np.append(begin, lens.sum()).astype(np.int64)), pa.py_buffer(w.buf[index]))
                held.append((h[first], at[first], n, text.cast(pa.string())))
                if sum(len(p[0]) for p in held) >= GATHER // 4:
                    yield out()
                    held.clear()
        if held:
            yield out()
        give_back_memory()

    found = docs.mapInArrow(run, "lang string, h long, word string, n long")
    return found.groupBy("lang", "h", "word").agg(F.sum("n").alias("n"))


def _phrases(docs: DataFrame, width: int, seed: int, keep, buckets: int, least: int) -> DataFrame:
    """(lang, h1 .. h<width>, a): phrases of so many words that ``keep`` (a function
    of the words' hashes) lets through, with at least ``least`` occurrences."""
    cols = [f"h{i + 1}" for i in range(width)]

    def run(batches):
        langs: dict[str, int] = {}
        held: list[list] = []

        def out():
            at, *keys = (np.concatenate(p) for p in zip(*held))
            first, n = _added([at, *keys], np.ones(len(at), np.int64))
            at, keys = at[first], [k[first] for k in keys]
            bucket = (_mixed(keys) >> _U(33)).astype(np.int64) % buckets
            order = np.lexsort((keys[0], bucket, at))  # equal first words together: they pack well
            at, bucket, n = at[order], bucket[order], n[order]
            cuts = np.flatnonzero(np.diff(at, prepend=-1, append=-1) | np.diff(bucket, prepend=-1, append=-1))
            names = list(langs)
            rows = [(names[at[i]], int(bucket[i]), *(k[order[i:j]].tobytes() for k in keys), n[i:j].tobytes())
                    for i, j in zip(cuts[:-1], cuts[1:])]
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(zip(*rows), [pa.string(), pa.int64()] + [pa.binary()] * (width + 1))],
                ["lang", "bucket", *cols, "n"])

        for batch in batches:
            for _, h, at, run_, skip in _stream(batch, langs, seed):
                m = len(h) - width + 1
                if m <= 0:
                    continue
                keys = [h[i:i + m] for i in range(width)]
                fresh = run_[:m] == run_[width - 1:]
                fresh[:max(0, skip - width + 1)] = False  # counted with the slice before
                some = np.flatnonzero(fresh)
                some = some[keep(*[k[some] for k in keys])]
                if len(some):
                    held.append([at[some], *[k[some] for k in keys]])
                if sum(len(p[0]) for p in held) >= GATHER:
                    yield out()
                    held.clear()
        if held:
            yield out()
        give_back_memory()

    def add(t: pa.Table) -> pa.Table:
        keys = [np.concatenate([np.frombuffer(v, np.uint64) for v in t[c].to_pylist()]) for c in cols]
        n = np.concatenate([np.frombuffer(v, np.int64) for v in t["n"].to_pylist()])
        first, n = _added(keys, n)
        first, n = first[n >= least], n[n >= least]
        return pa.table({"lang": pa.array([t["lang"][0].as_py()] * len(first), pa.string()),
                         **{c: k[first].view(np.int64) for c, k in zip(cols, keys)}, "a": n})

    kinds = lambda kind: ", ".join(f"{c} {kind}" for c in cols)
    found = docs.mapInArrow(run, f"lang string, bucket long, {kinds('binary')}, n binary")
    return found.groupBy("lang", "bucket").applyInArrow(add, f"lang string, {kinds('long')}, a long")


def _score(a: str, l: str, r: str) -> Column:
    d = lambda c: f"cast({c} as decimal(15, 0))"
    return F.expr(f"(cast({UNIT} as decimal(7, 0)) * ({d(a)} * {d(a)})) div ({d(l)} * {d(r)})")


def _floors(pairs: DataFrame, depth: int) -> DataFrame:
    """(lang, floor): the score that the best ``depth`` pairs of a language reach,
    rounded down to the least one of its bucket; 0 where it has fewer."""
    scale = F.floor(F.log2(F.col("score") + 1) * 32)
    counted = pairs.groupBy("lang", scale.alias("b")).agg(F.count("*").alias("c"), F.min("score").alias("from"))
    # at most 640 buckets a language
    deep = counted.withColumn("deep", F.sum("c").over(Window.partitionBy("lang").orderBy(F.desc("b"))))
    return deep.groupBy("lang").agg(F.coalesce(F.max(F.when(F.col("deep") >= depth, F.col("from"))),
                                               F.lit(0)).cast("long").alias("floor"))


def collocations(docs: DataFrame, top: int = 2000, least: int = 10, share: int = 50, text_col: str = "text",
                 lang_col: str = "lang") -> DataFrame:
    """The ``top`` collocations of two and three words of each language: lang, rank,
    phrase, a, l, r, n, score. ``least``: occurrences of a candidate; ``share``: per
    cent of its occurrences in one longer candidate that drop it."""
    src = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
                      F.col(f"`{text_col}`").cast("string").alias("text"))
    for seed in range(SEEDS):
        vocabulary = written(_words(src, seed), "words")
        twice = vocabulary.groupBy("h").agg(F.min("word").alias("u"), F.max("word").alias("v")).where("u != v")
        if twice.isEmpty():
            break
    else:
        raise RuntimeError(f"words share hashes with {SEEDS} seeds")
    totals = written(vocabulary.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    tokens = int(totals.agg(F.sum("n")).first()[0] or 0)
    buckets = max(1, -(-tokens // BUCKET_WORDS))
    words = vocabulary.where(F.col("n") >= least)
    count_of = lambda h, name: words.select("lang", F.col("h").alias(h), F.col("n").alias(name))

    usual = _bitmap(words, "h")
    pairs = written(_phrases(src, 2, seed, lambda x, y: _in(usual, _place(x)) & _in(usual, _place(y)), buckets, least),
                    "pairs")
    follow = pairs.groupBy("lang", F.col("h1").alias("h2")).agg(F.max("a").alias("m"))
    scored = (pairs.join(count_of("h1", "l"), ["lang", "h1"]).join(count_of("h2", "r"), ["lang", "h2"])
              .join(follow, ["lang", "h2"], "left").withColumn("score", _score("a", "l", "r"))
              .withColumn("bound", F.expr(f"(cast({UNIT} as decimal(7, 0)) * least(a, m)) div l")))
    scored = written(scored, "scored-pairs")
    known = _bitmap(scored, "h1", "h2")

    depth = top * FIRST_FLOOR
    while True:
        floors = written(_floors(scored, depth), "floors")
        led = scored.join(floors, "lang")
        above = led.where(F.col("score") >= F.col("floor"))
        # the least count of a pair above the floor that starts with a word
        lost = above.groupBy("lang", F.col("h1").alias("h2")).agg(F.min("a").alias("some"))
        grown = led.join(lost, ["lang", "h2"], "left").where(
            (F.col("bound") >= F.col("floor"))
            | ((F.col("score") >= F.col("floor")) & (100 * F.col("m") >= share * F.col("a")))
            | (100 * F.col("a") >= share * F.col("some")))
        prefixes = _bitmap(grown, "h1", "h2")
        triples = written(_phrases(src, 3, seed, _growth(prefixes, known), buckets, least), "triples")

        pair = lambda x, y, name: scored.select("lang", F.col("h1").alias(x), F.col("h2").alias(y), F.col("a").alias(name))
        whole = (triples.join(count_of("h1", "l1"), ["lang", "h1"]).join(count_of("h3", "r2"), ["lang", "h3"])
                 .join(pair("h1", "h2", "l2"), ["lang", "h1", "h2"]).join(pair("h2", "h3", "r1"), ["lang", "h2", "h3"])
                 .withColumn("s1", _score("a", "l1", "r1")).withColumn("s2", _score("a", "l2", "r2")))
        first = F.col("s1") <= F.col("s2")
        whole = whole.select("lang", "h1", "h2", "h3", "a", F.when(first, F.col("l1")).otherwise(F.col("l2")).alias("l"),
                             F.when(first, F.col("r1")).otherwise(F.col("r2")).alias("r"),
                             F.least("s1", "s2").alias("score"))
        inside = triples.select("lang", "h1", "h2", "a").unionByName(
            triples.select("lang", F.col("h2").alias("h1"), F.col("h3").alias("h2"), "a"))
        inside = inside.groupBy("lang", "h1", "h2").agg(F.max("a").alias("longer"))
        staying = (above.join(inside, ["lang", "h1", "h2"], "left")
                   .where(F.coalesce(100 * F.col("longer") < share * F.col("a"), F.lit(True)))
                   .select("lang", "h1", "h2", F.lit(None).cast("long").alias("h3"), "a", "l", "r", "score"))
        longer = whole.join(floors, "lang").where(F.col("score") >= F.col("floor")).drop("floor")
        settled = written(staying.unionByName(longer), "settled")
        reached = settled.groupBy("lang").agg(F.count("*").alias("reached"))
        open_ = floors.join(reached, "lang", "left").where(
            (F.col("floor") > 0) & (F.coalesce("reached", F.lit(0)) < top))
        if open_.isEmpty():
            break
        depth *= 2

    text = lambda h, name: words.select("lang", F.col("h").alias(h), F.col("word").alias(name))
    named = (settled.join(text("h1", "w1"), ["lang", "h1"]).join(text("h2", "w2"), ["lang", "h2"])
             .join(text("h3", "w3"), ["lang", "h3"], "left").withColumn("phrase", F.concat_ws(" ", "w1", "w2", "w3")))
    rank = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    named = named.withColumn("rank", F.row_number().over(rank).cast("long")).where(F.col("rank") <= top)
    return named.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _growth(prefixes: np.ndarray, known: np.ndarray):
    """Of three words: the first two are to be grown, the last two are a candidate."""
    def keep(x, y, z):
        out = _in(prefixes, _place(x, y))
        at = np.flatnonzero(out)
        out[at] = _in(known, _place(y[at], z[at]))
        return out
    return keep


def op12_collocations(spark, sf_dir: str) -> DataFrame:
    """The best 2,000 collocations of two and three words of every language."""
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, unnest(w) AS p, 1 AS k FROM lists
  UNION ALL SELECT lang, unnest([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]), 2 FROM lists WHERE len(w) > 1
  UNION ALL SELECT lang, unnest([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]), 3
  FROM lists WHERE len(w) > 2),
f AS (SELECT lang, p, k, count(*) AS c FROM grams GROUP BY ALL),
n AS (SELECT lang, sum(c)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT *, string_split(p, ' ') AS w FROM f WHERE k > 1 AND c >= 10),
cuts AS (
  SELECT lang, p, k, c, w, 1 AS cut, w[1] AS x, array_to_string(w[2:], ' ') AS y FROM cand
  UNION ALL SELECT lang, p, k, c, w, 2, array_to_string(w[1:2], ' '), w[3] FROM cand WHERE k = 3),
scored AS (
  SELECT cuts.*, fx.c AS l, fy.c AS r,
    ((1000000::HUGEINT * cuts.c * cuts.c) // (fx.c::HUGEINT * fy.c))::BIGINT AS score
  FROM cuts JOIN f fx ON fx.lang = cuts.lang AND fx.p = x AND fx.k = cut
  JOIN f fy ON fy.lang = cuts.lang AND fy.p = y AND fy.k = cuts.k - cut),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, p, max(c) AS longer FROM (
    SELECT lang, w[1] || ' ' || w[2] AS p, c FROM cand WHERE k = 3
    UNION ALL SELECT lang, w[2] || ' ' || w[3], c FROM cand WHERE k = 3) GROUP BY ALL),
kept AS (
  SELECT best.* FROM best LEFT JOIN inside i ON best.k = 2 AND i.lang = best.lang AND i.p = best.p
  WHERE i.longer IS NULL OR 100 * i.longer < 50 * best.c)
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, c DESC, p) AS rank, p AS phrase,
  c AS a, l, r, n.n AS n, score
FROM kept JOIN n ON n.lang = kept.lang
QUALIFY row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, c DESC, p) <= 2000
"""
