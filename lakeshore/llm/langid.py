"""Language identification by rank-order profiles (operator 3).

A profile is the list of a language's most frequent letter n-grams (1 to 3
letters, words padded by a blank), in order. A document's own list is compared to
each profile by the out-of-place distance: the sum over its n-grams of how far
they stand from their place in the profile, ``size`` for those that it lacks. The
nearest profile wins, ties by name.

Profiles are learned from every labelled document that has an id, and so are the
limits; the driver holds ``size`` n-grams and a limit per language. Only a caller
who sets ``fit_docs`` learns from at most that many documents per language, those
with the smallest hash of their id. Prediction is one narrow pass over whole texts.

A null text, or one without a letter, is ``und`` with score 0, as is everything
if there is nothing to learn from; every row is reported, repeated or null ids
included; an empty table gives an empty table. Extra columns are never read.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from lakeshore.llm import textkit as tk
from lakeshore.llm.store import written

UNKNOWN = "und"
#: N-grams of a profile and of a document's list.
SIZE = 400
#: A language's limit is this much of the score at this quantile of its own documents.
#: On sf0.1 all documents are above the limits (0.37 to 0.42); two other languages and
#: random letters score 0.15 to 0.34.
LOW_SHARE, MARGIN = 0.01, 0.7
#: Bins of the scores from 0 to 1; one of them is ranked score by score.
BINS = 1000
#: Bytes of text at once: three n-grams a letter, eight bytes each, several times.
PASS_BYTES = 1 << 19
_BITS = 21
_SPACE = 0x20


@functools.cache
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def _counted(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """:func:`_counts`; one document that is longer than a pass is counted in slices,
    each with a character before and after it, and added up as they come."""
    if len(offsets) != 2 or len(buf) <= PASS_BYTES:
        return _counts(buf, offsets)
    heads = lambda a, b: np.flatnonzero((buf[a:b] & 0xC0) != 0x80)  # noqa: E731  where characters begin
    key, count = np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin = 0
    while begin < len(buf):
        end = begin + PASS_BYTES
        end = end + int(heads(end, end + 4)[0]) if end < len(buf) else len(buf)
        before = max(0, begin - 4) + int(heads(max(0, begin - 4), begin)[-1]) if begin else 0
        after = next((end + int(x) for x in heads(end, end + 5)[1:2]), len(buf))
        part = buf[before:after]
        size = int(np.count_nonzero((buf[begin:end] & 0xC0) != 0x80))
        _, k, n = _counts(part, np.array([0, len(part)]), (int(begin > 0), int(begin > 0) + size))
        key, at = np.unique(np.concatenate([key, k]), return_inverse=True)
        count = np.bincount(at, weights=np.concatenate([count, n]), minlength=len(key)).astype(np.int64)
        begin = end
    return np.zeros(len(key), np.int64), key, count


def _counts(buf: np.ndarray, offsets: np.ndarray, own: tuple[int, int] | None = None) -> tuple[np.ndarray, ...]:
    """(document, n-gram key, count) of all documents in a UTF-8 buffer, sorted by
    document and key; a key is three code points of 21 bits, shorter n-grams are
    padded with zero. ``own``: only n-grams around these characters count."""
    # the text between two blanks, each document after one more
    points = np.frombuffer(buf.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype="<u4")
    starts = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])[offsets]
    n_docs = len(offsets) - 1
    cp = np.insert(points, starts, _SPACE).astype(np.int64)
    doc = np.concatenate([np.repeat(np.arange(n_docs), np.diff(starts) + 1), [n_docs]])
    letter = _letters()[cp]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[0] = True
    s, d, letter = np.where(letter, cp, _SPACE)[keep], doc[keep], letter[keep]
    alphabet, code = np.unique(s, return_inverse=True)
    radix = len(alphabet) + 1
    code += 1
    if own is not None:
        mine = np.zeros(len(cp), dtype=bool)
        mine[own[0] + 1:own[1] + 1] = True
        letter_own = letter & mine[keep]
    one = np.flatnonzero(letter if own is None else letter_own)
    mid = one[(one > 0) & (one < len(s) - 1)]
    # a letter with each neighbour; with the blank before, and what follows
    pair_next = mid
    pair_blank = mid[~letter[mid - 1]]
    grams = np.concatenate([
        code[one],
        code[pair_next] * radix + code[pair_next + 1],
        code[pair_blank - 1] * radix + code[pair_blank],
        (code[mid - 1] * radix + code[mid]) * radix + code[mid + 1]])
    of = np.concatenate([d[one], d[pair_next], d[pair_blank], d[mid]])
    whole = of * radix ** 3 + grams
    whole.sort()
    new = np.ones(len(whole), dtype=bool)
    new[1:] = whole[1:] != whole[:-1]
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(whole)))
    whole = whole[at]
    of, grams = whole // radix ** 3, whole % radix ** 3
    points_of = np.concatenate([[0], alphabet])
    a, b, c = grams // radix ** 2, grams // radix % radix, grams % radix
    key = (points_of[a] << 2 * _BITS) | (points_of[b] << _BITS) | points_of[c]
    return of, key, count


def _ranked(of: np.ndarray, count: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of each document's ``size`` most frequent n-grams, ties by key, in
    order, and their rank from 0."""
    begin = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else of
    sizes = np.diff(np.append(begin, len(of)))
    local = np.arange(len(of)) - np.repeat(begin, sizes)
    keep = local < size  # documents keep their bounds when sorted
    most = (1 << 22) - 1
    if len(of) and max(count.max(), sizes.max()) > most:
        return np.lexsort((local, -count, of))[keep], local[keep]
    order = (of << 44) | ((most - count) << 22) | local  # the same order, as one number
    order.sort()
    return (np.repeat(begin, sizes) + (order & most))[keep], local[keep]


def _lowered(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return tk.texts_of(pc.utf8_lower(column.cast(pa.large_string())))


def _training(docs: DataFrame, id_col: str, text_col: str, lang_col: str, fit_docs: int | None = None) -> DataFrame:
    """(lang, text) of the labelled documents that are learned from: all that have an
    id, without which none is known not to be held out."""
    named = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
                        F.col(f"`{lang_col}`").alias("lang")).where(
                            "doc_id is not null and lang is not null and text is not null")
    if fit_docs is None:
        return named.select("lang", "text")
    least = Window.partitionBy("lang").orderBy("h", "doc_id")
    # a hash threshold leaves some four times fit_docs ids of each language, however
    # many there are; the least of them are taken
    ids = named.select("doc_id", "lang", F.xxhash64("doc_id").bitwiseAND(F.lit((1 << 40) - 1)).alias("h"))
    sizes = ids.groupBy("lang").agg(F.count("*").alias("size"))  # a row per language
    few = ids.join(F.broadcast(sizes), "lang").where(
        F.col("h") / float(1 << 40) * F.col("size") < 4.0 * fit_docs + 100)
    # ids only, at most fit_docs rows a language: bounded, so broadcast to the texts
    chosen = (few.withColumn("n", F.row_number().over(least))
              .where(F.col("n") <= fit_docs).select("doc_id", "lang").distinct())
    return named.join(F.broadcast(chosen), ["doc_id", "lang"]).select("lang", "text")


def learn(docs: DataFrame, size: int = SIZE, fit_docs: int | None = None, id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang") -> dict[str, list[int]]:
    """{language: its n-gram keys, most frequent first} from all rows of ``docs``
    with a label, or from ``fit_docs`` of each language if that is set."""
    texts = _training(docs, id_col, text_col, lang_col, fit_docs)

    def run(batch: pa.RecordBatch):
        langs = batch.column(0).dictionary_encode()
        index = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        buf, offsets = _lowered(batch.column(1))
        for i, j, b, o in tk.passes(buf, offsets, PASS_BYTES):
            of, key, count = _counted(b, o)
            lang = index[i:j][of]
            order = np.lexsort((key, lang))
            lang, key, count = lang[order], key[order], count[order]
            if not len(key):
                continue
            new = np.ones(len(key), dtype=bool)
            new[1:] = (key[1:] != key[:-1]) | (lang[1:] != lang[:-1])
            at = np.flatnonzero(new)
            yield pa.RecordBatch.from_arrays(
                [langs.dictionary.take(pa.array(lang[at])), pa.array(key[at]),
                 pa.array(np.add.reduceat(count, at))], ["lang", "key", "n"])

    counts = (tk.map_batches(texts, run, "lang string, key long, n long")
              .groupBy("lang", "key").agg(F.sum("n").alias("n")))
    top = Window.partitionBy("lang").orderBy(F.col("n").desc(), "key")
    rows = counts.withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= size)
    profiles: dict[str, list[int]] = {}
    for lang, key in rows.orderBy("lang", "rank").select("lang", "key").collect():
        profiles.setdefault(lang, []).append(key)
    return profiles


def predict(docs: DataFrame, profiles: dict[str, list[int]], size: int = SIZE,
            text_col: str = "text", keep: list | None = None) -> DataFrame:
    """The columns ``keep`` (names or Columns; all by default) with lang_pred and
    score: 1 less the distance as a share of the largest possible one."""
    langs = sorted(profiles)
    grams = np.unique(np.array([k for p in profiles.values() for k in p], dtype=np.int64))
    place = np.full((len(langs), len(grams) + 1), size, dtype=np.int64)  # the last: in no profile
    for row, lang in enumerate(langs):
        keys = np.array(profiles[lang], dtype=np.int64)
        place[row, np.searchsorted(grams, keys)] = np.arange(len(keys))

    def nearest(buf, offsets):
        n = len(offsets) - 1
        best, score = np.full(n, len(langs)), np.zeros(n)
        of, key, count = _counted(buf, offsets)
        if not len(of) or not langs:
            return best, score
        at, rank = _ranked(of, count, size)
        of, key = of[at], key[at]
        where = np.minimum(np.searchsorted(grams, key), len(grams) - 1)
        where = np.where(grams[where] == key, where, len(grams))
        far = place[:, where]
        far = np.where(far < size, np.abs(far - rank), size)
        begin = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        total = np.add.reduceat(far, begin, axis=1)
        near = total.argmin(axis=0)
        best[of[begin]] = near
        length = np.diff(np.append(begin, len(of)))
        score[of[begin]] = 1 - total[near, np.arange(len(begin))] / (length * size)
        return best, score

    names = pa.array([*langs, UNKNOWN])

    def run(batch: pa.RecordBatch):
        buf, offsets = _lowered(batch.column(0))
        parts = [nearest(b, o) for _, _, b, o in tk.passes(buf, offsets, PASS_BYTES)]
        best = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
        score = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0)
        yield pa.RecordBatch.from_arrays(
            [batch.column(1), names.take(pa.array(best)), pa.array(score)], ["rest", "lang_pred", "score"])

    kept = [F.col(f"`{c}`") if isinstance(c, str) else c for c in (keep if keep is not None else docs.columns)]
    src = docs.select(F.col(f"`{text_col}`").alias("text"), F.struct(*kept).alias("rest"))
    out = tk.map_batches(src, run, tk.schema_with(src.schema["rest"].dataType, "",
                                                  "lang_pred string, score double"))
    names_of = src.schema["rest"].dataType.fieldNames()
    return out.select(*[F.col(f"rest.`{c}`") for c in names_of], "lang_pred", "score")


def limits(docs: DataFrame, profiles: dict[str, list[int]], size: int = SIZE, id_col: str = "doc_id",
           text_col: str = "text", lang_col: str = "lang") -> dict[str, float]:
    """{language: the score below which a text is not taken to be in it}: ``MARGIN``
    of the score that all but ``LOW_SHARE`` of its labelled documents that are
    predicted as such reach, the exact quantile of all of them."""
    scored = predict(_training(docs, id_col, text_col, lang_col), profiles, size, keep=["lang"])
    counts = (written(scored.where("lang = lang_pred").groupBy("lang", "score").agg(F.count("*").alias("n")),
                      "language-scores").withColumn("bin", F.floor(F.col("score") * BINS)))
    # at most BINS + 1 rows a language, then the scores of the one bin with the place
    every = Window.partitionBy("lang")
    bins = counts.groupBy("lang", "bin").agg(F.sum("n").alias("n")).select(
        "lang", "bin", F.sum("n").over(every.orderBy("bin")).alias("upto"),
        F.ceil(LOW_SHARE * F.sum("n").over(every)).alias("place"), (F.col("upto") - F.col("n")).alias("below"))
    within = counts.join(F.broadcast(bins.where("below < place and place <= upto").drop("upto")), ["lang", "bin"])
    reach = within.withColumn("upto", F.col("below") + F.sum("n").over(every.orderBy("score")))
    low = reach.where("upto >= place").groupBy("lang").agg(F.min("score").alias("low"))
    return {lang: MARGIN * score for lang, score in low.collect()}


def held_out(id_col: str = "doc_id"):
    """The documents that nothing is learned from: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op3_language_id(spark, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    profiles = learn(docs.where(~held_out()))
    return predict(docs, profiles, keep=["doc_id", held_out().alias("held_out")])
