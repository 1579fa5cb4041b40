"""Plain Python versions of the operators, and odd inputs, for the tests."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, rid long, fp string, "
          "h int, rest string, th string, found string, `a.b` int")


def odd_documents(spark, seed: int = 0):
    """Nulls in every column, empty and very long texts, ties, repeated rows and
    extra columns under names that the operators use."""
    rng = random.Random(seed)
    vocab = ["the", "Of", "été", "straße", "x1", "日本語", "a b", "don't", "cc", "BY", "public", "license",
             "General", "all", "rights", "reserved", "<|endoftext|>", "[INST]", "&&&", "\x1c", "é", "😀", "---"]
    words = lambda n: " ".join(rng.choice(vocab) + rng.choice(["", "", str(rng.randrange(50))]) for _ in range(n))
    shared = words(40)
    texts = [None, "", " \t\n", "one", "one two", "one two three", words(30), shared,
             words(20) + " " + shared, shared + "\n" + words(15), shared.replace(" ", "  "), words(10),
             "\n".join(["same line here"] * 30), words(6000), words(300), "CC BY", "cc  by, Cc\nBY",
             "the GNU General Public License. All rights reserved", "🎉" * 40, "12 34 56", words(14),
             "a" * 70000, "  lead and trail  ", "x  \n\n  y\t\tz", "é" * 9, "  a   b", "tab\x0bform\x0c"]
    texts += [texts[6], texts[8], texts[14] + " more", texts[14]]
    rows = []
    for k, t in enumerate(texts):
        rows.append((k * 3, t, [None, "en", "fr", "de"][k % 4], [None, "b", "a", "ä", "B"][k % 5],
                     None if k % 3 else 1, k, None, 1, "r", "t", None, 7))
    rows += [rows[8], rows[8]]  # the same row again
    rows.append((24, "another text under a used id", "en", "a", 1, 1, None, 1, "r", "t", None, 7))
    rows.append((None, texts[8], "en", "a", 1, 1, None, 1, "r", "t", None, 7))
    rows.append((None, None, None, None, None, None, None, None, None, None, None, None))
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df, *cols):
    """Sorted rows, None first."""
    got = df.select(*cols).collect() if cols else df.collect()
    return sorted((tuple(r) for r in got), key=lambda r: [(x is not None, x) for x in r])


def simhash(text: str | None, k: int = 3) -> int:
    w = WORD.findall((text or "").translate(LOWER))
    grams = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def closure(n: int, near) -> list[int]:
    """Smallest index that each index reaches by ``near`` (a boolean matrix)."""
    label = np.arange(n)
    while True:
        new = np.where(near, label[None, :], n).min(axis=1) if n else label
        new = np.minimum(new, label)
        if (new == label).all():
            return label.tolist()
        label = new


def simhash_components(docs, radius: int = 3):
    """[(doc_id, hex, component)] of (doc_id, text) pairs."""
    fp = np.array([simhash(t) for _, t in docs], dtype=np.uint64)
    label = closure(len(docs), np.bitwise_count(fp[:, None] ^ fp[None, :]) <= radius)
    least = {}
    for (i, _), c in zip(docs, label):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    return [(i, f"{int(f):016x}", least.get(c)) for (i, _), f, c in zip(docs, fp, label)]


def substrings(docs, k: int = 13):
    """[(doc_id, n_words, n_removed, sha)] of (doc_id, text) pairs."""
    split = [(i, WORD.findall(t or "")) for i, t in docs]
    first = {}
    for i, w in split:
        if i is None:
            continue
        for p in range(len(w) - k + 1):
            g = tuple(w[p:p + k])
            first[g] = min(first.get(g, i), i)
    out = []
    for i, w in split:
        gone = set()
        if i is not None:
            for p in range(len(w) - k + 1):
                if first[tuple(w[p:p + k])] < i:
                    gone.update(range(p, p + k))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def license_base(text: str | None):
    """(n_words, n_base, first_word, last_word, base_labels)."""
    w = ALNUM.findall((text or "").translate(LOWER))
    at = [(p, label) for phrase, label in PHRASES.items() for p in range(len(w))
          if w[p:p + len(phrase.split())] == phrase.split()]
    places = [p for p, _ in at]
    return (len(w), len(at), min(places, default=None), max(places, default=None),
            ",".join(sorted({x for _, x in at})))


def quality_base(text: str | None):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = {}
    for p in range(len(w) - 2):
        grams.setdefault(tuple(w[p:p + 3]), []).append(p)
    repeat = {p + j for at in grams.values() if len(at) > 1 for p in at for j in range(3)}
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
            len(repeat), len(w) < 50 or 100 * len(repeat) > 50 * len(w))


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())
