"""Quality rules by compression bands (operator 10).

Text that zstandard shrinks too far is repetitive, text that it hardly shrinks is
noise. Ratios (compressed / original bytes) are taken over the whole document and
over fixed chunks, and each must lie in the band of its length; short texts
compress worse, so bands depend on length. A small alphabet (hex, random letters)
shrinks as far as prose does, but only by its letters' frequencies: a chunk is
noise, too, if it shrinks hardly further than its own characters shuffled. Beside
the verdict stand plain counts (words, symbols, repeated lines, repeated 3-word
windows) and the base rule.

Upper limits lie above the maxima over the documents of 50 words and more of all
test tables and above texts in nine other languages. Below 1,280 bytes, hex and
random lower-case letters have the ratios of prose, shuffled or not, and are kept.

A null or empty text has no words and fails the base rule; every row is reported
by itself, repeated or null doc_ids included; an empty table gives an empty
table. Extra columns are never read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from lakeshore.llm import textkit as tk

#: Fixed values of the contract.
SYMBOLS = np.frombuffer(b"#*$%&|<>", dtype=np.uint8)
MIN_WORDS, REPEAT_PERCENT, WINDOW = 50, 50, 3

LEVEL = 3
CHUNK = 4096
#: (bytes from, lowest, highest ratio): the band of the longest length reached.
DOC_BANDS = ((0, 0.0, 9.0), (256, 0.25, 0.82), (384, 0.25, 0.80), (512, 0.25, 0.76),
             (768, 0.25, 0.73), (1024, 0.22, 0.73), (2048, 0.22, 0.68), (4096, 0.20, 0.65),
             (16384, 0.18, 0.60))
#: The same for a chunk (only the last of a document is shorter than CHUNK).
CHUNK_BANDS = ((0, 0.0, 9.0), (256, 0.22, 0.82), (384, 0.22, 0.80), (512, 0.22, 0.76),
               (768, 0.22, 0.73), (1024, 0.18, 0.73), (2048, 0.18, 0.68), (4096, 0.18, 0.65))
#: Lowest and highest size of a chunk as a share of its size when shuffled. Noise has
#: 0.95 to 1.04, documents of 2 KB and more at most 0.942.
SHUFFLED_BANDS = ((0, 0.0, 9.0), (1280, 0.0, 0.982), (1536, 0.0, 0.967), (2048, 0.0, 0.95))
_ORDER = np.random.default_rng(7).permutation(CHUNK)
#: More than this share of a document's bytes in chunks outside their bands rejects it.
BAD_CHUNKS = 0.5


def band(sizes: np.ndarray, bands) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest ratio allowed for each size in bytes."""
    at = np.searchsorted([b[0] for b in bands], sizes, side="right") - 1
    return np.array([b[1] for b in bands])[at], np.array([b[2] for b in bands])[at]


def counts_of(buf, offsets) -> dict[str, np.ndarray]:
    """The plain counts of each document in one byte buffer."""
    w = tk.Words(buf, offsets, tk.NOT_SPACE)
    n_docs = len(offsets) - 1
    points = tk.NOT_SPACE[buf] & ((buf & 0xC0) != 0x80)
    per_doc = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[offsets])
    out = {"n_words": np.diff(w.first), "word_chars": per_doc(points),
           "n_symbols": per_doc(np.isin(buf, SYMBOLS))}
    n = max(0, len(w) - WINDOW + 1)
    ok = np.flatnonzero(w.left()[:n] >= WINDOW)
    repeat = np.zeros(n_docs, dtype=np.int64)
    if len(ok):
        doc = w.doc()
        key = tk.mix(tk.rolling(w.hashes(), WINDOW)[ok]
                     + doc[ok].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _, at, times = np.unique(key, return_inverse=True, return_counts=True)
        twice = ok[times[at] > 1]
        covered = np.zeros(len(w), dtype=bool)
        for k in range(WINDOW):
            covered[twice + k] = True
        repeat = np.bincount(doc[covered], minlength=n_docs)
    out["n_repeat_words"] = repeat
    return out


def dup_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def shuffled(chunk: bytes) -> bytes:
    """The characters of a chunk in a fixed other order (those that its ends cut are left out)."""
    points = np.frombuffer(chunk.decode("utf-8", "ignore").encode("utf-32-le"), dtype="<u4")
    return points[_ORDER[_ORDER < len(points)]].tobytes().decode("utf-32-le").encode()


def ratios(text: bytes, press) -> tuple[float, float]:
    """Ratio of the whole text, and the share of its bytes in chunks outside their bands."""
    if not text:
        return 0.0, 0.0
    whole = len(press(text))
    chunks = [text[i:i + CHUNK] for i in range(0, len(text), CHUNK)]
    sizes = np.array([len(c) for c in chunks])
    got = np.array([len(press(c)) for c in chunks] if len(chunks) > 1 else [whole])
    mixed = np.array([len(press(shuffled(c))) if len(c) >= SHUFFLED_BANDS[1][0] else len(c) for c in chunks])
    bad = np.zeros(len(chunks), dtype=bool)
    for share, bands in ((got / sizes, CHUNK_BANDS), (got / mixed, SHUFFLED_BANDS)):
        low, high = band(sizes, bands)
        bad |= (share < low) | (share > high)
    return whole / len(text), float(sizes[bad].sum() / len(text))


SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, n_bytes long, ratio double, bad_chunks double, base_failed boolean, "
          "kept boolean")


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the counts, the compression ratio, the share of bytes
    in chunks outside their bands, base_failed, and kept. One narrow pass, no shuffle."""
    def run(batch: pa.RecordBatch):
        press = zstandard.ZstdCompressor(level=LEVEL).compress
        buf, offsets = tk.texts_of(batch.column(1))
        for i, j, b, o in tk.passes(buf, offsets):
            c = counts_of(b, o)
            texts = [b[s:e].tobytes() for s, e in zip(o[:-1], o[1:])]
            found = np.array([ratios(t, press) for t in texts]).reshape(-1, 2)
            size = np.diff(o)
            low, high = band(size, DOC_BANDS)
            failed = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > REPEAT_PERCENT * c["n_words"])
            kept = (~failed & (found[:, 0] >= low) & (found[:, 0] <= high)
                    & (found[:, 1] <= BAD_CHUNKS))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(i, j - i), *[pa.array(c[k].astype(np.int64)) for k in
                                                   ("n_words", "word_chars", "n_symbols")],
                pa.array([dup_lines(t) for t in texts], pa.int64()),
                pa.array(c["n_repeat_words"].astype(np.int64)), pa.array(size.astype(np.int64)),
                pa.array(found[:, 0]), pa.array(found[:, 1]), pa.array(failed), pa.array(kept)],
                [x.split()[0] for x in SCHEMA.split(", ")])

    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                      F.col(f"`{text_col}`").alias("text"))
    return tk.map_batches(src, run, SCHEMA)


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Counts, base rule and compression verdict of every document."""
    return quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))
