"""Vectorised text helpers for Arrow batches: word bounds, word hashes and
rolling k-gram hashes over many documents at once with numpy.

A batch of documents is one byte buffer; a *word* is a maximal run of bytes of a
class (a 256-entry table), never across two documents. UTF-8 bytes beyond ASCII
belong to words in all classes used here, so bytes and code points agree.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import DataType, StructType

#: Bytes of text that one numpy pass takes; temporaries are about 40 times as large.
PASS_BYTES = 2 << 20
#: Rows of one Arrow batch; with long texts PASS_BYTES bounds the work inside.
BATCH_ROWS = 512

NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

#: a-z, 0-9 and all bytes beyond ASCII (texts are lower-cased first).
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = True
ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
LOWER_BYTES = LOWER.tobytes()

_U = np.uint64
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MASK = (1 << 64) - 1


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser: polynomial sums become evenly spread."""
    h = h ^ (h >> _U(33))
    h = h * _U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> _U(29))
    h = h * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(32))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Words:
    """The words of a run of documents.

    ``starts``/``ends``: byte bounds in ``buf``; ``first``: for each document the
    index of its first word, with one more entry at the end."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, table: np.ndarray):
        self.buf = buf
        mask = table[buf]
        n = len(buf)
        edge = np.zeros(n + 1, dtype=bool)
        edge[offsets] = True
        before = np.zeros(n, dtype=bool)
        before[1:] = mask[:-1]
        self.starts = np.flatnonzero(mask & (~before | edge[:n]))
        after = np.zeros(n, dtype=bool)
        after[:-1] = mask[1:]
        self.ends = np.flatnonzero(mask & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, which: int = 0) -> np.ndarray:
        """A 64-bit hash of each word's bytes; ``which`` picks one of two bases."""
        if not len(self):
            return np.zeros(0, dtype=np.uint64)
        lens = self.ends - self.starts
        at = np.zeros(len(lens), dtype=np.int64)
        np.cumsum(lens[:-1], out=at[1:])
        inside = np.arange(int(lens.sum())) - np.repeat(at, lens)
        values = self.buf[np.repeat(self.starts, lens) + inside].astype(np.uint64) + _U(1)
        values *= _powers(_BASES[which], int(lens.max()))[inside]
        return mix(np.add.reduceat(values, at) + lens.astype(np.uint64) * _U(0x165667B19E3779F9))

    def left(self) -> np.ndarray:
        """For each word, how many words of its document start here or later."""
        counts = np.diff(self.first)
        return np.repeat(self.first[1:], counts) - np.arange(len(self))

    def doc(self) -> np.ndarray:
        """For each word the index of its document in the batch."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def rolling(h: np.ndarray, k: int, which: int = 0) -> np.ndarray:
    """Hash of the k words from each word on, over the whole buffer; the caller
    drops those that leave the document. Shorter by k - 1 than ``h``."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    power = 1
    for j in range(k):
        out += h[j:j + n] * _U(power)
        power = power * (_BASES[which] ^ 0x5851F42D4C957F2D | 1) & _MASK
    return mix(out)


def texts_of(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n, o = len(column), column.offset
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64, count=o + n + 1)[o:]
    data = column.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offsets[0]:offsets[-1]], offsets - offsets[0]


def passes(buf: np.ndarray, offsets: np.ndarray,
           size: int = PASS_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a batch into runs of whole documents of about ``size`` bytes (a longer
    document is a run of its own): (first document, end, bytes, offsets)."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1)
        yield i, j, buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]],
                schema: str | StructType, rows: int = BATCH_ROWS) -> DataFrame:
    """``mapInArrow`` of ``fn`` over slices of at most ``rows`` rows."""
    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, rows):
                yield from fn(b.slice(i, rows))
            give_back_memory()

    return df.mapInArrow(run, schema)


def give_back_memory() -> None:
    """Return freed memory to the system: long-lived workers otherwise keep the
    most that they ever held."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library: nothing to trim


def schema_with(rest: DataType, before: str, after: str) -> StructType:
    """A schema with a ``rest`` struct of any column names between two DDL lists."""
    out = StructType(list(StructType.fromDDL(before).fields)) if before else StructType()
    out = out.add("rest", rest)
    for field in StructType.fromDDL(after).fields if after else ():
        out = out.add(field)
    return out
