"""Token-id files as directly addressable codes (operator 4).

An id is split into chunks of 8 bits, low bits first. Level 0 has one chunk of
every id, level 1 one of every id that goes on, and so forth; a bitmap per level
says which ids go on, and a rank directory (set bits before every 512th bit) finds
an id's place on the next level. So any token is read by one look per level,
without decoding what stands before it.

File (little-endian): ``DACT``, u32 version, u64 documents, u64 tokens, u32 levels,
u32 zero; per level u64 number of chunks; then per level the chunks (bytes), the
bitmap (bytes, low bit first) and the rank directory (u64 each); then the
document directory: doc ids (i64), which of them are null (bytes), and the end of
each document in tokens (u64). All parts are found from the header alone.

Files hold documents in ascending order of id (null first, ties by text), each
ended by an end id; a file is a run of documents, files are in order by name, and
the manifest has a row per file. A writer renames a finished file into place, so a
task that runs again leaves the same file.

A null text is empty: its document is the end id. Repeated ids stay documents of
their own; an empty table has no files. Extra columns are never read.
"""

from __future__ import annotations

import io
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lakeshore.llm import textkit as tk
from lakeshore.llm.bpe import pieces_of, vocabulary_path
from lakeshore.llm.store import blocks, written
from lakeshore.session import scratch_path

MAGIC, VERSION = b"DACT", 1
HEADER = struct.Struct("<4sIQQII")
RANK_BITS = 512
#: Tokens of a file, about; a longer document is a file of its own.
FILE_TOKENS = 1 << 21


def pack_level(ids: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray, np.ndarray]], int]:
    """[(chunks, bitmap, rank directory)] of all levels."""
    levels = []
    rest = ids.astype(np.uint32)
    while True:
        chunk = (rest & np.uint32(255)).astype(np.uint8)
        rest = rest >> np.uint32(8)
        more = rest != 0
        bits = np.packbits(more, bitorder="little")
        levels.append((chunk, bits, rank_directory(bits)))
        if not more.any():
            return levels, len(levels)
        rest = rest[more]


def rank_directory(bits: np.ndarray) -> np.ndarray:
    """Set bits before every RANK_BITS-th bit of a bitmap."""
    step = RANK_BITS // 8
    starts = np.arange(0, len(bits), step)
    ones = np.add.reduceat(np.bitwise_count(bits).astype(np.uint64), starts) if len(bits) else np.zeros(0, np.uint64)
    return np.concatenate([[np.uint64(0)], np.cumsum(ones)[:-1]]).astype("<u8") if len(ones) else ones.astype("<u8")


def pack(ids: np.ndarray, doc_ids: np.ndarray, nulls: np.ndarray, ends: np.ndarray) -> bytes:
    """One file's bytes."""
    levels, n = pack_level(ids)
    out = io.BytesIO()
    out.write(HEADER.pack(MAGIC, VERSION, len(doc_ids), len(ids), n, 0))
    out.write(np.array([len(c) for c, _, _ in levels], dtype="<u8").tobytes())
    for chunk, bits, ranks in levels:
        out.write(chunk.tobytes())
        out.write(bits.tobytes())
        out.write(ranks.tobytes())
    out.write(doc_ids.astype("<i8").tobytes())
    out.write(nulls.astype(np.uint8).tobytes())
    out.write(ends.astype("<u8").tobytes())
    return out.getvalue()


class Reader:
    """Random access to one file's bytes (or a memory map of them)."""

    def __init__(self, data):
        magic, version, self.n_docs, self.n_tokens, n_levels, _ = HEADER.unpack_from(data, 0)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a file of directly addressable codes")
        at = HEADER.size

        def take(kind, count):
            nonlocal at
            a = np.frombuffer(data, dtype=kind, count=count, offset=at)
            at += a.nbytes
            return a

        counts = take("<u8", n_levels).tolist()
        self.levels = []
        for c in counts:
            size = -(-c // 8)
            self.levels.append((take(np.uint8, c), take(np.uint8, size),
                                take("<u8", -(-size // (RANK_BITS // 8)))))
        self.doc_ids = take("<i8", self.n_docs)
        self.nulls = take(np.uint8, self.n_docs).astype(bool)
        self.ends = take("<u8", self.n_docs).astype(np.int64)

    def rank(self, level: int, i: int) -> int:
        """Set bits before bit i of a level's bitmap."""
        _, bits, ranks = self.levels[level]
        if not len(bits):
            return 0
        block = min(i // RANK_BITS, len(ranks) - 1)
        first = block * (RANK_BITS // 8)
        n = int(ranks[block]) + int(np.bitwise_count(bits[first:i // 8]).sum())
        return n + (int(bits[i // 8]) & ((1 << i % 8) - 1)).bit_count() if i % 8 else n

    def token(self, i: int) -> int:
        """One id; reads one chunk per level."""
        value = 0
        for level, (chunks, bits, _) in enumerate(self.levels):
            value |= int(chunks[i]) << 8 * level
            if not bits[i // 8] >> i % 8 & 1:
                break
            i = self.rank(level, i)
        return value

    def tokens(self, start: int, end: int) -> np.ndarray:
        """The ids of [start, end), from their own chunks alone."""
        return self._read(0, start, end)

    def _read(self, level: int, start: int, end: int) -> np.ndarray:
        chunks, bits, _ = self.levels[level]
        out = chunks[start:end].astype(np.uint32)
        if end > start:
            first = start // 8
            more = np.unpackbits(bits[first:-(-end // 8)], bitorder="little")[start - 8 * first:end - 8 * first]
            n = int(more.sum())
            if n:
                low = self.rank(level, start)
                out[more.astype(bool)] |= self._read(level + 1, low, low + n) << np.uint32(8)
        return out


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder all executors share, and the path in it."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def write_files(docs: DataFrame, folder: str, end_id: int = 2, vocabulary: str | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and write all documents under ``folder`` (shared by all executors);
    the manifest: file, part, seq, n_docs, n_tokens, and start, the tokens before
    the file. Partitions are ranges of the id, so only ids are sampled and texts
    cross the network once."""
    path = vocabulary_path(vocabulary)
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                      F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    ranged = src.repartitionByRange(blocks(docs), F.col("doc_id").asc_nulls_first())
    ranged = ranged.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")

    def run(batches):
        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        where, base = _open(folder)
        where.create_dir(base, recursive=True)
        coder = pieces_of(path)
        held: list[tuple] = []
        seq = size = 0

        def flush():
            nonlocal held, seq, size
            ids, doc, null, n = (np.concatenate(x) for x in zip(*held))
            name = f"part-{part:06d}-{seq:06d}.dac"
            hidden = f"{base}/_{attempt}-{name}"
            with where.open_output_stream(hidden) as f:
                f.write(pack(ids, doc, null, np.cumsum(n)))
            where.move(hidden, f"{base}/{name}")
            row = pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in ((name, pa.string()), (part, pa.int64()), (seq, pa.int64()),
                                               (len(doc), pa.int64()), (len(ids), pa.int64()))],
                ["file", "part", "seq", "n_docs", "n_tokens"])
            held, seq, size = [], seq + 1, 0
            return row

        for whole in batches:
            for lo in range(0, whole.num_rows, tk.BATCH_ROWS):
                b = whole.slice(lo, tk.BATCH_ROWS)
                buf, offsets = tk.texts_of(b.column(1))
                doc = b.column(0).fill_null(0).to_numpy()
                null = b.column(0).is_null().to_numpy(zero_copy_only=False)
                for i, j, x, o in tk.passes(buf, offsets):
                    ids, n = coder.documents(x, o)
                    ids = np.insert(ids, np.cumsum(n), np.uint32(end_id))
                    held.append((ids, doc[i:j], null[i:j], n + 1))
                    size += len(ids)
                    if size >= FILE_TOKENS:
                        yield flush()
        if held:
            yield flush()
        tk.give_back_memory()

    manifest = written(ranged.mapInArrow(run, "file string, part long, seq long, n_docs long, n_tokens long"),
                       "manifest")
    # one row a file: a few million at 100 TB
    line = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(line), F.lit(0)))


def read_files(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids (array of int) of every document, from the
    files."""
    def run(batches):
        where, base = _open(folder)
        for b in batches:
            for name, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with where.open_input_file(f"{base}/{name}") as f:
                    r = Reader(f.read_buffer())
                ends = np.concatenate([[0], r.ends])
                for lo in range(0, r.n_docs, 256):
                    hi = min(lo + 256, r.n_docs)
                    ids = r.tokens(int(ends[lo]), int(ends[hi]))
                    at = ends[lo:hi + 1] - ends[lo]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(r.doc_ids[lo:hi], pa.int64(), mask=r.nulls[lo:hi]),
                         pa.array(start + ends[lo:hi]), pa.array(np.diff(ends[lo:hi + 1])),
                         pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32)))],
                        ["doc_id", "start", "n_tokens", "ids"])

    spread = manifest.select("file", "start").repartition(blocks(manifest), "file")
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids array<int>")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and checksum in the written files."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_path(spark, "tokens")
    rows = read_files(write_files(docs, folder), folder)

    def check(batch: pa.RecordBatch):
        ids = batch.column(3)
        flat = ids.values.to_numpy(zero_copy_only=False).astype("<u4")
        at = ids.offsets.to_pylist()
        crc = [zlib.crc32(flat[s:e]) for s, e in zip(at[:-1], at[1:])]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(crc, pa.int64())],
                                         ["doc_id", "start", "n_tokens", "ids_crc32"])

    return tk.map_batches(rows, check, "doc_id long, start long, n_tokens long, ids_crc32 long")
