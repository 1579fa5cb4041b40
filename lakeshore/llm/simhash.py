"""SimHash near-dedup by tiled exact comparison (operator 1).

Fingerprints are made per document from XXH64 hashes of word shingles. Equal
fingerprints are one node. Nodes are cut into tiles by *population counts*: the
bit counts of the four 16-bit quarters (at most 17^4 = 83,521 cells), a crowded
cell into several tiles by hash. Quarter counts that differ by more than the
radius in all cannot be within the radius, so those tile pairs are never formed;
the others are compared exactly with numpy exclusive-or and bit counts. A pair
of tiles gives a spanning forest of its links, never all pairs, and components
are found by Spark jobs.

Nulls, empty tables, ties: a null or empty text has fingerprint zero, linked
like any other; rows that repeat a doc_id each get their own fingerprint; a null
doc_id is linked but names no component (a component of null ids only has a null
id); an empty table gives an empty table. Extra columns are never read.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from lakeshore.llm import textkit as tk
from lakeshore.llm.components import components, forest
from lakeshore.llm.store import written

#: Fingerprints of a tile at most, on average: two tiles and their exclusive-or fit a pass.
TILE = 4096
#: Cells of one numpy comparison.
CELLS = 1 << 21


def fingerprints_of(buf, offsets, shingle: int = 3) -> np.ndarray:
    """uint64 fingerprints of the documents in one byte buffer (see textkit)."""
    buf = tk.LOWER[buf]
    words = tk.Words(buf, offsets, tk.NOT_SPACE)
    n_docs = len(offsets) - 1
    out = np.zeros(n_docs, dtype=np.uint64)
    if not len(words):
        return out
    # words joined by one space each, all documents in one string
    lens = words.ends - words.starts
    at = np.zeros(len(lens) + 1, dtype=np.int64)
    np.cumsum(lens + 1, out=at[1:])
    flat = np.full(at[-1], 0x20, dtype=np.uint8)
    inside = np.arange(int(lens.sum())) - np.repeat(np.cumsum(lens) - lens, lens)
    flat[np.repeat(at[:-1], lens) + inside] = buf[np.repeat(words.starts, lens) + inside]
    counts = np.diff(words.first)
    has = np.flatnonzero(counts)
    number = np.maximum(counts[has] - shingle + 1, 1)  # a short document is one shingle
    begin = np.cumsum(number) - number
    first = np.repeat(words.first[:-1][has], number) + (np.arange(number.sum()) - np.repeat(begin, number))
    last = np.minimum(first + shingle, np.repeat(words.first[1:][has], number)) - 1
    text, digest = flat.tobytes(), xxhash.xxh64_intdigest
    h = np.fromiter((digest(text[s:e], 42) for s, e in
                     zip(at[first].tolist(), (at[last] + lens[last]).tolist())),
                    dtype=np.uint64, count=len(first))
    step = 1 << 15
    ends = begin + number
    ones = np.zeros((len(has), 64), dtype=np.int64)
    for lo in range(0, len(h), step):  # shingles in runs: a long text needs no more room
        hi = min(lo + step, len(h))
        bits = np.unpackbits(h[lo:hi].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        d0, d1 = np.searchsorted(ends, lo, side="right"), np.searchsorted(begin, hi)
        cuts = np.maximum(begin[d0:d1], lo) - lo
        for d, s, e in zip(range(d0, d1), cuts.tolist(), [*cuts[1:].tolist(), hi - lo]):
            ones[d] += bits[s:e].sum(axis=0, dtype=np.int32)
    major = (2 * ones > number[:, None]).astype(np.uint8)
    out[has] = np.packbits(major, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, fp long) of every row: the 64 bits as a signed long."""
    def run(batch: pa.RecordBatch):
        buf, offsets = tk.texts_of(batch.column(1))
        parts = [fingerprints_of(b, o, shingle) for _, _, b, o in tk.passes(buf, offsets)]
        fp = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(fp.view(np.int64))],
                                         ["doc_id", "fp"])

    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                      F.col(f"`{text_col}`").alias("text"))
    return tk.map_batches(src, run, "doc_id long, fp long")


def _tiles(nodes: DataFrame) -> DataFrame:
    """(cell, p0..p3, tile, fps): node fingerprints by quarter bit counts."""
    quarter = [F.bit_count(F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF)))
               .cast("int") for i in range(4)]
    cell = quarter[0]
    for q in quarter[1:]:
        cell = cell * 17 + q
    nodes = nodes.select("fp", cell.alias("cell"))
    # at most 17^4 rows whatever the input: bounded, so broadcast
    crowd = nodes.groupBy("cell").agg(F.ceil(F.count("*") / TILE).alias("n"))
    nodes = nodes.join(F.broadcast(crowd), "cell")
    return (nodes.withColumn("tile", F.pmod(F.xxhash64("fp"), "n").cast("int"))
            .groupBy("cell", "tile").agg(F.collect_list("fp").alias("fps")))


def links(nodes: DataFrame, radius: int) -> DataFrame:
    """(u, v) links that join all nodes (fp long, distinct) within ``radius`` bits."""
    tiles = written(_tiles(nodes), "tiles")
    steps = [s for s in itertools.product(range(-radius, radius + 1), repeat=4)
             if sum(map(abs, s)) <= radius and s >= (0, 0, 0, 0)]
    moves = F.array(*[F.struct(*[F.lit(x).alias(f"s{i}") for i, x in enumerate(s)]) for s in steps])
    there = F.broadcast(tiles.select(F.col("cell").alias("to")).distinct())  # at most 17^4 rows
    p = [F.floor(F.col("cell") / 17 ** (3 - i)).cast("int") % 17 for i in range(4)]
    pairs = tiles.select("cell", "tile").distinct()
    q = [p[i] + F.col(f"move.s{i}") for i in range(4)]
    ok = F.lit(True)
    for x in q:
        ok = ok & x.between(0, 16)
    # which tile meets which cell: narrow rows; the tiles themselves follow by joins
    meet = (pairs.withColumn("move", F.explode(moves)).where(ok)
            .select("cell", "tile", (((q[0] * 17 + q[1]) * 17 + q[2]) * 17 + q[3]).alias("to"))
            .join(there, "to"))
    left = meet.join(tiles.select("cell", "tile", F.col("fps").alias("a")), ["cell", "tile"])
    right = tiles.select(F.col("cell").alias("to"), F.col("tile").alias("to_tile"), F.col("fps").alias("b"))
    both = (left.join(right, "to")
            .where("to != cell or to_tile >= tile")
            .select((F.expr("to = cell and to_tile = tile")).alias("own"), "a", "b"))

    def run(batch: pa.RecordBatch):
        own = batch.column(0).to_pylist()
        a, b = batch.column(1), batch.column(2)
        av, bv = (x.values.to_numpy(zero_copy_only=False).view(np.uint64) for x in (a, b))
        ao, bo = a.offsets.to_numpy(), b.offsets.to_numpy()
        us, vs = [], []
        for k, same in enumerate(own):
            x, y = av[ao[k]:ao[k + 1]], bv[bo[k]:bo[k + 1]]
            rows = max(1, CELLS // max(1, len(y)))
            ii, jj = [], []
            for lo in range(0, len(x), rows):
                i, j = np.nonzero(np.bitwise_count(x[lo:lo + rows, None] ^ y[None, :]) <= radius)
                if same:
                    up = i + lo < j
                    i, j = i[up], j[up]
                if len(i):  # thinned here: a crowd of near copies has few links left
                    i, j = forest(i + lo, j + len(x) if not same else j)
                    ii.append(i)
                    jj.append(j)
            if ii:
                i, j = forest(np.concatenate(ii), np.concatenate(jj))
                z = x if same else np.concatenate([x, y])
                us.append(z[i])
                vs.append(z[j])
        if us:
            u, v = np.concatenate(us).view(np.int64), np.concatenate(vs).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return tk.map_batches(both, run, "u long, v long", rows=4096)


def simhash_components(docs: DataFrame, shingle: int = 3, radius: int = 3,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fp (long), fingerprint (16 hex digits) and
    component_id, the smallest doc_id that can be reached by links of at most
    ``radius`` differing bits."""
    rows = written(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    nodes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    found = components(links(nodes.select("fp"), radius))
    named = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = written(named.join(least, "root").select("fp", "component_id"), "named")
    return rows.join(named, "fp").select(
        "doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op1_simhash_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and near-duplicate component."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return simhash_components(docs, shingle=3, radius=3).select(
        "doc_id", "fingerprint", "component_id")
