"""Approximate nearest neighbours by an adaptive dimension scan (operator 11).

Rows are dealt to *lists* by their nearest centroid (spherical k-means, fitted on at
most ``FIT_ROWS`` rows, chosen by hash); every row is in one list. Unit vectors are
turned by a fixed random rotation and stored in blocks of columns. A query looks
through the lists whose centroids are nearest to it. Inside a list it scans block by
block: after each one, a row's partial distance, scaled to the whole length, is
tested against the query's fifth-best distance so far, with a margin that shrinks
with the columns seen; a row that fails is abandoned, a row that passes every test
is scored exactly on the vectors as given.

How many lists are probed is measured, not set: ``TRIAL_QUERIES`` of the queries (by
hash) are first compared with every row, and the share of lists is the least one
that holds ``TARGET`` of their true neighbours. On data without clusters that is
most of the lists. A query always probes lists with more rows than it returns.

Rows that are null, empty, zero or hold null or non-finite components take no part,
nor do rows with a null id; vectors meet only vectors of their own length. Repeated
ids are rows of their own: a query skips itself, not other rows under its id. Fewer
than ``k`` candidates are all returned; an empty table gives an empty table. Extra
columns are never read. Vectors are scaled by powers of two, so that very large and
very small components score like others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lakeshore.llm.store import written
from lakeshore.llm.strips import Best, finite, grid, records, rotation, strips, tiles
from lakeshore.llm.textkit import give_back_memory

#: Rows that centroids are fitted on, and bytes of them; lists at most; k-means rounds.
FIT_ROWS, FIT_BYTES = 16384, 16 << 20
MOST_LISTS = 1024
ROUNDS = 8
#: Queries that the number of probed lists is measured with, and the share of their
#: true neighbours that the lists must hold.
TRIAL_QUERIES = 64
TARGET = 0.97
#: Columns of a block, and the margin of the tests: a row is abandoned at d columns if
#: its scaled partial distance is beyond (1 + MARGIN / sqrt(d))^2 times the fifth best.
COLUMNS = 16
MARGIN = 2.1
#: Queries that meet a tile at once; share of pairs left below which they are followed
#: one by one.
BLOCK = 256
DENSE = 0.1
#: Rounding of distances between rotated vectors, kept in single precision.
SLACK = 1e-5


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two each: the largest component lies in 0.5 to 1."""
    _, e = np.frexp(np.abs(x).max(axis=1))
    return np.ldexp(x, -e[:, None])


def lengths(x: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", x, x))


def unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / lengths(x)[:, None]


def fit(x: np.ndarray, lists: int) -> np.ndarray:
    """Centroids of unit vectors by cosine, as unit rows."""
    centre = x[np.linspace(0, len(x) - 1, lists).astype(int)].copy()
    for _ in range(ROUNDS):
        near = np.concatenate([(x[i:i + 2048] @ centre.T).argmax(axis=1) for i in range(0, len(x), 2048)])
        sums = np.zeros_like(centre)
        np.add.at(sums, near, x)
        size = lengths(sums)
        centre[size > 0] = sums[size > 0] / size[size > 0, None]
    return centre


class Index:
    """Centroids of each vector length, and how many lists to probe."""

    def __init__(self, centres: dict[int, np.ndarray]):
        self.centres, self.sizes, self.share = centres, {}, 1.0

    def lists(self, x: np.ndarray) -> np.ndarray:
        """The list of each unit vector; a length without centroids is one list."""
        centre = self.centres.get(x.shape[1])
        if centre is None:
            return np.zeros(len(x), np.int64)
        return np.concatenate([(x[i:i + 2048] @ centre.T).argmax(axis=1) for i in range(0, len(x), 2048)])

    def order(self, x: np.ndarray) -> np.ndarray:
        """For each unit vector all lists, nearest centroid first."""
        centre = self.centres.get(x.shape[1])
        return np.zeros((len(x), 1), np.int64) if centre is None else np.argsort(-(x @ centre.T), axis=1, kind="stable")

    def probes(self, x: np.ndarray, k: int) -> np.ndarray:
        """(vectors x lists): which lists each one looks through."""
        out = []
        for i in range(0, len(x), 2048):
            order = self.order(x[i:i + 2048])
            lists = order.shape[1]
            sizes = np.zeros(lists, np.int64)
            for at, n in self.sizes.get(x.shape[1], {0: k + 1}).items():
                sizes[at] = n
            few = (np.cumsum(sizes[order], axis=1) <= k).sum(axis=1) + 1  # itself is among them
            need = np.maximum(few, int(np.ceil(self.share * lists)))
            own = np.zeros(order.shape, bool)
            np.put_along_axis(own, order, np.arange(lists) < need[:, None], axis=1)
            out.append(own)
        return np.concatenate(out)


def _cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x, y) / (lengths(x) * lengths(y))


def by_hash(rows: DataFrame, n: int, most: int) -> list:
    """(rid, x) of about ``most`` of the ``n`` rows, those of least hash, in its
    order; what reaches the driver is no more than a few rows beyond that."""
    at = F.pmod(F.xxhash64("rid"), F.lit(1 << 30))
    below = (1 << 30) if n <= most else int((1 << 30) * (most + 3 * most ** 0.5) / n) + 1
    found = rows.where(at < below).select(at.alias("at"), "rid", "x").collect()
    return [(rid, x) for _, rid, x in sorted(found, key=lambda r: (r[0], r[1]))[:most]]


def trained(rows: DataFrame, n: int, widest: int) -> Index:
    """An index fitted on a sample of ``rows`` (x, rid): the rows of least hash."""
    most = max(1, min(FIT_ROWS, FIT_BYTES // (8 * max(widest, 1))))
    by: dict[int, list] = {}
    for _, x in by_hash(rows, n, most):
        by.setdefault(len(x), []).append(x)
    total = sum(map(len, by.values()))
    centres = {}
    for d, part in by.items():
        lists = int(round((n * len(part) / max(total, 1)) ** 0.5))
        centres[d] = fit(unit(np.array(part, np.float64)), max(1, min(lists, MOST_LISTS, -(-len(part) // 8))))
    return Index(centres)


_TILE = "dim int, list int, n int, rid binary, vid binary, x binary, blocks binary"


def listed(rows: DataFrame, index: Index, n: int) -> DataFrame:
    """Written tiles of ``rows`` (x, rid, vec_id), each of one list: vectors as given
    and, rotated and in blocks of columns, as unit vectors."""
    def deal(batches):
        for b in batches:
            lens = pa.compute.list_value_length(b.column(0)).to_numpy()
            at = np.zeros(len(lens), np.int32)
            for d in np.unique(lens).tolist():
                x = b.column(0).filter(pa.array(lens == d)).flatten().to_numpy(zero_copy_only=False)
                at[lens == d] = index.lists(unit(x.reshape(-1, d)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(lens.astype(np.int32)), pa.array(at), b.column(1), b.column(2)],
                ["x", "dim", "list", "rid", "vec_id"])

    dealt = rows.select("x", "rid", "vec_id").mapInArrow(deal, "x array<double>, dim int, list int, rid long, vec_id long")
    dealt = written(dealt, "dealt")
    # ranges over (list, row): a list of any size is cut by rows, whatever its share
    ranged = (dealt.repartitionByRange(max(1, -(-n // 4096)), "dim", "list", "rid")
              .sortWithinPartitions("dim", "list", "rid").select("x", "rid", "vec_id", "list"))

    def pack(dim, x, rest):
        rid, vid, at = rest
        turned = (unit(x) @ rotation_of(dim)).astype(np.float32)
        out = []
        cuts = np.flatnonzero(np.diff(at, prepend=at[0] - 1, append=at[-1] + 1))
        for i, j in zip(cuts[:-1], cuts[1:]):
            own = x[i:j].astype(np.float32)
            own = own if (own == x[i:j]).all() else x[i:j]
            blocks = b"".join(np.ascontiguousarray(turned[i:j, c:c + COLUMNS]).tobytes() for c in range(0, dim, COLUMNS))
            out.append((dim, int(at[i]), int(j - i), rid[i:j].astype(np.int64).tobytes(),
                        vid[i:j].astype(np.int64).tobytes(), own.tobytes(), blocks))
        return out

    return written(tiles(ranged, pack, _TILE), "lists", "uncompressed")


def rotation_of(dim: int, kept: dict = {}) -> np.ndarray:  # noqa: B006  one a length and worker
    if dim not in kept:
        kept[dim] = rotation(dim, 2)
    return kept[dim]


class _Tile:
    def __init__(self, r: dict):
        self.dim, self.list, self.n = r["dim"], r["list"], r["n"]
        self.rid, self.vid = np.frombuffer(r["rid"], np.int64), np.frombuffer(r["vid"], np.int64)
        kind = np.float32 if len(r["x"]) == 4 * self.n * self.dim else np.float64
        self.x = np.frombuffer(r["x"], kind).reshape(self.n, self.dim)
        self.data = r["blocks"]

    def blocks(self):
        """(first column, end, rows x columns), in order."""
        whole = np.frombuffer(self.data, np.float32)
        for c in range(0, self.dim, COLUMNS):
            e = min(c + COLUMNS, self.dim)
            yield c, e, whole[self.n * c:self.n * e].reshape(self.n, e - c)


def scan(queries: np.ndarray, t: _Tile, limit: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, row of the tile) that no test abandons. ``queries`` are rotated
    unit vectors, ``limit`` their squared distances to beat (infinite: not yet k)."""
    dim, total, i, j = t.dim, np.zeros((len(queries), t.n), np.float32), None, None
    for c, e, rows in t.blocks():
        q = queries[:, c:e]
        bound = limit * (1 + MARGIN / np.sqrt(e)) ** 2 * (e / dim) if e < dim else limit
        bound = (bound + SLACK).astype(np.float32)
        if i is None:
            total += (np.einsum("ij,ij->i", q, q)[:, None] + np.einsum("ij,ij->i", rows, rows)) - 2 * (q @ rows.T)
            left = total <= bound[:, None]
            if left.sum() <= DENSE * left.size:
                i, j = np.nonzero(left)
                total = total[i, j]
        else:
            step = q[i] - rows[j]
            total = total + np.einsum("ij,ij->i", step, step)
            left = total <= bound[i]
            i, j, total = i[left], j[left], total[left]
    if i is None:
        if t.n > k:  # no more than the k nearest of this tile, and what may tie with them
            kth = np.partition(total, k, axis=1)[:, k]
            left &= total <= kth[:, None] + 2 * np.float32(SLACK)
        i, j = np.nonzero(left)
    return i, j


def trial(table: DataFrame, queries: DataFrame, n: int, index: Index, k: int) -> float:
    """The least share of lists that holds ``TARGET`` of the true neighbours of
    ``TRIAL_QUERIES`` of the ``n`` queries, found by comparing them with every row."""
    asked = [(rid, np.array(x, np.float64)) for rid, x in by_hash(queries, n, TRIAL_QUERIES)]
    by: dict[int, list[int]] = {}
    for at, (_, x) in enumerate(asked):
        by.setdefault(len(x), []).append(at)

    def run(batches):
        best = Best(len(asked), k, np.float64)
        for r in records(batches):
            t = _Tile(r)
            own = np.array(by.get(t.dim, []), np.int64)
            if not len(own):
                continue
            cosine = unit(np.array([asked[a][1] for a in own])) @ unit(t.x.astype(np.float64)).T
            cosine[np.array([asked[a][0] for a in own])[:, None] == t.rid] = -np.inf
            i, j = np.nonzero((cosine >= best.least()[own][:, None]) & (cosine > -np.inf))
            best.add(own[i], cosine[i, j], t.vid[j], np.full(len(j), t.list))
        i, score, vid, at = best.rows()
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (i, score, vid, at)], ["q", "score", "vid", "list"])

    found = table.mapInArrow(run, "q long, score double, vid long, list long")
    rank = Window.partitionBy("q").orderBy(F.desc("score"), "vid")
    found = found.withColumn("r", F.row_number().over(rank)).where(F.col("r") <= k).collect()  # k rows a trial query
    place = []
    for r in found:
        order = index.order(unit(asked[r["q"]][1][None, :]))[0]
        place.append((int(np.flatnonzero(order == r["list"])[0]) + 1) / len(order))
    return float(np.sort(place)[min(len(place) - 1, int(np.ceil(TARGET * len(place))))]) if place else 1.0


def nearest(rows: DataFrame, queries, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` nearest rows found for each query by cosine: query_id, rank, vec_id,
    score. ``queries`` is a condition on the id column (named ``vec_id`` there)."""
    src = rows.select(F.col(f"`{vector_col}`").cast("array<double>").alias("x"),
                      F.col(f"`{id_col}`").cast("long").alias("vec_id"))
    src = src.where(finite(F.col("x")) & F.exists("x", lambda v: v != 0) & F.col("vec_id").isNotNull())
    kept = written(src.select("x", F.monotonically_increasing_id().alias("rid"), "vec_id",
                              F.coalesce(queries, F.lit(False)).alias("query")), "rows")
    size = F.size("x").cast("long")
    n, widest, row_bytes, query_bytes, query_count = (int(v or 0) for v in kept.agg(
        F.count("*"), F.max(size), F.sum(8 * size), F.sum(F.when(F.col("query"), 8 * size)),
        F.count_if("query")).first())
    index = trained(kept, n, widest)
    table = listed(kept, index, n)
    asked = kept.where("query").select("x", "rid", "vec_id")
    index.share = trial(table, asked, query_count, index, k)
    counts = table.where(F.col("dim").isin(list(index.centres))).groupBy("dim", "list").agg(F.sum("n"))
    for d, at, held in counts.collect():  # a row a list: at most MOST_LISTS of each fitted length
        index.sizes.setdefault(d, {})[at] = held

    def pack(dim, x, rest):
        rid, vid = rest
        return [(dim, -1, len(x), rid.astype(np.int64).tobytes(), vid.astype(np.int64).tobytes(), x.tobytes(), b"")]

    q, p = strips(query_bytes, row_bytes)
    strip = lambda m: F.pmod(F.xxhash64("rid"), F.lit(m)).cast("int")
    cells = grid(tiles(asked, pack, _TILE).withColumn("a", strip(q)), table.withColumn("g", strip(p)), q, p)

    def run(batches):
        cell, held, state = None, {}, None

        def begin(part):
            x = np.concatenate([np.frombuffer(r["x"]).reshape(-1, r["dim"]) for r in part])
            join = lambda c: np.concatenate([np.frombuffer(r[c], np.int64) for r in part])
            one = unit(x)
            return (scaled(x), join("rid"), join("vid"), (one @ rotation_of(x.shape[1])).astype(np.float32),
                    index.probes(one, k), Best(len(x), k, np.float64))

        def end():
            for _, rid, vid, _, _, best in (state or {}).values():
                i, score, found, row = best.rows()
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in (rid[i], vid[i], found, row, score)],
                                                 ["rid", "query_id", "vec_id", "other", "score"])

        for r in records(batches):
            if r["cell"] != cell:
                yield from end()
                cell, held, state = r["cell"], {}, None
            if r["kind"] == 0:
                held.setdefault(r["dim"], []).append(r)
                continue
            if state is None:
                state, held = {d: begin(part) for d, part in held.items()}, {}
            if r["dim"] not in state:
                continue
            t = _Tile(r)
            x, rid, _, turned, probes, best = state[t.dim]
            y = scaled(t.x.astype(np.float64))
            asking = np.flatnonzero(probes[:, t.list])
            for s in range(0, len(asking), BLOCK):
                own = asking[s:s + BLOCK]
                least = best.least()[own]
                i, j = scan(turned[own], t, np.where(np.isfinite(least), 2 - 2 * least, np.inf), k)
                other = rid[own[i]] != t.rid[j]
                i, j = own[i[other]], j[other]
                for c in range(0, len(i), 1 << 14):
                    a, b = i[c:c + (1 << 14)], j[c:c + (1 << 14)]
                    best.add(a, _cosine(x[a], y[b]), t.vid[b], t.rid[b])
        yield from end()
        give_back_memory()

    found = written(cells.mapInArrow(run, "rid long, query_id long, vec_id long, other long, score double"), "nearest")
    rank = Window.partitionBy("rid").orderBy(F.desc("score"), "vec_id", "other")
    return (found.withColumn("rank", F.row_number().over(rank).cast("int")).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op11_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    """The 5 nearest rows found for every row whose id is divisible by 50."""
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0, 5)
