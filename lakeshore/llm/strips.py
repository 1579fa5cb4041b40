"""Queries against all rows in strips, for operators 11 and 13.

Rows and queries travel as *tiles*: records whose binary columns hold up to
``TILE`` rows. The plane of queries x rows is cut into strips of queries (bounded
bytes, held by a task) and strips of rows (streamed past them, a tile at a time);
a cell of the grid is a task's work. So every row is sent once per strip of
queries and every query once per strip of rows; what comes back is a bounded list
for each query and cell.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lakeshore.llm.textkit import give_back_memory

#: Rows of one tile.
TILE = 1024
#: Bytes of vectors (as doubles) in a strip of queries, which a task holds.
QUERY_STRIP = 32 << 20
#: Bytes of vectors in a strip of rows, which pass by; and the least number of cells.
ROW_STRIP = 256 << 20
LEAST_CELLS = 16


def finite(x: Column) -> Column:
    """True for vectors with at least one component, all of them finite."""
    return F.coalesce((F.size(x) > 0) & F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))


def tiles(df: DataFrame, pack: Callable[[int, np.ndarray, list[np.ndarray]], list[tuple]],
          schema: str, size: int = TILE) -> DataFrame:
    """``df`` (x array<double>, other numeric columns) as tiles, within the tasks
    that read it: ``pack(dim, x, others)`` gives the records of up to ``size``
    vectors of one length; ``schema`` names their columns."""
    def run(batches):
        held: dict[int, list] = {}

        def out(dim, part):
            x = np.concatenate([p[0] for p in part])
            rest = [np.concatenate(c) for c in zip(*[p[1] for p in part])]
            for i in range(0, len(x), size):
                records = pack(dim, x[i:i + size], [c[i:i + size] for c in rest])
                if records:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(c), t) for c, t in zip(zip(*records), types)], names)

        for b in batches:
            lens = pa.compute.list_value_length(b.column(0)).to_numpy()
            for d in np.unique(lens).tolist():
                pick = pa.array(lens == d)
                x = b.column(0).filter(pick).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
                rest = [c.filter(pick).to_numpy(zero_copy_only=False) for c in b.columns[1:]]
                held.setdefault(d, []).append((x, rest))
                if sum(len(p[0]) for p in held[d]) >= size:
                    yield from out(d, held.pop(d))
        for d, part in held.items():
            yield from out(d, part)
        give_back_memory()

    fields = [f.strip().split(" ") for f in schema.split(",")]
    names = [f[0] for f in fields]
    arrow = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    types = [arrow[f[1]] for f in fields]
    return df.mapInArrow(run, schema)


def strips(query_bytes: int, row_bytes: int) -> tuple[int, int]:
    """(strips of queries, strips of rows) for so many bytes of vectors."""
    q = max(1, -(-query_bytes // QUERY_STRIP))
    return q, max(-(-LEAST_CELLS // q), -(-row_bytes // ROW_STRIP))


def grid(queries: DataFrame, rows: DataFrame, q: int, p: int, extra: DataFrame | None = None) -> DataFrame:
    """Cells of the grid, one a partition: (cell, kind, ...) with a cell's query
    tiles (kind 0) and what else belongs to them (kind 1) before its row tiles
    (kind 2). ``queries`` and ``extra`` have their strip of queries in ``a``,
    ``rows`` theirs in ``g``; all have the same other columns."""
    every = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    rest = [c for c in rows.columns if c != "g"]
    parts = [queries.select("a", every(p, "g"), F.lit(0).alias("kind"), *rest)]
    if extra is not None:
        parts.append(extra.select("a", every(p, "g"), F.lit(1).alias("kind"), *rest))
    parts.append(rows.select(every(q, "a"), "g", F.lit(2).alias("kind"), *rest))
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part)
    cell = (F.col("a") * p + F.col("g")).cast("int")
    both = both.withColumn("cell", cell).drop("a", "g")
    return both.repartitionById(p * q, F.col("cell")).sortWithinPartitions("cell", "kind")


def records(batches) -> Iterator[dict]:
    """The rows of Arrow batches as dictionaries, one held at a time."""
    for b in batches:
        for r in range(b.num_rows):
            yield {n: c[r].as_py() for n, c in zip(b.schema.names, b.columns)}


class Best:
    """The ``k`` best rows of each of ``n`` queries: highest score first, ties by
    smaller id, then by row."""

    def __init__(self, n: int, k: int, kind):
        least = -np.inf if np.dtype(kind).kind == "f" else np.iinfo(kind).min
        self.k, self.score = k, np.full((n, k), least, kind)
        self.vid, self.rid = np.zeros((n, k), np.int64), np.full((n, k), -1, np.int64)

    def least(self) -> np.ndarray:
        """The score that a row must reach, for each query."""
        return self.score[:, -1]

    def add(self, i: np.ndarray, score: np.ndarray, vid: np.ndarray, rid: np.ndarray) -> None:
        own = score >= self.score[i, -1]
        i, score, vid, rid = i[own], score[own], vid[own], rid[own]
        if not len(i):
            return
        some = np.unique(i)
        kept = self.rid[some] >= 0
        at = np.repeat(some, self.k).reshape(len(some), self.k)[kept]
        i = np.concatenate([at, i])
        score = np.concatenate([self.score[some][kept], score])
        vid = np.concatenate([self.vid[some][kept], vid])
        rid = np.concatenate([self.rid[some][kept], rid])
        order = np.lexsort((rid, vid, -score, i))
        i = i[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        first = rank < self.k
        order, i, rank = order[first], i[first], rank[first]
        self.score[i, rank], self.vid[i, rank], self.rid[i, rank] = score[order], vid[order], rid[order]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(query, score, id, row) of all that is kept."""
        i, r = np.nonzero(self.rid >= 0)
        return i, self.score[i, r], self.vid[i, r], self.rid[i, r]


def rotation(dim: int, seed: int = 1) -> np.ndarray:
    """A fixed random rotation of vectors of this length."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))
