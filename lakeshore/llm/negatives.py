"""Hard-negative mining with rotated one-bit codes (operator 13).

A row's vector is taken as integers, ``floor(scale * x)`` of every component. Its
*code* is one bit a direction: the signs of the vector after a fixed random
rotation. Stored beside it are its length and its *alignment*, the cosine between
the vector and its code. An anchor is rotated too, cut into eight bit planes, and
its product with a code is a sum of popcounts. With the alignment this estimates
the anchor's product with the row; what code and planes leave out of either vector
is orthogonal to the code or a known remainder, so Cauchy-Schwarz bounds the error
for certain. A row whose interval can't reach what an anchor still looks for is
dropped; the integer product of the others decides.

Two passes over a grid of strips of anchors and strips of rows (``strips.py``): the
first finds each anchor's positives (its best rows of the same label), the second,
knowing their scores, the best rows of other labels within a band below each.
A cell returns at most ``positives`` (times ``negatives``) rows an anchor.

Takes no part: a row whose id, label or vector is null, whose vector is empty or has
a null or non-finite component, or whose integers have a squared length of 2^62 or
more (their scores may not fit 64 bits; components of about 8 million and more at
scale 256). Vectors of different lengths never meet. Repeated ids are rows of their
own: an anchor skips itself, not other rows under its id. An empty table gives an
empty table; extra columns are never read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lakeshore.llm.store import written
from lakeshore.llm.strips import Best, finite, grid, records, rotation, strips, tiles
from lakeshore.llm.textkit import give_back_memory

#: Anchors that meet a tile of rows at once.
BLOCK = 256
#: Bits of an anchor's component in its planes.
PLANES = 8
#: Share of a block's pairs left by the intervals at which all of it is multiplied.
DENSE = 0.05
#: Rounding of the estimates, as a share of both lengths.
SLACK = 1e-9
#: Products below this are exact in double precision.
EXACT = float(1 << 52)

_TILE = "dim int, n int, rid binary, vid binary, label binary, x binary, code binary, align binary, norm binary"
_FOUND = "a int, rid long, vid long, score long, other long"


def _turn(dim: int, kept: dict = {}) -> np.ndarray:  # noqa: B006  a rotation a length and worker
    if dim not in kept:
        kept[dim] = rotation(dim)
    return kept[dim]


def codes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Integer vectors -> (sign bits in 64-bit words, alignment, length)."""
    n, dim = x.shape
    y = x.astype(np.float64) @ _turn(dim)
    norm = np.sqrt(np.einsum("ij,ij->i", y, y))
    align = np.divide(np.abs(y).sum(axis=1), norm * np.sqrt(dim), out=np.zeros(n), where=norm > 0)
    return _words(y > 0), np.minimum(align, 1.0), norm


def _words(bits: np.ndarray) -> np.ndarray:
    n, dim = bits.shape
    packed = np.zeros((n, -(-dim // 64) * 8), np.uint8)
    packed[:, :-(-dim // 8)] = np.packbits(bits, axis=1)
    return packed.view(np.uint64)


class Planes:
    """Anchors, rotated and cut into bit planes."""

    def __init__(self, x: np.ndarray):
        y = x.astype(np.float64) @ _turn(x.shape[1])
        self.dim = x.shape[1]
        self.low = y.min(axis=1)
        self.step = np.maximum(y.max(axis=1) - self.low, 1e-300) / ((1 << PLANES) - 1)
        level = np.rint((y - self.low[:, None]) / self.step[:, None])
        left = y - (self.low[:, None] + self.step[:, None] * level)
        self.left = np.sqrt(np.einsum("ij,ij->i", left, left))
        self.sum = y.sum(axis=1)
        self.norm = np.sqrt(np.einsum("ij,ij->i", y, y))
        level = level.astype(np.int64)
        self.planes = [_words(level >> k & 1 == 1) for k in range(PLANES)]

    def intervals(self, s: slice, code: np.ndarray, align: np.ndarray, norm: np.ndarray):
        """(low, high) of the products of the anchors ``s`` with coded rows."""
        count = lambda a, b: sum(np.bitwise_count(a[:, w, None].T & b[:, None, w]).astype(np.float64)
                                 for w in range(code.shape[1]))
        weighted = 0.0
        for k, plane in enumerate(self.planes):
            weighted = weighted + float(1 << k) * count(code, plane[s])
        ones = np.bitwise_count(code).sum(axis=1).astype(np.float64)
        # product with the code as a unit vector, and how far the planes may be off
        along = (2 * (self.low[s, None] * ones + self.step[s, None] * weighted)
                 - self.sum[s, None]) / np.sqrt(self.dim)
        off = 2 * self.left[s, None]
        least = np.maximum(0, np.abs(along) - off)
        across = np.sqrt(np.maximum(0, self.norm[s, None] ** 2 - least ** 2))
        half = align * norm * off + norm * np.sqrt(1 - align ** 2) * across + SLACK * self.norm[s, None] * norm
        middle = along * (align * norm)
        return middle - half, middle + half


def coded(df: DataFrame, scale: int) -> DataFrame:
    """(rid, vec_id, label, x) -> written tiles of integer vectors and their codes."""
    def pack(dim, x, rest):
        x = np.floor(x * float(scale))
        with np.errstate(over="ignore"):
            fits = np.einsum("ij,ij->i", x, x) < float(1 << 62)
        x, (rid, vid, label) = x[fits].astype(np.int64), [c[fits].astype(np.int64) for c in rest]
        if not len(x):
            return []
        code, align, norm = codes(x)
        top = np.abs(x).max()
        small = x.astype(np.int16 if top < 1 << 15 else np.int32 if top < 1 << 31 else np.int64)
        return [(dim, len(x), *(v.tobytes() for v in (rid, vid, label, small, code, align, norm)))]

    return written(tiles(df, pack, _TILE), "codes", "uncompressed")


class _Rows:
    """A tile read back."""

    def __init__(self, r: dict):
        self.dim, self.n = r["dim"], r["n"]
        self.rid, self.vid, self.label = (np.frombuffer(r[c], np.int64) for c in ("rid", "vid", "label"))
        width = len(r["x"]) // (self.n * self.dim)
        self.x = np.frombuffer(r["x"], f"i{width}").reshape(self.n, self.dim)
        self.code = np.frombuffer(r["code"], np.uint64).reshape(self.n, -1)
        self.align, self.norm = np.frombuffer(r["align"]), np.frombuffer(r["norm"])


class _Anchors:
    """A cell's anchors of one vector length."""

    def __init__(self, held: list[_Rows]):
        join = lambda name: np.concatenate([getattr(t, name) for t in held])
        self.rid, self.vid, self.label = join("rid"), join("vid"), join("label")
        self.x = np.concatenate([t.x.astype(np.int64) for t in held])
        self.planes = Planes(self.x)
        self.n = len(self.rid)


def _products(a: np.ndarray, na: np.ndarray, t: _Rows, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Integer products of anchors ``i`` and rows ``j``."""
    if len(i) > DENSE * len(a) * t.n and na.max() * t.norm.max() < EXACT:
        return (a.astype(np.float64) @ t.x.T.astype(np.float64))[i, j].astype(np.int64)
    out = np.empty(len(i), np.int64)
    for s in range(0, len(i), 1 << 14):
        out[s:s + (1 << 14)] = np.einsum("ij,ij->i", a[i[s:s + (1 << 14)]], t.x[j[s:s + (1 << 14)]].astype(np.int64))
    return out


def _cells(batches, begin, meet, end):
    """Run the cells of a grid: ``begin(anchors, extras)`` gives a state, ``meet``
    takes a tile past it, ``end`` gives what the cell returns."""
    cell, held, extra, state = None, {}, [], None
    for r in records(batches):
        if r["cell"] != cell:
            if state:
                yield from end(state)
            cell, held, extra, state = r["cell"], {}, [], None
        if r["kind"] == 0:
            held.setdefault(r["dim"], []).append(_Rows(r))
        elif r["kind"] == 1:
            extra.append(r)
        else:
            if state is None:
                state = {d: begin(_Anchors(h), extra) for d, h in held.items()}
            if r["dim"] in state:
                t = _Rows(r)
                for s in range(0, state[t.dim][0].n, BLOCK):
                    meet(state[t.dim], slice(s, min(s + BLOCK, state[t.dim][0].n)), t)
    if state:
        yield from end(state)
    give_back_memory()


def positives_of(cells: DataFrame, k: int, p: int) -> DataFrame:
    """(a, rid, vid, score, other): a cell's ``k`` best rows of each anchor's label;
    ``other`` is the row that was found."""
    def begin(anchors, _):
        return anchors, Best(anchors.n, k, np.int64)

    def meet(state, s, t):
        anchors, best = state
        _, high = anchors.planes.intervals(s, t.code, t.align, t.norm)
        keep = ((anchors.label[s, None] == t.label) & (anchors.rid[s, None] != t.rid)
                & (high >= best.least()[s, None]))
        i, j = np.nonzero(keep)
        if len(i):
            score = _products(anchors.x[s], anchors.planes.norm[s], t, i, j)
            best.add(i + s.start, score, t.vid[j], t.rid[j])

    def run(batches):
        at = [0]

        def end(state):
            for anchors, best in state.values():
                i, score, vid, rid = best.rows()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(i), at[0], np.int32)), pa.array(anchors.rid[i]), pa.array(vid),
                     pa.array(score), pa.array(rid)], ["a", "rid", "vid", "score", "other"])

        def noted(batches):
            for b in batches:
                if b.num_rows:  # a partition is a cell
                    at[0] = b.column(b.schema.get_field_index("cell"))[0].as_py() // p
                yield b

        yield from _cells(noted(batches), begin, meet, end)

    return cells.mapInArrow(run, _FOUND)


def negatives_of(cells: DataFrame, k: int, low: int, high: int) -> DataFrame:
    """(anchor, positive, score of it, row found, its id, its score): a cell's ``k``
    best rows of other labels within ``low`` to ``high`` per cent of each positive."""
    def begin(anchors, extra):
        join = lambda c: np.concatenate([np.frombuffer(r[c], np.int64) for r in extra])
        if not extra:
            return anchors, None
        rid, vid, score = join("rid"), join("vid"), join("label")
        order = np.argsort(anchors.rid)
        at = np.minimum(np.searchsorted(anchors.rid[order], rid), anchors.n - 1)
        own = anchors.rid[order][at] == rid
        owner, vid, score = order[at[own]], vid[own], score[own]
        by = np.lexsort((vid, -score, owner))
        owner, vid, score = owner[by], vid[by], score[by]
        bands = [np.array([f(int(s)) for s in score], np.int64).reshape(-1)  # exact: Python integers
                 for f in (lambda s: -(-low * s // 100), lambda s: high * s // 100)]
        first = np.searchsorted(owner, np.arange(anchors.n + 1))
        return anchors, Best(len(owner), k, np.int64), owner, vid, score, *bands, first

    def meet(state, s, t):
        if state[1] is None:
            return
        anchors, best, owner, _, _, lows, highs, first = state
        a, b = first[s.start], first[s.stop]
        if a == b:
            return
        need = np.maximum(lows[a:b], best.least()[a:b])
        own = owner[a:b] - s.start
        wide = s.stop - s.start
        floor = np.full(wide, np.iinfo(np.int64).max)
        np.minimum.at(floor, own, need)
        top = np.full(wide, np.iinfo(np.int64).min)
        np.maximum.at(top, own, highs[a:b])
        down, up = anchors.planes.intervals(s, t.code, t.align, t.norm)
        i, j = np.nonzero((anchors.label[s, None] != t.label) & (up >= floor[:, None]) & (down <= top[:, None]))
        if not len(i):
            return
        score = _products(anchors.x[s], anchors.planes.norm[s], t, i, j)
        some = (score >= floor[i]) & (score <= top[i])
        i, j, score = i[some], j[some], score[some]
        # the positives of one anchor follow each other
        of = first[s.start:s.stop + 1]
        for r in range(int(np.diff(of).max())):
            at = of[i] + r
            mine = at < of[i + 1]
            at = np.where(mine, at, 0)
            mine &= (score >= np.maximum(lows[at], best.least()[at])) & (score <= highs[at])
            best.add(at[mine], score[mine], t.vid[j[mine]], t.rid[j[mine]])

    def end(state):
        for anchors, best, *rest in state.values():
            if best is None:
                continue
            owner, vid, of = rest[0], rest[1], rest[2]
            i, score, found, rid = best.rows()
            # which of the anchor's positives: ids and scores may repeat
            nth = i - np.searchsorted(owner, owner[i])
            yield pa.RecordBatch.from_arrays(
                [pa.array(v) for v in (anchors.rid[owner[i]], anchors.vid[owner[i]], nth, vid[i], of[i], rid, found, score)],
                ["rid", "anchor_id", "nth", "positive_id", "positive_score", "other", "negative_id", "negative_score"])

    def run(batches):
        yield from _cells(batches, begin, meet, end)

    return cells.mapInArrow(run, "rid long, anchor_id long, nth long, positive_id long, positive_score long, "
                                 "other long, negative_id long, negative_score long")


def hard_negatives(rows: DataFrame, anchors, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
                   scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label") -> DataFrame:
    """Negatives of each anchor and positive: anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score. ``anchors`` is a condition on the
    id column (named ``vec_id`` there); ``low`` and ``high`` are per cent of the
    positive's score."""
    src = rows.select(F.col(f"`{vector_col}`").cast("array<double>").alias("x"),
                      F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                      F.col(f"`{label_col}`").cast("long").alias("label"))
    src = src.where(finite(F.col("x")) & F.col("vec_id").isNotNull() & F.col("label").isNotNull())
    src = src.withColumn("anchor", F.coalesce(anchors, F.lit(False)))
    numbered = src.select("x", F.monotonically_increasing_id().alias("rid"), "vec_id", "label", "anchor")
    kept = written(numbered, "rows")
    cols = ["x", "rid", "vec_id", "label"]
    table = coded(kept.select(*cols), scale)
    chosen = coded(kept.where("anchor").select(*cols), scale)
    size = lambda df: int(df.agg(F.sum(F.col("n").cast("double") * F.col("dim") * 8)).first()[0] or 0)
    q, p = strips(size(chosen), size(table))
    strip = lambda n: F.pmod(F.xxhash64("rid"), F.lit(n)).cast("int")
    chosen, table = chosen.withColumn("a", strip(q)), table.withColumn("g", strip(p))

    found = written(positives_of(grid(chosen, table, q, p), positives, p), "positives")
    rank = Window.partitionBy("rid").orderBy(F.desc("score"), "vid", "other")
    best = found.withColumn("r", F.row_number().over(rank)).where(F.col("r") <= positives)

    def pack(t: pa.Table) -> pa.Table:
        data = [t[c].to_numpy().tobytes() for c in ("rid", "vid", "score")]
        none = b""
        return pa.table({"a": pa.array([t["a"][0].as_py()], pa.int32()), "dim": pa.array([0], pa.int32()),
                         "n": pa.array([t.num_rows], pa.int32()),
                         **{c: pa.array([v], pa.binary()) for c, v in
                            zip(("rid", "vid", "label", "x", "code", "align", "norm"), (*data, none, none, none, none))}})

    # at most `positives` rows for each anchor of a strip
    extra = best.select("a", "rid", "vid", "score").groupBy("a").applyInArrow(pack, f"a int, {_TILE}")
    last = written(negatives_of(grid(chosen, table, q, p, extra), negatives, low, high), "negatives")
    rank = Window.partitionBy("rid", "nth").orderBy(F.desc("negative_score"), "negative_id", "other")
    return (last.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
                    "positive_score", "negative_score"))


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """Anchors are ids divisible by 50; ids divisible by 7 take the next label first."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select("vec_id", "embedding", label.alias("label")), F.col("vec_id") % 50 == 0)


OP13_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding::DOUBLE[], lambda e: floor(256 * e)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len([e FOR e IN embedding IF e IS NULL OR NOT isfinite(e)]) = 0),
pairs AS (
  SELECT a.rid, a.vec_id AS anchor_id, b.rid AS other, b.vec_id AS vid, a.label = b.label AS same,
    list_dot_product(a.x, b.x)::BIGINT AS score
  FROM v a JOIN v b ON a.rid <> b.rid AND len(a.x) = len(b.x) WHERE a.vec_id % 50 = 0),
pos AS (
  SELECT * FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY score DESC, vid, other) <= 5)
SELECT p.anchor_id, p.vid AS positive_id,
  row_number() OVER (PARTITION BY p.rid, p.other ORDER BY n.score DESC, n.vid, n.other)::INTEGER AS rank,
  n.vid AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM pos p JOIN pairs n ON n.rid = p.rid AND NOT n.same
  AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY row_number() OVER (PARTITION BY p.rid, p.other ORDER BY n.score DESC, n.vid, n.other) <= 3
"""
