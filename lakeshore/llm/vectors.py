"""Embedding near-dedup by PCA-ordered tiled comparison (operator 8).

Distinct vectors are nodes. Directions are ordered by the second-moment matrix of
all unit vectors (its eigenvectors, largest first; d x d numbers reach the
driver, whatever the number of rows). Nodes are cut into tiles by ranges of the
first direction. A pair of tiles that is compared accumulates the leading directions
first: the rest of a product is at most the product of the two suffix norms, so cells
whose bound stays below the threshold stop there, stage by stage; tiles whose ranges
lie too far apart for the threshold are not compared. What is left is decided in
double precision on the vectors as given.

Tiles meet in a grid: neighbouring tiles form strips of bounded bytes, and a cell of
the grid, one task, holds one strip while the tiles of another pass by. With s strips
a tile is sent s + 1 times (not once for each tile that it meets), and s grows by one
for every ``STRIP_BYTES`` of vectors.

A pair of tiles returns link counts and a spanning forest of its links, never the
pairs; components are found by Spark jobs.

A vector that is null, empty, zero or holds null or non-finite components links
with nothing; vectors of different lengths do not link; equal vectors link with
each other. Repeated vec_ids are rows of their own; a component of null ids has a
null id and keeps nothing (``kept`` is null). An empty table gives an empty table.
Extra columns are never read. Vectors are scaled by powers of two, which changes no
cosine, so any magnitude of finite components will do.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakeshore.llm.components import components, forest
from lakeshore.llm.search import scaled
from lakeshore.llm.store import written
from lakeshore.llm.strips import records
from lakeshore.llm.textkit import give_back_memory

#: Nodes of a tile, on average; two tiles of d doubles a node are a task's input.
TILE = 4096
#: Bytes of vectors in a strip, which a task holds (three times), and the least number
#: of strips, so that there are tasks enough.
STRIP_BYTES, LEAST_STRIPS = 32 << 20, 5
#: Rows of one tile that meet the other at once.
STRIP = 512
#: Directions accumulated before each look at the bound.
STAGES = (12, 32)
#: Share of cells left at which the whole strip is multiplied instead.
DENSE = 0.05
#: Products are rounded; cells this near the threshold are decided one by one.
SLACK = 1e-9


def _unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def directions(nodes: DataFrame) -> dict[int, np.ndarray]:
    """{vector length: orthonormal directions as columns, most weight first}."""
    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            dims = b.column(0).to_numpy()
            for d in np.unique(dims).tolist():
                x = b.column(1).filter(pa.array(dims == d)).flatten().to_numpy().reshape(-1, d)
                x = _unit(x)
                sums[d] = sums.get(d, 0) + x.T @ x
        for d, s in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(d * d, d, np.int32)), pa.array(np.arange(d * d, dtype=np.int32)),
                 pa.array(s.ravel())], ["dim", "cell", "x"])

    cells = (nodes.select("dim", "x").mapInArrow(run, "dim int, cell int, x double")
             .groupBy("dim", "cell").agg(F.sum("x").alias("x")))
    moment: dict[int, np.ndarray] = {}
    for dim, cell, x in cells.collect():  # dim^2 numbers of each length
        moment.setdefault(dim, np.zeros(dim * dim))[cell] = x
    return {d: np.linalg.eigh(m.reshape(d, d))[1][:, ::-1].copy() for d, m in moment.items()}


class _Tile:
    """A tile read back; ``basis``: the directions of its vectors' length."""

    def __init__(self, r: dict, basis: dict[int, np.ndarray]):
        self.tile, self.dim = r["tile"], r["dim"]
        self.angles = [float(np.arccos(min(1.0, max(-1.0, r[c])))) for c in ("high", "low")]
        self.ids, self.rows = np.frombuffer(r["ids"], "i8"), np.frombuffer(r["rows"], "i8")
        self.x = scaled(np.frombuffer(r["x"], "f8").reshape(-1, self.dim))
        self.norm = np.sqrt(np.einsum("ij,ij->i", self.x, self.x))
        self.unit = self.x / self.norm[:, None]
        self.turned = self.unit @ basis[self.dim]

    def near(self, other: _Tile, angle: float) -> bool:
        """Angles to the first direction differ by no more than the angle of a link."""
        return other.angles[0] <= self.angles[1] + angle and self.angles[0] <= other.angles[1] + angle


def _compare(one: _Tile, two: _Tile, threshold: float, same: bool):
    """Links between two tiles: (forest i, forest j) with the second tile's
    positions after the first's, and the link counts of both tiles (each node counts
    as the rows that it stands for)."""
    x, y, nx, ny, ux, uy, px, py = one.x, two.x, one.norm, two.norm, one.unit, two.unit, one.turned, two.turned
    cx, cy, basis = one.rows, two.rows, px
    cuts = [c for c in STAGES if c < basis.shape[1]]
    tail = lambda p, c: np.sqrt(np.maximum(0, np.einsum("ij,ij->i", p[:, c:], p[:, c:])))
    low = threshold - SLACK
    link_x, link_y = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
    found = [], []
    for s in range(0, len(x), STRIP):
        e = min(s + STRIP, len(x))
        if cuts:
            c = cuts[0]
            bound = px[s:e, :c] @ py[:, :c].T
            part = bound.copy() if len(cuts) > 1 else bound
            bound += tail(px[s:e], c)[:, None] * tail(py, c)[None, :]
            i, j = np.nonzero(bound >= low)
            if len(i) <= DENSE * bound.size:
                product = part[i, j]
                for a, b in zip(cuts, [*cuts[1:], basis.shape[1]]):
                    product = product + np.einsum("ij,ij->i", px[s + i, a:b], py[j, a:b])
                    left = product >= low - tail(px[s + i], b) * tail(py[j], b)
                    i, j, product = i[left], j[left], product[left]
            else:
                i = None
        if not cuts or i is None:
            product = ux[s:e] @ uy.T
            i, j = np.nonzero(product >= low)
            product = product[i, j]
        i = i + s
        if same:
            up = i < j
            i, j, product = i[up], j[up], product[up]
        near = np.flatnonzero(np.abs(product - threshold) <= 2 * SLACK)
        keep = product >= threshold
        for at in range(0, len(near), 1 << 14):
            k = near[at:at + (1 << 14)]
            dot = np.einsum("ij,ij->i", x[i[k]], y[j[k]])
            keep[k] = dot / (nx[i[k]] * ny[j[k]]) >= threshold
        i, j = i[keep], j[keep]
        if not len(i):
            continue
        link_x += np.bincount(i, weights=cy[j], minlength=len(x)).astype(np.int64)
        link_y += np.bincount(j, weights=cx[i], minlength=len(y)).astype(np.int64)
        a, b = forest(i, j if same else j + len(x))
        found[0].append(a)
        found[1].append(b)
    if found[0]:
        a, b = forest(np.concatenate(found[0]), np.concatenate(found[1]))
    else:
        a = b = np.zeros(0, np.int64)
    return a, b, link_x, link_y


def _tiles(nodes: DataFrame, basis: dict[int, np.ndarray], n: int) -> DataFrame:
    """(tile, dim, low, high, ids, rows, x): tiles by ranges of the first direction."""
    def first(batches):
        for b in batches:
            dims = b.column(0).to_numpy()
            y = np.zeros(len(dims))
            for d in np.unique(dims).tolist():
                x = b.column(1).filter(pa.array(dims == d)).flatten().to_numpy().reshape(-1, d)
                y[dims == d] = _unit(x) @ basis[d][:, 0]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(y)], [*b.schema.names, "y"])

    schema = "dim int, x array<double>, nid long, n long, y double"
    lined = written(nodes.select("dim", "x", "nid", "n").mapInArrow(first, schema), "lined")
    ranged = lined.repartitionByRange(max(1, -(-n // TILE)), "dim", "y", "nid")

    def pack(table: pa.Table) -> pa.Table:
        x = table["x"].combine_chunks()
        one = lambda v, t=None: pa.array([v], t)
        return pa.table({"tile": one(table["tile"][0].as_py(), pa.int64()), "dim": one(table["dim"][0].as_py(), pa.int32()),
                         "low": one(min(table["y"].to_pylist())), "high": one(max(table["y"].to_pylist())),
                         "ids": one(table["nid"].to_numpy().tobytes(), pa.binary()),
                         "rows": one(table["n"].to_numpy().tobytes(), pa.binary()),
                         "x": one(x.flatten().to_numpy().tobytes(), pa.binary())})

    # a partition of the range is a tile; one with vectors of two lengths is two
    return (ranged.withColumn("tile", F.spark_partition_id().cast("long"))
            .groupBy("tile", "dim").applyInArrow(
                pack, "tile long, dim int, low double, high double, ids binary, rows binary, x binary"))


def vector_links(nodes: DataFrame, threshold: float) -> DataFrame:
    """(kind, u, v): kind 0 adds v links to node u, kind 1 joins nodes u and v.
    ``nodes`` is a written table (nid long, dim int, x array<double>, n long)."""
    n = nodes.count()
    basis = directions(nodes)
    tiles = written(_tiles(nodes, basis, n), "vector-tiles", "uncompressed")
    angle = float(np.arccos(min(1.0, max(-1.0, threshold)))) + 1e-6
    count, size = (int(v or 0) for v in tiles.agg(F.max("tile") + 1, F.sum(F.length("x"))).first())
    strips = max(LEAST_STRIPS, -(-size // STRIP_BYTES))
    strip = F.expr(f"cast(tile * {strips} div {max(count, 1)} as int)")
    lined = tiles.withColumn("s", strip)
    # cell (a, b), a <= b: strip a is held, strip b passes by
    held = lined.select(F.col("s").alias("a"), F.explode(F.sequence(F.col("s"), F.lit(strips - 1))).alias("b"),
                        F.lit(0).alias("kind"), *tiles.columns)
    passing = lined.select(F.explode(F.sequence(F.lit(0), F.col("s"))).alias("a"), F.col("s").alias("b"),
                           F.lit(1).alias("kind"), *tiles.columns)
    cell = F.expr("cast(b * (b + 1) div 2 + a as int)")
    cells = (held.unionByName(passing).withColumn("cell", cell).drop("a", "b")
             .repartitionById(strips * (strips + 1) // 2, F.col("cell")).sortWithinPartitions("cell", "kind", "tile"))

    def run(batches):
        cell, mine = None, []
        for r in records(batches):
            if r["cell"] != cell:
                cell, mine = r["cell"], []
            t = _Tile(r, basis)
            if r["kind"] == 0:
                mine.append(t)
                continue
            for one in mine:
                if one.dim != t.dim or one.tile > t.tile or not one.near(t, angle):
                    continue
                same = one.tile == t.tile
                a, b, lx, ly = _compare(one, t, threshold, same)
                ids = t.ids if same else np.concatenate([one.ids, t.ids])
                links = lx + ly if same else np.concatenate([lx, ly])
                some = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.array([0, 1], np.int32), [len(some), len(a)])),
                     pa.array(np.concatenate([ids[some], ids[a]])),
                     pa.array(np.concatenate([links[some], ids[b]]))], ["kind", "u", "v"])
        give_back_memory()

    return cells.mapInArrow(run, "kind int, u long, v long")


def vector_components(rows: DataFrame, threshold: float = 0.95, id_col: str = "vec_id",
                      vector_col: str = "embedding") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    x = F.col("x")
    good = F.coalesce((F.size("x") > 0) & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
                      & F.exists("x", lambda v: v != 0), F.lit(False))
    src = rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                      F.col(f"`{vector_col}`").cast("array<double>").alias("x"))
    src = src.withColumn("good", good)
    nodes = (src.where("good").groupBy(x).agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
             .select(F.monotonically_increasing_id().alias("nid"), F.size("x").alias("dim"), "x", "n", "least"))
    nodes = written(nodes, "vectors")
    found = written(vector_links(nodes.drop("least"), threshold), "vector-links")
    roots = components(found.where("kind = 1").select("u", "v"))
    counts = found.where("kind = 0").groupBy(F.col("u").alias("nid")).agg(F.sum("v").alias("links"))
    named = (nodes.join(counts, "nid", "left").join(roots.withColumnRenamed("node", "nid"), "nid", "left")
             .select("x", "least", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                     F.coalesce("root", "nid").alias("root")))
    named = written(named, "vector-names")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").select("x", "n_links", "component_id")
    linked = src.where("good").join(named, "x").select("vec_id", "n_links", "component_id")
    alone = src.where("not good").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                         F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op8_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    """Links and component of every vector at cosine 0.95."""
    return vector_components(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), 0.95)


OP8_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len([e FOR e IN embedding IF e IS NULL OR NOT isfinite(e)]) = 0
    AND len([e FOR e IN embedding IF e <> 0]) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_dot_product(a.x, b.x)
        / (sqrt(list_dot_product(a.x, a.x)) * sqrt(list_dot_product(b.x, b.x))) >= 0.95),
reach AS (
  SELECT vec_id, vec_id AS r FROM embeddings
  UNION SELECT l.a, reach.r FROM links l JOIN reach ON reach.vec_id = l.b),
least AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least USING (vec_id) LEFT JOIN n USING (vec_id)
"""
