"""Near-duplicate vectors by dual traversal of cover trees: exactly the pairs whose cosine reaches a threshold.

Vectors become unit vectors, where a cosine is a distance.  A cover tree has nested levels with halving radii: a
node's vectors are covered by balls of half its radius around some of them, and each ball is a node below.  Balls are
taken where a sample of the node's own vectors shows most company; what too few balls would cover stays one leaf, so a tree
never has a ball for each of many lone vectors.  Each node keeps its true covering radius.  The traversal takes two nodes at
a time: centres further apart than both radii and the threshold distance prune all their pairs, centres so close that no pair
can miss it link all of them at once (counted, not listed), and leaves compare by one matrix product, in double precision.

Above, the same cover of a bounded sample (``Shape.sample`` vectors, lowest hashes of the id; it shapes the cells, never the results)
gives at most ``Shape.cells`` balls, and every vector goes to its nearest ball or to the rest.  Cells are packed, or dealt by
hash, into blocks of some ``block`` vectors.  Of two blocks one is home, and the other's vectors go there if the true radii of
its cells allow a partner: so each pair meets once, in a task that holds one block and ``lane`` asking blocks at most.

Cost: where vectors form clusters, a vector meets its own and close clusters.  Lone vectors without any structure
(independent directions in many dimensions) defeat every metric tree; they all meet in blocks, which is quadratic, at the speed of matrix products.

Equal vectors are one row with a weight from the start, so copies meet nothing.  A task returns for each vector that has
partners a number of links and one edge to a vector of its local component; components of those edges are found by
``connected``.  No pair list is ever written, and only cell counts and radii reach the driver.

Defined cases: vectors that are null, zero, or hold null or non-finite components, or whose length differs from the most common
one, link with nothing, nor does a row with a null id (its component is null, and it is kept); repeated ids are vectors of
their own, each counted; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import connected
from .op5_learned_partitions import _matrix, valid
from .store import written


class Shape(NamedTuple):
    cosine: float = 0.9
    sample: int = 16_384  # vectors that shape the cells, at most
    cells: int = 4096  # at most
    block: int = 4096  # vectors in a block, about
    lane: int = 16  # asking blocks in one task
    leaf: int = 128
    probe: int = 256  # vectors of a node that are tried as centres


#: Rounding never decides: bounds within this of a threshold are left to the comparison itself.
EPS = 1e-9
#: Smaller balls are leaves: cosines in double precision do not tell their vectors apart well enough.
FINEST = 1e-5
TILE = 1024


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True) if len(x) else x
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Of unit vectors to one unit vector."""
    d = x - c
    return np.sqrt(np.einsum("ij,ij->i", d, d))


def cover(x: np.ndarray, radius: float, probe: int, least: int) -> tuple[list[int], np.ndarray]:
    """Centres among the rows, and each row's centre (-1: none): balls of a radius that hold ``least`` rows at least, fullest first.

    Centres are more than the radius apart, as in any level of a cover tree.
    """
    at = np.unique(np.linspace(0, len(x) - 1, min(probe, len(x))).astype(np.int64))
    cos = x @ x[at].T
    inside = cos >= 1 - radius * radius / 2
    centres, own = [], np.full(len(x), -1)
    best = np.full(len(x), -2.0)
    free = np.ones(len(at), bool)
    for i in np.argsort(-inside.sum(axis=0), kind="stable"):
        if not free[i]:
            continue
        take = inside[:, i] & (cos[:, i] > best)
        if (take & (own < 0)).sum() < least:
            continue
        best[take], own[take] = cos[take, i], len(centres)
        centres.append(int(at[i]))
        free &= ~inside[at, i]
    return centres, own


class Node(NamedTuple):
    rows: np.ndarray
    centre: np.ndarray
    reach: float  # true covering radius
    below: tuple


def tree(x: np.ndarray, rows: np.ndarray, centre: np.ndarray, radius: float, shape: Shape) -> Node:
    """The cover tree of some rows of x, of which ``radius`` bounds the covering radius."""
    reach = float(distances(x[rows], centre).max()) if len(rows) else 0.0
    below = ()
    if len(rows) > shape.leaf and reach > FINEST:
        while radius / 2 >= reach:
            radius /= 2
        y = x[rows]
        centres, own = cover(y, radius / 2, shape.probe, max(2, shape.leaf // 8))
        rest = own < 0
        if len(centres) > 1 or (centres and rest.any()):
            below = tuple(tree(x, rows[own == k], y[c], radius / 2, shape) for k, c in enumerate(centres))
            if rest.any():
                left = rows[rest]
                mid = x[left[0]]
                below += (Node(left, mid, float(distances(x[left], mid).max()), ()),)
        elif centres:
            below = (tree(x, rows, y[centres[0]], radius / 2, shape),)
    return Node(rows, centre, reach, below)


class Links:
    """Link counts of rows, and which of them are connected."""

    def __init__(self, weight: np.ndarray) -> None:
        self.weight, self.count, self.root = weight, np.zeros(len(weight), np.int64), np.arange(len(weight))

    def all_of(self, a: np.ndarray, b: np.ndarray | None) -> None:
        """All pairs between two sets, or within one."""
        if b is None:
            self.count[a] += self.weight[a].sum() - self.weight[a]
            self.join(a[:-1], a[1:])
            return
        self.count[a] += self.weight[b].sum()
        self.count[b] += self.weight[a].sum()
        self.join(a, np.full(len(a), b[0]))
        self.join(b, np.full(len(b), a[0]))

    def some(self, a: np.ndarray, b: np.ndarray) -> None:
        np.add.at(self.count, a, self.weight[b])
        np.add.at(self.count, b, self.weight[a])
        self.join(a, b)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Smallest row of each component, by hooking roots on smaller ones and halving paths."""
        root = self.root
        while len(a):
            p, q = root[a], root[b]
            differ = p != q
            if not differ.any():
                break
            a, b, p, q = a[differ], b[differ], p[differ], q[differ]
            np.minimum.at(root, np.maximum(p, q), np.minimum(p, q))
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root[:] = up


def compare(x: np.ndarray, a: np.ndarray, b: np.ndarray | None, cosine: float, links: Links) -> None:
    """Every pair of two leaves, or of one, in tiles."""
    single = x.astype(np.float32)  # a first look; what comes near the threshold is computed again
    slack = 1e-5 + 1e-7 * x.shape[1]
    for lo in range(0, len(a), TILE):
        p = a[lo : lo + TILE]
        for at in range(lo if b is None else 0, len(a if b is None else b), TILE):
            q = (a if b is None else b)[at : at + TILE]
            i, j = np.nonzero(single[p] @ single[q].T >= np.float32(cosine - slack))
            if b is None and at == lo:
                i, j = i[i < j], j[i < j]
            for s in range(0, len(i), 1 << 17):
                u, v = p[i[s : s + (1 << 17)]], q[j[s : s + (1 << 17)]]
                ok = np.add.reduce(x[u] * x[v], axis=1) >= cosine  # the same order of sums for every pair
                links.some(u[ok], v[ok])


def traverse(x: np.ndarray, one: Node, two: Node | None, cosine: float, links: Links) -> None:
    """All linked pairs between two trees, or within one."""
    far = float(np.sqrt(2 - 2 * cosine))
    todo = [(one, two)]
    while todo:
        a, b = todo.pop()
        if b is None:
            if not len(a.rows):
                continue
            if 2 * a.reach <= far - EPS:
                links.all_of(a.rows, None)
            elif a.below:
                todo += [(c, None) for c in a.below]
                todo += [(c, d) for i, c in enumerate(a.below) for d in a.below[:i]]
            else:
                compare(x, a.rows, None, cosine, links)
            continue
        if not len(a.rows) or not len(b.rows):
            continue
        apart = float(distances(a.centre[None], b.centre)[0])
        if apart - a.reach - b.reach > far + EPS:
            continue
        if apart + a.reach + b.reach <= far - EPS:
            links.all_of(a.rows, b.rows)
        elif a.below and (not b.below or a.reach >= b.reach):
            todo += [(c, b) for c in a.below]
        elif b.below:
            todo += [(a, c) for c in b.below]
        else:
            # of two leaves, rows out of reach of the other ball have no partner there
            p = a.rows[distances(x[a.rows], b.centre) <= b.reach + far + EPS]
            q = b.rows[distances(x[b.rows], a.centre) <= a.reach + far + EPS]
            compare(x, p, q, cosine, links)


class Cells(NamedTuple):
    """Balls by index, the last cell is the rest; later filled with counts and radii, in order of radius."""

    centre: np.ndarray
    radius: np.ndarray


def balls(x: np.ndarray, share: float, shape: Shape) -> Cells:
    """A cover of the sample: the fullest balls of halving radii are split first, until they are small or enough."""
    if not len(x):
        return Cells(np.zeros((0, 1)), np.zeros(0))
    least = max(2.0, shape.block * share / 4, len(x) * 2 / shape.cells)
    out, todo = [], [(x, 2.0)]
    while todo:
        y, radius = todo.pop()
        centres, own = cover(y, radius / 2, shape.probe * 4, max(2, int(least / 4))) if radius > 1e-3 else ([], None)
        for k, c in enumerate(centres):
            inner = y[own == k]
            if len(inner) > least:
                todo.append((inner, radius / 2))
            out.append((y[c], radius / 2))
    out = out[-shape.cells :]
    return Cells(np.array([c for c, _ in out]).reshape(len(out), x.shape[1]), np.array([r for _, r in out]))


def cell_of(x: np.ndarray, cells: Cells) -> tuple[np.ndarray, np.ndarray]:
    """Each unit vector's cell and distance to its centre: the smallest, then nearest ball that holds it, else the last cell.

    The last cell has no ball: its centre is the first axis.
    """
    m = len(cells.centre)
    axis = np.zeros(x.shape[1])
    axis[:1] = 1
    own, dist = np.full(len(x), m), distances(x, axis)
    if m:
        d = np.sqrt(np.maximum(0, 2 - 2 * (x @ cells.centre.T)))
        rank = np.where(d <= cells.radius, cells.radius * 4 + d, np.inf)
        best = rank.argmin(axis=1)
        inside = np.isfinite(rank[np.arange(len(x)), best])
        own[inside] = best[inside]
        for k in np.unique(own[inside]):
            who = own == k
            dist[who] = distances(x[who], cells.centre[k])
    return own, dist


class Plan(NamedTuple):
    """Cells in order of their true radius, and the blocks of each."""

    cells: Cells
    centre: np.ndarray  # by cell, with the rest
    reach: np.ndarray
    rank: np.ndarray
    first: np.ndarray
    blocks: np.ndarray
    far: float


def plan(cells: Cells, dim: int, sized: dict, shape: Shape) -> Plan:
    m = len(cells.centre)
    axis = np.zeros((1, dim))
    axis[0, :1] = 1
    centre = np.concatenate([cells.centre.reshape(m, dim), axis])
    count, reach = np.zeros(m + 1, np.int64), np.zeros(m + 1)
    for k, (n, r) in sized.items():
        count[k], reach[k] = n, r
    order = np.lexsort((np.arange(m + 1), reach))
    first, blocks = np.zeros(m + 1, np.int64), np.zeros(m + 1, np.int64)
    at, full = 0, 0
    for k in order:
        if not count[k]:
            continue
        if full and full + count[k] > shape.block:
            at, full = at + 1, 0
        first[k], blocks[k] = at, -(-count[k] // shape.block)
        full += count[k]
        if blocks[k] > 1:
            at, full = at + blocks[k], 0
    rank = np.empty(m + 1, np.int64)
    rank[order] = np.arange(m + 1)
    return Plan(cells, centre, reach, rank, first, blocks, float(np.sqrt(2 - 2 * shape.cosine)))


def is_home(one: np.ndarray, two: np.ndarray, same_cell: np.ndarray) -> np.ndarray:
    """Whether block ``two`` is home of the pair: the lower one, but in turns between blocks of one cell."""
    lower = two < one
    return np.where(same_cell, lower == ((one + two) % 2 == 0), lower)


def _located(sent):
    def run(batches):
        for b in batches:
            if b.num_rows:
                own, dist = cell_of(unit(_matrix(b.column(0))), sent.value)
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(dist)], ["cell", "dist"])

    return run


def _dealt(sent, lane: int):
    """(block, lane, home, first, id, w, v): each vector at home, once for each lane with askers, and in each block it asks."""

    def run(batches):
        p: Plan = sent.value
        live = np.flatnonzero(p.blocks)
        for b in batches:
            if not b.num_rows:
                continue
            ids = b.column(0).to_numpy()
            x = unit(_matrix(b.column(2)))
            own, _ = cell_of(x, p.cells)
            h = (ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            mine = p.first[own] + (h % p.blocks[own].astype(np.uint64)).astype(np.int64)
            out = []  # row, block, lane, home, own lane
            single = p.blocks == 1
            for k in np.unique(own):
                who = np.flatnonzero(own == k)
                # cells that can hold partners of this one's vectors at all
                near = live[distances(p.centre[live], p.centre[k]) <= p.reach[live] + p.reach[k] + p.far + EPS]
                d = np.sqrt(np.maximum(0, 2 - 2 * (x[who] @ p.centre[near].T)))
                can = (d <= p.reach[near] + p.far + 1e-7) | (near == k)
                blocks = np.concatenate([p.first[c] + np.arange(p.blocks[c]) for c in near])
                source = np.repeat(np.arange(len(near)), p.blocks[near])
                same = (near[source] == k) & ~single[k]
                block, back = np.unique(blocks, return_inverse=True)
                same_block = np.zeros(len(block), bool)
                same_block[back[same]] = True
                for m in np.unique(mine[who]):
                    rows = np.flatnonzero(mine[who] == m)
                    ask = is_home(np.full(len(block), m), block, same_block) & (block != m)
                    reachable = np.zeros((len(rows), len(block)), bool)
                    for c in range(len(near)):
                        reachable[:, back[source == c]] |= can[rows, c][:, None]
                    i, j = np.nonzero(reachable & ask)
                    out.append((who[rows[i]], block[j], np.full(len(i), m // lane), np.zeros(len(i), bool), np.zeros(len(i), bool)))
                    lanes = np.union1d(block[~ask & (block != m)] // lane, [m // lane])
                    r = np.repeat(who[rows], len(lanes))
                    to = np.tile(lanes, len(rows))
                    out.append((r, np.full(len(r), m), to, np.ones(len(r), bool), to == m // lane))
            row, block, to, home, first = (np.concatenate(c) for c in zip(*out, strict=True))
            # a batch of rows at most: what is copied often must not gather in memory
            for lo in range(0, len(row), 8192):
                take = pa.array(row[lo : lo + 8192])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block[lo : lo + 8192]), pa.array(to[lo : lo + 8192]), pa.array(home[lo : lo + 8192]), pa.array(first[lo : lo + 8192]), b.column(0).take(take), b.column(1).take(take), b.column(2).take(take)],
                    ["block", "lane", "home", "first", "id", "w", "v"],
                )

    return run


def _linked(shape: Shape):
    """Links and a local component's smallest id for each vector of one block and lane that has partners."""

    def run(t: pa.Table) -> pa.Table:
        t = t.take(pa.array(np.argsort(t.column("id").to_numpy(), kind="stable")))
        ids, weight = t.column("id").to_numpy(), t.column("w").to_numpy()
        home = t.column("home").to_numpy(zero_copy_only=False)
        x = unit(_matrix(t.column("v")))
        links = Links(weight)
        grown = lambda rows: tree(x, rows, x[rows[0]], 2.0, shape) if len(rows) else Node(rows, np.zeros(x.shape[1]), 0.0, ())
        base, asking = grown(np.flatnonzero(home)), grown(np.flatnonzero(~home))
        traverse(x, base, asking, shape.cosine, links)
        if len(base.rows) and t.column("first")[int(base.rows[0])].as_py():
            traverse(x, base, None, shape.cosine, links)
        some = np.flatnonzero(links.count)
        return pa.Table.from_arrays([pa.array(ids[some]), pa.array(links.count[some]), pa.array(ids[links.root[some]])], ["id", "links", "hub"])

    return run


def linked(vectors: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """(id, links, hub) of distinct vectors (id, w, v): links with others, by weight, in parts to be summed; hub is connected with id."""
    spark = vectors.sparkSession
    total = vectors.count()
    got = vectors.select("id", "v").orderBy(F.xxhash64("id"), "id").limit(shape.sample).toArrow()
    x = unit(_matrix(got.column("v")))
    cells = balls(x, len(x) / max(1, total), shape)
    at = spark.sparkContext.broadcast(cells)
    found = vectors.select("v").mapInArrow(_located(at), "cell long, dist double").groupBy("cell").agg(F.count("*").alias("n"), F.max("dist").alias("reach")).toArrow()
    sized = {r["cell"]: (r["n"], r["reach"]) for r in found.to_pylist()}
    sent = spark.sparkContext.broadcast(plan(cells, x.shape[1], sized, shape))
    dealt = vectors.select("id", "w", "v").mapInArrow(_dealt(sent, shape.lane), "block long, lane long, home boolean, first boolean, id long, w long, v array<double>")
    return dealt.groupBy("block", "lane").applyInArrow(_linked(shape), "id long, links long, hub long")


def near_vectors(df: DataFrame, column: str = "embedding", shape: Shape = Shape()) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    rows = valid(df, column)
    classes = rows.groupBy("v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("w")).withColumn("id", F.monotonically_increasing_id())
    classes = written(classes, "vectors")
    links = written(linked(classes, shape), "links")
    comps = connected(links.select(F.col("id").alias("a"), F.col("hub").alias("b")))
    by_class = classes.select("id", "rep", "w", "v").join(links.groupBy("id").agg(F.sum("links").alias("links")), "id", "left").join(comps.select(F.col("node").alias("id"), "comp"), "id", "left")
    # the smallest vec_id of a component, which need not be that of its smallest class
    low = by_class.where("comp is not null").groupBy("comp").agg(F.min("rep").alias("low"))
    by_class = by_class.join(low, "comp", "left").select("v", (F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("n_links"), F.coalesce("low", "rep").alias("component_id"))
    mine = df.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col(column).cast("array<double>")).alias("v"))
    out = mine.join(by_class, "v", "left")
    return out.select(F.col("vec_id").cast("long"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").cast("long").alias("component_id")).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op13_cover_tree_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP13_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
ok AS (
  SELECT vec_id, e FROM v
  WHERE len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN e IF x <> 0]) > 0 AND len(e) = (SELECT mode(len(e)) FROM v)),
n AS (
  SELECT vec_id, [x / sqrt(list_dot_product(e, e)) FOR x IN e] AS e FROM ok),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.vec_id <> b.vec_id AND list_dot_product(a.e, b.e) >= 0.9),
reach(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = e.vec_id
"""
