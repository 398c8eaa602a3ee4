"""Approximate nearest neighbours by learned partitions.

Fit, on a bounded sample (``Shape.sample`` vectors, lowest hashes of the id): an exact neighbour graph of
the sample; a balanced partition of that graph, grown by refinement passes that move a vector to the part
where most of its neighbours are while parts stay within ``slack`` of equal size; then a small
classifier (one hidden layer, softmax) that predicts the parts of a vector's neighbours from the vector.

Index: every vector goes to its most probable part.  Search: a query goes to its most probable parts until
their probabilities sum to ``mass``, and is compared with every vector there, in blocks; where vectors
form clusters that is one or two parts, where they have no structure nearly all.  A part is dealt in salted blocks by a hash of the
id, so that a hot vector or part never lands in one task, and each (query, block) returns only its
best ``k``; the final choice is made per query over those.

Scores are inner products in double precision, summed per pair in one fixed order, so equal vectors get equal
scores and ties go to the smaller id.

Defined cases: vectors that are null, zero, or hold null or non-finite components take no part, nor do
those whose length differs from the most common one; repeated ids are candidates each, and a query's own id
never is its candidate; with fewer than k candidates in the probed parts the query probes all parts, so an answer is short
only if the table is; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import written


class Shape(NamedTuple):
    sample: int = 8192  # vectors that the partitions are learned from, at most
    parts: int = 16
    mass: float = 0.965  # a query asks its most probable parts until they hold this much probability
    neighbours: int = 10
    hidden: int = 96
    epochs: int = 30
    slack: float = 1.1
    block: int = 4096  # vectors in a salted block, about


def valid(df: DataFrame, column: str) -> DataFrame:
    """(vec_id, v array<double>) of the vectors that take part."""
    v = F.col(column).cast("array<double>")
    x = df.select("vec_id", v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    x = x.where(F.forall("v", lambda y: y.isNotNull() & ~F.isnan(y) & (F.abs(y) < F.lit(float("inf")))) & F.exists("v", lambda y: y != 0))
    dim = x.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    return x.where(F.size("v") == (dim["dim"] if dim else 0))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    c = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return c.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(c), -1) if len(c) else np.zeros((0, 1))


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest others of each row by inner product, exactly, in blocks."""
    out = np.empty((len(x), min(k, len(x) - 1)), np.int64)
    for lo in range(0, len(x), 1024):
        s = x[lo : lo + 1024] @ x.T
        s[np.arange(len(s)), np.arange(lo, lo + len(s))] = -np.inf
        out[lo : lo + 1024] = np.argpartition(-s, out.shape[1] - 1, axis=1)[:, : out.shape[1]] if out.shape[1] else 0
    return out


def balanced_partition(graph: np.ndarray, x: np.ndarray, parts: int, slack: float, seed: int = 7) -> np.ndarray:
    """Parts of nearly equal size that cut few edges of the graph."""
    rng = np.random.default_rng(seed)
    n = len(graph)
    most = int(np.ceil(n / parts * slack))
    # a first, roughly balanced split by recursive bisection along random pairs' directions
    part = np.zeros(n, np.int64)
    groups, at = [np.arange(n)], 1
    while len(groups) < parts:
        groups.sort(key=len)
        g = groups.pop()
        a, b = x[rng.choice(g, 2)] if len(g) > 1 else (x[g[0]], x[g[0]])
        o = g[np.argsort(x[g] @ (a - b), kind="stable")]
        groups += [o[: len(o) // 2], o[len(o) // 2 :]]
        at += 1
    for i, g in enumerate(groups):
        part[g] = i
    other = graph.ravel()
    own = np.repeat(np.arange(n), graph.shape[1])
    size = np.bincount(part, minlength=parts)
    for _ in range(20):
        votes = np.zeros((n, parts), np.float32)
        np.add.at(votes, (own, part[other]), 1)
        np.add.at(votes, (other, part[own]), 1)
        gain = votes - votes[np.arange(n), part][:, None]
        best = gain.argmax(axis=1)
        want = np.flatnonzero(gain[np.arange(n), best] > 0)
        want = want[np.argsort(-gain[want, best[want]], kind="stable")]
        moved = 0
        for i in want[rng.random(len(want)) < 0.7]:
            if size[best[i]] < most:
                size[part[i]] -= 1
                size[best[i]] += 1
                part[i] = best[i]
                moved += 1
        if moved < n // 500:
            break
    return part


def fit_router(x: np.ndarray, target: np.ndarray, shape: Shape, seed: int = 11) -> list[np.ndarray]:
    """A one-hidden-layer classifier from vectors to a distribution over parts."""
    rng = np.random.default_rng(seed)
    d, p = x.shape[1], target.shape[1]
    scale = 1.0 / max(1e-12, float(np.sqrt((x**2).mean())))
    w = [rng.normal(0, 1 / np.sqrt(d), (d, shape.hidden)), np.zeros(shape.hidden), rng.normal(0, 0.1, (shape.hidden, p)), np.zeros(p)]
    m, v, t = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
    z = x * scale
    for _ in range(shape.epochs):
        for at in np.array_split(rng.permutation(len(z)), max(1, len(z) // 256)):
            a, y = z[at], target[at]
            h = np.maximum(a @ w[0] + w[1], 0)
            o = h @ w[2] + w[3]
            o = np.exp(o - o.max(axis=1, keepdims=True))
            e = (o / o.sum(axis=1, keepdims=True) - y) / len(at)
            back = (e @ w[2].T) * (h > 0)
            t += 1
            for i, g in enumerate((a.T @ back, back.sum(0), h.T @ e, e.sum(0))):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                w[i] -= 0.003 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    return [w[0] * scale, *w[1:]]


def route(x: np.ndarray, w: list[np.ndarray]) -> np.ndarray:
    """Logits of the parts."""
    return np.maximum(x @ w[0] + w[1], 0) @ w[2] + w[3]


def fit(vectors: DataFrame, shape: Shape) -> list[np.ndarray]:
    got = vectors.select("vec_id", "v").orderBy(F.xxhash64("vec_id"), "vec_id").limit(shape.sample).toArrow()
    x = _matrix(got.column("v"))
    if len(x) < 4 * shape.parts:
        return [np.zeros((x.shape[1] if len(x) else 1, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)]
    x, back = np.unique(x, axis=0, return_index=True)
    if len(x) < 4 * shape.parts:
        return [np.zeros((x.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)]
    graph = neighbour_graph(x, shape.neighbours)
    part = balanced_partition(graph, x, shape.parts, shape.slack)
    near = np.zeros((len(x), shape.parts))
    np.add.at(near, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph.ravel()]), 1)
    near[np.arange(len(x)), part] += 1
    return fit_router(x, near / near.sum(axis=1, keepdims=True), shape)


def _assign(sent, mass: float):
    """(vec_id, v, part), one row for each of the most probable parts up to a mass, one at least."""

    def run(batches):
        w = sent.value
        for b in batches:
            if not b.num_rows:
                continue
            z = route(_matrix(b.column(1)), w)
            best = np.argsort(-z, axis=1, kind="stable")
            p = np.exp(np.take_along_axis(z, best, axis=1) - z.max(axis=1, keepdims=True))
            before = np.cumsum(p, axis=1) - p
            use = before < mass * p.sum(axis=1, keepdims=True)
            use[:, 0] = True
            row, at = np.nonzero(use)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), b.column(1).take(pa.array(row)), pa.array(best[row, at].astype(np.int32))], ["vec_id", "v", "part"])

    return run


def _best(k: int):
    """Each query's k best in one block."""

    def run(queries: pa.Table, base: pa.Table) -> pa.Table:
        out = []
        if queries.num_rows and base.num_rows:
            q, x = _matrix(queries.column("v")), _matrix(base.column("v"))
            qid, xid = queries.column("vec_id").to_numpy(), base.column("vec_id").to_numpy()
            o = np.argsort(xid, kind="stable")
            x, xid = x[o], xid[o]
            for lo in range(0, len(q), 256):
                s = q[lo : lo + 256] @ x.T
                s[qid[lo : lo + 256, None] == xid] = -np.inf
                n = min(k, s.shape[1])
                least = -np.partition(-s, n - 1, axis=1)[:, n - 1]
                margin = 1e-9 * (1 + np.abs(least))
                row, col = np.nonzero((s >= (least - margin)[:, None]) & (s > -np.inf))
                exact = np.add.reduce(q[lo + row] * x[col], axis=1)  # the same order of sums for every pair
                order = np.lexsort((col, -exact, row))
                row, col, exact = row[order], col[order], exact[order]
                per = np.bincount(row, minlength=len(s))
                rank = np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)
                use = rank < k
                out.append((qid[lo + row[use]], xid[col[use]], exact[use]))
        cols = [np.concatenate([c[i] for c in out]) if out else np.zeros(0, kind) for i, kind in enumerate((np.int64, np.int64, np.float64))]
        return pa.Table.from_arrays([pa.array(c) for c in cols], ["query_id", "vec_id", "score"])

    return run


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, shape: Shape = Shape()) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query among vectors, both (vec_id, v)."""
    spark = vectors.sparkSession
    n = vectors.count()
    sent = spark.sparkContext.broadcast(fit(vectors, shape))
    parts = sent.value[3].shape[0]
    salts = max(1, -(-n // (parts * shape.block)))
    base = vectors.mapInArrow(_assign(sent, 0.0), "vec_id long, v array<double>, part int").withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(salts)).cast("int"))

    def hits(q: DataFrame, mass: float) -> DataFrame:
        asked = q.select("vec_id", "v").mapInArrow(_assign(sent, mass), "vec_id long, v array<double>, part int").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        # queries of a block are dealt too: their number grows with the table
        lanes = max(1, -(-n // (shape.block * 64)))
        asked = asked.withColumn("lane", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(lanes)).cast("int"))
        held = base.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)))) if lanes > 1 else base.withColumn("lane", F.lit(0))
        found = asked.groupBy("part", "salt", "lane").cogroup(held.groupBy("part", "salt", "lane")).applyInArrow(_best(k), "query_id long, vec_id long, score double")
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)

    first = written(hits(queries, shape.mass), "nearest")
    # a query that found fewer than k although there are more asks every part
    short = queries.join(first.where(F.col("rank") == k), queries["vec_id"] == first["query_id"], "left_anti")
    if n <= k or short.isEmpty():
        return first
    again = hits(short, 2.0)
    return first.join(short, first["query_id"] == short["vec_id"], "left_anti").unionByName(again)


def op5_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = valid(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "embedding")
    return search(x, x.where("vec_id % 20 = 0"))
