"""Mixing overlapping sources to target weights by min-cost flow.

1. Documents are aggregated by membership pattern (the set of sources they belong to): one row of
   document and word counts a pattern, so a source that holds a third of all rows is one number.
2. On the driver a min-cost flow routes each pattern's word capacity to the quotas of its sources.
   The r-th repetition of a pattern costs 2r - 1 a word (the marginal cost of r squared), so
   repetition spreads evenly; ``max_repeats`` bounds it.  The graph has one node a pattern
   and a source, and all paths of one cost are used at once; more than ``max_patterns`` patterns is an error, never a silent cut.
3. Documents are selected in the order of a seeded hash.  A pattern whose flow is q times
   its words plus a rest repeats every document q times and, for the rest, takes whole hash buckets
   from the lowest on.  Only the one bucket a pattern in which the rest ends is ordered by
   document: there each document that still fits is taken, then one more if that comes nearer.
   Buckets number about the square root of the documents, so neither side grows with all of them.

A document of several sources counts to one of them, drawn by its hash in proportion to the flows.

Defined cases: a null source is a source of its own, after all others; a null or empty text has
size 0 and is never taken; targets stop at max_repeats times a source's words, the excess going to the others by
weight; repeated rows are taken together or not at all in a last, partial pass; an empty table gives no rows; reruns
agree; other columns are kept by ``mix`` and its new columns replace any of the same name.
"""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import documents, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
SEED = 20240517
MAX_REPEATS = 3
MAX_PATTERNS = 100_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def share_out(sizes: dict, weights: dict, total: float, max_repeats: int = MAX_REPEATS) -> dict:
    """Targets by weight, none above max_repeats times its source's size; the excess goes by weight to the rest."""
    target = dict.fromkeys(sizes, 0.0)
    free = [s for s in sizes if weights[s] > 0]
    left = float(total)
    while free and left > 0:
        w = sum(weights[s] for s in free)
        over = [s for s in free if left * weights[s] / w > max_repeats * sizes[s]]
        if not over:
            for s in free:
                target[s] = left * weights[s] / w
            break
        for s in over:
            target[s] = float(max_repeats * sizes[s])
        left -= sum(target[s] for s in over)
        free = [s for s in free if s not in over]
    return target


def _distances(member: list[list[int]], holders: list[list[int]], flow: list[dict[int, int]], room: list[int]) -> tuple[list[int], list[int]]:
    """Steps from each pattern and each source to a source with room, by a membership or by taking back a flow; -1 if there is no way."""
    of_pattern, of_source = [-1] * len(member), [0 if r else -1 for r in room]
    turn = [s for s, r in enumerate(room) if r]
    for s in turn:  # grows while it is read
        for p in holders[s]:
            if of_pattern[p] < 0:
                of_pattern[p] = of_source[s] + 1
                for t, n in flow[p].items():
                    if n and of_source[t] < 0:
                        of_source[t] = of_pattern[p] + 1
                        turn.append(t)
    return of_pattern, of_source


def _block(member: list[list[int]], holders: list[list[int]], flow: list[dict[int, int]], left: list[int], room: list[int]) -> bool:
    """Push what fits along shortest ways until none is left; whether anything was pushed."""
    of_pattern, of_source = _distances(member, holders, flow, room)
    next_source, next_pattern = [0] * len(member), [0] * len(room)
    pushed = False
    for p in range(len(member)):
        while left[p]:
            way = [p]  # pattern, source, pattern whose flow to that source is taken back, source, ...
            while way:
                x = way[-1]
                if len(way) % 2:
                    arcs, i = member[x], next_source[x]
                    while i < len(arcs) and of_source[arcs[i]] != of_pattern[x] - 1:
                        i += 1
                    next_source[x] = i
                elif of_source[x] or not room[x]:
                    arcs, i = holders[x] if of_source[x] else [], next_pattern[x]
                    while i < len(arcs) and not (of_pattern[arcs[i]] == of_source[x] - 1 and flow[arcs[i]].get(x)):
                        i += 1
                    next_pattern[x] = i
                else:
                    break
                if i < len(arcs):
                    way.append(arcs[i])
                    continue
                way.pop()
                if way and len(way) % 2:
                    next_source[way[-1]] += 1
                elif way:
                    next_pattern[way[-1]] += 1
            if not way:
                break
            n = min(left[p], room[way[-1]], *(flow[q][s] for s, q in zip(way[1::2], way[2::2], strict=False)))
            left[p] -= n
            room[way[-1]] -= n
            for q, s in zip(way[::2], way[1::2], strict=True):
                flow[q][s] = flow[q].get(s, 0) + n
            for s, q in zip(way[1::2], way[2::2], strict=False):
                flow[q][s] -= n
            pushed = True
    return pushed


def min_cost_flow(patterns: list[tuple[list, int]], quotas: dict, max_repeats: int = MAX_REPEATS) -> list[dict]:
    """For each (sources, words) pattern the words routed to each source: a largest flow of least cost.

    Only the arcs from the origin to the patterns cost anything, so a shortest path costs what the repetition costs with which it begins.
    Successive shortest paths never get shorter; hence all paths of one cost are used at once: one more repetition of every
    pattern is opened, then blocking flows along ways of least length make the flow a largest one.  Each
    blocking flow looks at a membership a few times, and their number depends on the sources, not on the patterns.
    """
    names = list(quotas)
    at = {s: i for i, s in enumerate(names)}
    room = [max(0, int(q)) for q in quotas.values()]
    member = [[at[s] for s in dict.fromkeys(sources) if s in at] for sources, _ in patterns]
    holders: list[list[int]] = [[] for _ in names]
    for p, m in enumerate(member):
        for s in m:
            holders[s].append(p)
    flow: list[dict[int, int]] = [{} for _ in patterns]
    left = [0] * len(patterns)
    for _ in range(max_repeats):
        left = [n + words for n, (_, words) in zip(left, patterns, strict=True)]
        while _block(member, holders, flow, left, room):
            pass
    return [{names[s]: f[s] for s in m if f.get(s)} for m, f in zip(member, flow, strict=True)]


TRIES = 16


def _take(size: np.ndarray, left: int) -> tuple[np.ndarray, int]:
    """Documents in order while they fit, then the one that comes nearest; and how far off that ends."""
    extra = np.zeros(len(size), np.int64)
    for i, n in enumerate(size):
        if 0 < n <= left:
            extra[i] = 1
            left -= n
    out = np.flatnonzero((extra == 0) & (size > 0))
    if left > 0 and len(out) and size[(i := out[size[out].argmin()])] < 2 * left:
        extra[i] = 1
        left -= size[i]
    return extra, abs(int(left))


def _fill(pdf):
    """Choose within the bucket where a pattern's rest ends, in hash order; rows of one hash and size go together.

    A few other starts of the same order are tried while the first ends over 0.1% of the bucket off.
    """
    units = pdf.groupby(["__h", "__size"], sort=True).size().reset_index(name="n")
    left, size = int(pdf["__left"].iloc[0]), (units["__size"] * units["n"]).to_numpy()
    best, off = _take(size, left)
    for t in range(1, min(TRIES, len(size))):
        if off <= 0.001 * size.sum():
            break
        turn = len(size) * t // min(TRIES, len(size))
        extra, d = _take(np.roll(size, -turn), left)
        if d < off:
            best, off = np.roll(extra, turn), d
    return units.assign(__pattern=pdf["__pattern"].iloc[0], __extra=best)[["__pattern", "__h", "__size", "__extra"]]


def mix(docs: DataFrame, members: Column, size: Column | None = None, weights=WEIGHTS, seed: int = SEED, max_repeats: int = MAX_REPEATS, max_patterns: int = MAX_PATTERNS) -> DataFrame:
    """docs with size, source_size, target, copies, taken and quota_source.

    members: array<string> of the sources of a row; size: its words, by default counted in text.  weights: a cycle over the sources in code point
    order, null last, or a dict by source.  source_size and target are the quota source's.
    """
    spark = docs.sparkSession
    own = ["size", "source_size", "target", "copies", "taken", "quota_source"]
    kept = [c for c in docs.columns if c not in own]
    key = F.to_json(F.struct(F.array_distinct(members).alias("m")), {"ignoreNullFields": "false"})
    h = F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("__size"))
    d = docs.select(*kept, (word_count(F.col("text")) if size is None else size).cast("long").alias("__size"), key.alias("__pattern")).withColumn("__h", h)
    stats = d.groupBy("__pattern").agg(F.count("*").alias("n"), F.sum("__size").alias("words")).limit(max_patterns + 1).collect()
    if len(stats) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns")
    stats = sorted((x["__pattern"], json.loads(x["__pattern"])["m"], x["n"], x["words"]) for x in stats)
    sizes: dict = {}
    for _, m, _, words in stats:
        for s in m:
            sizes[s] = sizes.get(s, 0) + words
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    sizes = {s: sizes[s] for s in names}
    w = weights if isinstance(weights, dict) else {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target = share_out(sizes, w, sum(x[3] for x in stats), max_repeats)
    flows = min_cost_flow([(m, words) for _, m, _, words in stats], {s: round(t) for s, t in target.items()}, max_repeats)

    plan = []
    for (pattern, m, n, words), flow in zip(stats, flows, strict=True):
        total = sum(flow.values())
        base, rest = divmod(total, words) if words else (0, 0)
        cum, shares = 0, []
        for s, f in flow.items() or [(m[0] if m else None, 1)]:
            cum += f
            shares.append((cum / max(1, total), s, sizes.get(s, 0), target.get(s, 0.0)))
        plan.append((pattern, max(1, math.ceil(math.sqrt(n / 64))), base, rest, shares))
    share = T.ArrayType(T.StructType([T.StructField("upto", T.DoubleType()), T.StructField("source", T.StringType()), T.StructField("source_size", T.LongType()), T.StructField("target", T.DoubleType())]))
    table = spark.createDataFrame(plan, T.StructType([T.StructField("__pattern", T.StringType()), T.StructField("__buckets", T.LongType()), T.StructField("__base", T.LongType()), T.StructField("__rest", T.LongType()), T.StructField("__shares", share)]))
    # at most max_patterns rows, one a pattern
    unit = F.pmod("__h", F.lit(1 << 30)) / F.lit(float(1 << 30))
    d = d.join(F.broadcast(table), "__pattern").withColumn("__bucket", F.floor(unit * F.col("__buckets")))
    by = d.groupBy("__pattern", "__bucket").agg(F.sum("__size").alias("words"), F.first("__rest").alias("__rest"))
    run = by.withColumn("cum", F.sum("words").over(Window.partitionBy("__pattern").orderBy("__bucket")))
    ends = run.where((F.col("cum") > F.col("__rest")) & (F.col("cum") - F.col("words") <= F.col("__rest"))).groupBy("__pattern").agg(F.min("__bucket").alias("__end"), F.min(F.struct("__bucket", (F.col("__rest") - F.col("cum") + F.col("words")).alias("left"))).alias("x")).select("__pattern", "__end", F.col("x.left").alias("__left")).collect()
    last = spark.createDataFrame([tuple(x) for x in ends], "__pattern string, __end long, __left long")
    d = d.join(F.broadcast(last), "__pattern", "left")
    inside = d.where(F.col("__bucket") == F.col("__end"))
    outside = d.where(~F.coalesce(F.col("__bucket") == F.col("__end"), F.lit(False))).withColumn("__extra", (F.coalesce(F.col("__bucket") < F.col("__end"), F.lit(False))).cast("long"))
    chosen = inside.select("__pattern", "__h", "__size", "__left").groupBy("__pattern").applyInPandas(_fill, "__pattern string, __h long, __size long, __extra long")
    inside = inside.join(chosen, ["__pattern", "__h", "__size"])
    both = outside.unionByName(inside)
    draw = F.pmod(F.xxhash64("__h"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    both = both.withColumn("__draw", draw).withColumn("__q", F.coalesce(F.expr("try_element_at(filter(__shares, x -> __draw < x.upto), 1)"), F.expr("__shares[size(__shares) - 1]")))
    copies = F.when(F.col("__size") > 0, F.least(F.col("__base") + F.col("__extra"), F.lit(max_repeats))).otherwise(0).cast("long")
    return both.select(*kept, F.col("__size").alias("size"), F.col("__q.source_size").alias("source_size"), F.col("__q.target").alias("target"), copies.alias("copies"), (copies * F.col("__size")).alias("taken"), F.col("__q.source").alias("quota_source"))


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    # the mix reads sizes four times; they are counted once
    slim = written(docs.select("doc_id", "source", word_count(F.col("text")).alias("n")), "sizes")
    return mix(slim, F.array("source"), F.col("n")).select("doc_id", "size", "source_size", "target", "taken")
