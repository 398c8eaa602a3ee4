"""Exact Jaccard similarity join of word-shingle sets with set-relation skipping, and its components.

Documents with the same set are one node.  A set's tokens are ordered by a global order, frequent ones last; two sets
with Jaccard similarity t share a token among the first n - ceil(t n) + 1 of each, so only those prefixes are
indexed, and of them only tokens that occur at least twice.

Index-level skipping: a token's list is kept in blocks of equal (set size, position of the token); block
pairs whose sizes or remaining lengths cannot reach the threshold are skipped whole.

A pair that meets in a list must first pass a bitmap test: each set has a bitmap of parities, one for each hash
slot and three to six slots a member, and two bitmaps differ in no more bits than their sets differ in
members, so too many differing bits rule a pair out exactly, and only near pairs have their whole sets
compared: first, for each set, the nearest pair, then what is still between different components.

Answer-level skipping: each list first compares its sets only with a leader of about their size, so a group of
similar sets costs one comparison each.  What the leader's answers settle is derived: sets in one component need no
comparison, and two sets whose distances to a common leader differ by more than 1 - t cannot link (the
Jaccard distance is a metric).  Only the pairs left over are compared.  No link between components is lost.

Defined cases: null and empty texts have an empty set, link with nothing and keep their own doc_id; with fewer
words than a shingle the whole sequence is one; repeated rows share a node; a null doc_id is never the smallest
unless a component has no other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import connected
from .store import documents, id_filter, may_hold, written
from .text import LOWER, U, longs, mix, raw, rows_of, slices, tidy, word_hashes, words

SHINGLE = 5
#: The threshold as a fraction: 80 of 100.
TOP, BOTTOM = 80, 100
FREQUENT = 200_000  # tokens ordered by frequency, at most; the others are ordered by hash
LEAST_BITS = 1024  # of a set's parity bitmap
OFTEN = 0.0005  # share of a task's documents that makes a token frequent, and the least number of them
LEAST_OFTEN = 4


def shingle_sets(b: pa.RecordBatch, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, flat, and row offsets."""
    buf, offs = raw(b)
    buf = LOWER[buf]
    starts, ends, per = words(buf, offs)
    h = word_hashes(buf, starts, ends)
    row = rows_of(per)
    factor = mix(np.arange(1, k + 1, dtype=U)) | U(1)
    if len(h) >= k:
        ok = np.flatnonzero(row[: len(h) - k + 1] == row[k - 1 :])
        v = np.zeros(len(h) - k + 1, U)
        for i in range(k):
            v += h[i : len(h) - k + 1 + i] * factor[i]
        v, r = mix(v[ok]), row[ok]
    else:
        v, r = np.zeros(0, U), np.zeros(0, np.int64)
    count = np.diff(per)
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        pos = np.arange(len(h)) - np.repeat(per[:-1], count)
        w = h * factor[np.minimum(pos, k - 1)]
        at = per[:-1][short]
        total = np.concatenate((np.zeros(1, U), np.cumsum(w)))
        v = np.concatenate((v, mix(total[at + count[short]] - total[at] ^ mix(count[short].astype(U)))))
        r = np.concatenate((r, short))
    o = np.lexsort((v, r))
    v, r = v[o], r[o]
    if len(v):
        new = np.concatenate(([True], (v[1:] != v[:-1]) | (r[1:] != r[:-1])))
        v, r = v[new], r[new]
    return v, np.searchsorted(r, np.arange(b.num_rows + 1))


def signatures(v: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """One hash of each whole set, of its members and size."""
    total = np.concatenate((np.zeros(1, U), np.cumsum(mix(v ^ U(0x5851F42D4C957F2D)))))
    return mix((total[offs[1:]] - total[offs[:-1]]) ^ mix(np.diff(offs).astype(U)))


def parities(v: np.ndarray, offs: np.ndarray) -> list[bytes]:
    """A parity bitmap of each set; the number of slots is a power of two, at least three a member."""
    n = np.diff(offs)
    size = np.maximum(LEAST_BITS, 1 << np.ceil(np.log2(np.maximum(1, 3 * n))).astype(np.int64))
    slot = mix(v ^ U(0x2545F4914F6CDD1D)).view(np.int64)
    out: list[bytes] = [b""] * len(n)
    for bits in np.unique(size):
        rows = np.flatnonzero(size == bits)
        for lo in range(0, len(rows), max(1, (1 << 22) // int(bits))):
            some = rows[lo : lo + max(1, (1 << 22) // int(bits))]
            at = np.repeat(offs[some] - np.concatenate(([0], np.cumsum(n[some])[:-1])), n[some]) + np.arange(int(n[some].sum()))
            where = np.repeat(np.arange(len(some)), n[some]) * bits + (slot[at] & (bits - 1))
            packed = np.packbits((np.bincount(where, minlength=len(some) * int(bits)) & 1).astype(np.uint8).reshape(len(some), -1), axis=1)
            for r, x in zip(some, packed, strict=True):
                out[r] = x.tobytes()
    return out


def _scan(batches):
    """kind 0: (x doc_id, n, sig, bits) of each document; kind 1: (sig token, n documents) of tokens frequent in the task."""
    schema = ["kind", "x", "n", "sig", "bits"]
    seen, docs = [], 0

    def frequent(least):
        t = np.sort(np.concatenate(seen))
        at = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1])))
        n = np.diff(np.append(at, len(t)))
        use = n >= least
        return pa.RecordBatch.from_arrays([pa.array(np.ones(use.sum(), np.int32)), pa.array(np.zeros(use.sum(), np.int64)), pa.array(n[use]), pa.array(longs(t[at][use])), pa.nulls(int(use.sum()), pa.binary())], schema)

    for b in slices(tidy(batches)):
        v, offs = shingle_sets(b)
        bits = pa.array(parities(v, offs), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(np.zeros(b.num_rows, np.int32)), b.column(0), pa.array(np.diff(offs)), pa.array(longs(signatures(v, offs))), bits], schema)
        seen.append(v)
        docs += b.num_rows
        if sum(map(len, seen)) > 8_000_000:
            yield frequent(max(LEAST_OFTEN, OFTEN * docs))
            seen, docs = [], 0
    if docs and sum(map(len, seen)):
        yield frequent(max(LEAST_OFTEN, OFTEN * docs))


def prefix_length(n: np.ndarray) -> np.ndarray:
    return np.where(n > 0, n - (TOP * n + BOTTOM - 1) // BOTTOM + 1, 0)


def _prefixes(v: np.ndarray, offs: np.ndarray, order: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, token, position) of the prefix of each set in the global order."""
    tokens, place = order
    row, n = rows_of(offs), np.diff(offs)
    if len(tokens) and len(v):
        j = np.minimum(np.searchsorted(tokens, v), len(tokens) - 1)
        late = np.where(tokens[j] == v, place[j] + 1, 0)
        if late.any():
            v = v[np.argsort(row * (len(tokens) + 2) + late, kind="stable")]
    pos = np.arange(len(v)) - np.repeat(offs[:-1], n)
    use = np.flatnonzero(pos < prefix_length(n)[row])
    return row[use], v[use], pos[use]


def _prefix_tokens(order):
    def run(batches):
        for b in slices(tidy(batches)):
            yield pa.RecordBatch.from_arrays([pa.array(longs(_prefixes(*shingle_sets(b), order.value)[1]))], ["tok"])

    return run


def _postings(order, live):
    def run(batches):
        seen = np.zeros(0, U)  # sets of this task that are in the lists already: a task's copies are one
        for b in slices(tidy(batches)):
            v, offs = shingle_sets(b)
            sig = signatures(v, offs)
            row, tok, pos = _prefixes(v, offs, order.value)
            tok = longs(tok)
            use = may_hold(live.value, tok)
            n = np.diff(offs)
            share = 1000 * np.bincount(row, weights=use, minlength=len(n)) // np.maximum(1, prefix_length(n))
            _, first = np.unique(sig, return_index=True)
            new = np.zeros(len(n), bool)
            new[first] = ~np.isin(sig[first], seen)
            seen = np.concatenate((seen, sig[new]))
            use &= new[row]
            row, tok, pos = row[use], tok[use], pos[use]
            yield pa.RecordBatch.from_arrays([pa.array(tok), pa.array(longs(sig[row])), pa.array(n[row].astype(np.int32)), pa.array(pos.astype(np.int32)), pa.array(share[row].astype(np.int32))], ["tok", "sig", "n", "pos", "share"])

    return run


def _members(wanted):
    """(sig, members as bytes) of the sets that may be wanted."""

    def run(batches):
        for b in slices(tidy(batches)):
            v, offs = shingle_sets(b)
            sig = longs(signatures(v, offs))
            use = np.flatnonzero(may_hold(wanted.value, sig) & (np.diff(offs) > 0))
            _, at = np.unique(sig[use], return_index=True)
            use = use[at]
            data = v.tobytes()
            yield pa.RecordBatch.from_arrays([pa.array(sig[use]), pa.array([data[8 * offs[i] : 8 * offs[i + 1]] for i in use], pa.binary())], ["sig", "members"])

    return run


def _overlaps(batches):
    """(a, b, common, na, nb): exact overlaps of pairs of sets."""
    for t in batches:
        a, b = t.column(2).to_pylist(), t.column(3).to_pylist()
        common = np.zeros(len(a), np.int64)
        last, x = None, None
        for i, (p, q) in enumerate(zip(a, b, strict=True)):
            if p is not last:
                last, x = p, np.frombuffer(p, U)
            y = np.frombuffer(q, U)
            both = np.sort(np.concatenate((x, y)))
            common[i] = np.count_nonzero(both[1:] == both[:-1])
        na, nb = (np.array([len(s) // 8 for s in z], np.int64) for z in (a, b))
        yield pa.RecordBatch.from_arrays([t.column(0), t.column(1), pa.array(common), pa.array(na), pa.array(nb)], ["a", "b", "common", "na", "nb"])


def _differ(x: list[bytes], y: list[bytes]) -> np.ndarray:
    """Differing bits of pairs of bitmaps; a longer one is folded to the other's slots, which keeps parities."""
    out = np.zeros(len(x), np.int64)
    sizes = np.array([(len(a), len(b)) for a, b in zip(x, y, strict=True)])
    for size in np.unique(sizes, axis=0):
        rows = np.flatnonzero((sizes == size).all(axis=1))
        for lo in range(0, len(rows), max(1, (1 << 22) // int(size.max()))):
            some = rows[lo : lo + max(1, (1 << 22) // int(size.max()))]
            sides = []
            for z, width in ((x, size[0]), (y, size[1])):
                m = np.frombuffer(b"".join(z[i] for i in some), U).reshape(len(some), -1)
                while width > size.min():
                    m = m[:, : m.shape[1] // 2] ^ m[:, m.shape[1] // 2 :]
                    width //= 2
                sides.append(m)
            out[some] = np.bitwise_count(sides[0] ^ sides[1]).sum(axis=1, dtype=np.int64)
    return out


def _alike(batches):
    """Pairs whose bitmaps leave the threshold possible, and how many bits differ."""
    for t in batches:
        if t.num_rows:
            differ = _differ(t.column(4).to_pylist(), t.column(5).to_pylist())
            n = t.column(2).to_numpy() + t.column(3).to_numpy()
            out = pa.RecordBatch.from_arrays([t.column(0), t.column(1), pa.array(differ)], ["a", "b", "differ"])
            yield out.filter(pa.array((TOP + BOTTOM) * differ <= (BOTTOM - TOP) * n))


def _compared(near: DataFrame, d: DataFrame) -> DataFrame:
    """Exact overlaps of pairs (a, b): (a, b, common, na, nb)."""
    wanted = id_filter(near.select("a").union(near.select("b")).distinct(), "a")
    sets = d.select("text").mapInArrow(_members(wanted), "sig long, members binary").groupBy("sig").agg(F.first("members").alias("members"))
    one = near.select("a", "b").join(sets.select(F.col("sig").alias("b"), F.col("members").alias("mb")), "b")
    two = one.join(sets.select(F.col("sig").alias("a"), F.col("members").alias("ma")), "a")
    return written(two.select("a", "b", "ma", "mb").mapInArrow(_overlaps, "a long, b long, common long, na long, nb long"), "compared")


def _near(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The distinct pairs (a, b) that pass the bitmap test: (a, b, differ).  sets: (sig, n, bits) of documents; only those asked for move."""
    asked = pairs.select(F.col("a").alias("sig")).union(pairs.select("b")).distinct()
    nodes = sets.join(asked, "sig", "left_semi").groupBy("sig").agg(F.first("n").alias("n"), F.first("bits").alias("bits"))
    x = pairs.join(nodes.select(F.col("sig").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("y")), "b")
    x = x.join(nodes.select(F.col("sig").alias("a"), F.col("n").alias("na"), F.col("bits").alias("x")), "a")
    return written(x.select("a", "b", "na", "nb", "x", "y").mapInArrow(_alike, "a long, b long, differ long"), "near")


_LINKED = f"{TOP + BOTTOM} * common >= {TOP} * (na + nb)"


def _reach(na: str, pa_: str, nb: str, pb: str) -> str:
    """SQL: sets of these sizes that share a token at these positions, none before, can reach the threshold."""
    return f"{BOTTOM} * least({na}, {nb}) >= {TOP} * greatest({na}, {nb}) and {TOP + BOTTOM} * least({na} - {pa_}, {nb} - {pb}) >= {TOP} * ({na} + {nb})"


def link_sets(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, sig) of all documents, and (node, comp) of the sets that link with others."""
    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scan = written(d.mapInArrow(_scan, "kind int, x long, n long, sig long, bits binary"), "sets")
    sets = scan.where("kind = 0").select(F.col("x").alias("doc_id"), "n", "sig")
    nodes = scan.where("kind = 0 and n > 0").select("sig", "n", "bits")
    often = scan.where("kind = 1").groupBy("sig").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "sig").limit(FREQUENT).toArrow()  # at most FREQUENT rows
    tok = often.column("sig").to_numpy().view(U)
    by_count = np.lexsort((tok, often.column("n").to_numpy()))
    place = np.empty(len(tok), np.int64)
    place[by_count] = np.arange(len(tok))
    o = np.argsort(tok)
    order = spark.sparkContext.broadcast((tok[o], place[o]))

    live = id_filter(d.select("text").mapInArrow(_prefix_tokens(order), "tok long").groupBy("tok").count().where("count > 1"), "tok")
    # the lists meet once, by token; lists of one set are of no use
    found = d.select("text").mapInArrow(_postings(order, live), "tok long, sig long, n int, pos int, share int").repartition("tok").dropDuplicates(["tok", "sig"])
    found = found.withColumn("band", F.floor(F.log("n") / F.log(F.lit(1.12))).cast("int"))
    # a leader in each list and band of sizes: the set with the largest share of its prefix in lists, as the
    # original of a group of edited copies has, while each copy's own edits are in no list
    lists, bands = Window.partitionBy("tok"), Window.partitionBy("tok", "band")
    led = found.withColumns({"sets": F.count("*").over(lists), "top": F.max(F.struct("share", "sig", "n", "pos")).over(bands), "c": F.count("*").over(bands)}).where("sets > 1")
    led = written(led.select("tok", "sig", "n", "pos", *(F.when(F.col("c") > 1, F.col(f"top.{x}")).alias(y) for x, y in (("sig", "lead"), ("n", "ln"), ("pos", "lp")))), "lists")
    stars = led.where("lead <> sig and " + _reach("n", "pos", "ln", "lp")).select(F.col("lead").alias("a"), F.col("sig").alias("b")).distinct()
    stars = written(stars, "stars")
    close = _near(stars, nodes)
    best = close.groupBy("b").agg(F.min(F.struct("differ", "a")).alias("m")).select("m.a", "b")
    first = _compared(best, d)
    links = first.where(_LINKED).select("a", "b")
    comp = connected(links)

    # what that leaves open: pairs of one list in different components
    known = first.select(F.col("a").alias("lead"), F.col("b").alias("sig"), (F.col("common") / (F.col("na") + F.col("nb") - F.col("common"))).alias("jl"))
    open_ = led.drop("ln", "lp").join(comp.withColumnRenamed("node", "sig"), "sig", "left").withColumn("comp", F.coalesce("comp", "sig"))
    open_ = open_.withColumns({"least": F.min("comp").over(lists), "most": F.max("comp").over(lists)}).where("least <> most").drop("least", "most")
    open_ = open_.join(known, ["lead", "sig"], "left").withColumn("jl", F.when(F.col("lead") == F.col("sig"), 1.0).otherwise(F.col("jl")))
    open_ = written(open_.select("tok", "sig", "n", "pos", "comp", "lead", "jl"), "open")
    blocks = open_.groupBy("tok", "n", "pos").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    x, y = blocks.alias("x"), blocks.alias("y")
    near = x.join(y, F.expr("x.tok = y.tok and (x.n < y.n or (x.n = y.n and x.pos <= y.pos)) and " + _reach("x.n", "x.pos", "y.n", "y.pos")) & F.expr("not (x.lo = x.hi and y.lo = y.hi and x.lo = y.lo)"))
    near = near.select(F.col("x.tok").alias("tok"), F.col("x.n").alias("n"), F.col("x.pos").alias("pos"), F.col("y.n").alias("n2"), F.col("y.pos").alias("pos2"))
    left = open_.join(near, ["tok", "n", "pos"]).alias("l")
    right = open_.select("tok", F.col("n").alias("n2"), F.col("pos").alias("pos2"), "sig", "comp", "lead", "jl").alias("r")
    skip = F.expr("l.lead = r.lead and abs(l.jl - r.jl) > %r" % (1 - TOP / BOTTOM + 1e-9))
    rest = left.join(right, ["tok", "n2", "pos2"]).where(F.expr("l.comp <> r.comp")).where(~F.coalesce(skip, F.lit(False))).select(F.least("l.sig", "r.sig").alias("a"), F.greatest("l.sig", "r.sig").alias("b")).distinct()
    done = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    later = close.join(first, ["a", "b"], "left_anti").join(comp.select(F.col("node").alias("a"), F.col("comp").alias("ca")), "a", "left").join(comp.select(F.col("node").alias("b"), F.col("comp").alias("cb")), "b", "left")
    later = later.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = _near(rest.join(done, ["a", "b"], "left_anti"), nodes).select("a", "b").unionByName(later).distinct()
    new = _compared(written(more, "more"), d).where(_LINKED).select("a", "b")
    return sets, comp if new.isEmpty() else connected(links.unionByName(new))


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, n, sig, comp (a component's smallest sig, null for empty sets) and component_id of every row."""
    sets, comp = link_sets(docs)
    nodes = sets.where("n > 0").groupBy("sig").agg(F.min("doc_id").alias("least"))
    nodes = nodes.join(comp.withColumnRenamed("node", "sig"), "sig", "left").withColumn("comp", F.coalesce("comp", "sig"))
    least = nodes.groupBy("comp").agg(F.min("least").alias("component_id"))
    named = nodes.join(least, "comp").select("sig", "comp", "component_id")
    some = sets.where("n > 0").join(named, "sig").select("doc_id", "n", "sig", "comp", "component_id")
    return some.unionByName(sets.where("n = 0").select("doc_id", "n", "sig", F.lit(None).cast("long").alias("comp"), F.col("doc_id").alias("component_id")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    return classes(docs).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """docs with one row of each component, that of the smallest doc_id; rows with empty sets all stay.

    Rows that are certainly the only ones of their component are not shuffled.
    """
    found = written(classes(docs).where("n > 0"), "classes")
    first = found.groupBy("comp").agg(F.min(F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("d"), "sig")).alias("w"), F.count("*").alias("rows")).where("rows > 1")
    several = found.join(first.select("comp", "w"), "comp").select("sig", "w").distinct()
    asked = id_filter(several, "sig")
    names = docs.columns

    def signed(hold: bool):
        def run(batches):
            for b in slices(tidy(batches)):
                v, offs = shingle_sets(b)
                sig = longs(signatures(v, offs))
                use = np.flatnonzero(((np.diff(offs) > 0) & may_hold(asked.value, sig)) == hold)
                if len(use):
                    at = pa.array(use)
                    cols = [c.take(at) for c in b.columns]
                    yield pa.RecordBatch.from_arrays([*cols, pa.array(sig[use])], [*b.schema.names, "__sig"]) if hold else pa.RecordBatch.from_arrays(cols, b.schema.names)

        return run

    alone = docs.mapInArrow(signed(False), docs.schema)
    held = docs.mapInArrow(signed(True), T.StructType([*docs.schema.fields, T.StructField("__sig", T.LongType())]))
    held = held.join(several.withColumnRenamed("sig", "__sig"), "__sig", "left")
    mine = F.col("w").isNull() | ((F.col("w.sig") == F.col("__sig")) & (F.col("w.d") == F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))))
    held = held.where(mine)
    lone = held.where("w is null").select(*names)
    kept = held.where("w is not null").dropDuplicates(["__sig", "doc_id"]).select(*names)
    return alone.unionByName(lone).unionByName(kept)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
