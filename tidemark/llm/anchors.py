"""Finding repeated windows of fixed length in all texts without comparing all with all.

A window is ``length`` consecutive symbols (bytes or words) of one document.  Its anchor is the run of ``gram``
symbols in it with the smallest hash, the leftmost if tied; equal windows have equal anchors.  A run of
windows with one anchor is a segment.

1. Anchors that occur once in the corpus cannot hold a repeat; a count by anchor hash finds the others.
2. Segments of the others are summed up by (anchor, content): a group of copies becomes one row with its count and
   its first and last occurrence (document order, then place).
3. Texts meet in shards of bounded size, where an exact index (``Spec.match``) finds equal windows.
   a) First occurrences of different segments of one anchor meet by anchor.  An anchor with more than ``hot`` of them is dealt over
   several shards, and their sorted window classes are merged afterwards by grouping their 64-bit hashes.
   b) Segments that recur whole and follow each other, in the document of their first occurrence and in that of their last, are
   one run, so that neighbours' texts are not sent twice.  A run's two texts meet, and the index tells what they share.
4. The repeated windows return to their documents as ranges of symbols.  Occurrences between the first and the last take over what
   the index found at the last; nothing is marked that an index has not found.

Documents are told apart by (d, r): d is the doc_id, null last; r is 0, or where doc_ids repeat a hash of
the text, so rows equal in both count as one document, reported for each row.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import id_filter, may_hold, written
from .text import U, longs, mix, raw, rows_of, slices

_B = 0xD1342543DE82EF95
_BI = pow(_B, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}
BLOCK = 1 << 22
PIECE = 1 << 19  # bytes of text hashed at a time, so that arrays of them stay close to a core
ALONE, FIRST, LAST = 0, 1, 2  # a segment with its anchor; a run's first and last occurrence


class Spec(NamedTuple):
    length: int
    gram: int
    symbols: Callable  # (buf, offs) -> (64-bit value of each symbol, offsets of rows in them)
    cut: Callable  # (buf, offs, row, start, n symbols) -> list of bytes
    match: Callable  # (list of bytes, windows, order) -> (window's class or -1) for each segment, flat
    earlier: bool  # only windows that also start earlier count
    shard_bytes: int = 700_000
    hot: int = 4096
    run: int = 1 << 16  # symbols of a run, about


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _powers.get("b")
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        for name, base in (("b", _B), ("i", _BI)):
            p = np.full(size, base, U)
            p[0] = 1
            _powers[name] = np.cumprod(p)
    return _powers["b"][:n], _powers["i"][:n]


def prefix_hash(vals: np.ndarray) -> Callable:
    """hash(start, end) of ranges of symbols, independent of where they stand; starts and ends are arrays of places, or slices."""
    up, down = _power(len(vals) + 1)
    p = np.concatenate((np.zeros(1, U), np.cumsum(vals * up[: len(vals)])))
    return lambda lo, hi: mix((p[hi] - p[lo]) * down[lo])


def _smallest(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values, by minima of 2, 4, 8 and so on."""
    n, span = len(v) - w + 1, 1
    while 2 * span <= w:
        v = np.minimum(v[:-span], v[span:])
        span *= 2
    return np.minimum(v[:n], v[w - span : w - span + n])


def segments(vals: np.ndarray, offs: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """row, start in the row, windows, anchor hash, content hash of all segments."""
    out: list[tuple[np.ndarray, ...]] = []
    row = rows_of(offs)
    for lo in range(0, max(0, len(vals) - length + 1), BLOCK):
        v = vals[lo : lo + BLOCK + length - 1]
        r = row[lo : lo + len(v)]
        n = len(v) - length + 1
        h = prefix_hash(v)
        at = np.arange(len(v) - gram + 1)
        g = h(slice(0, len(at)), slice(gram, None))
        low = U((1 << 28) - 1)
        best = (_smallest((g & ~low) | at.astype(U), length - gram + 1) & low).astype(np.int64)
        st = np.flatnonzero(r[:n] == r[length - 1 :])
        if not len(st):
            continue
        own = best[st]
        new = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (st[1:] != st[:-1] + 1))))
        s0, s1 = st[new], st[np.append(new[1:], len(st)) - 1]
        a = best[s0]
        content = mix(h(s0, s1 + length) ^ mix(((s1 - s0).astype(U) << U(32)) | (a - s0).astype(U)))
        out.append((r[s0], s0 + lo - offs[r[s0]], s1 - s0 + 1, g[a], content))
    if not out:
        return tuple(np.zeros(0, k) for k in (np.int64, np.int64, np.int64, U, U))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, d, r, text."""
    d = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    odd = docs.groupBy("doc_id").count().where((F.col("count") > 1) | F.col("doc_id").isNull())
    r = F.lit(0).cast("long") if odd.isEmpty() else F.xxhash64("text")
    return docs.select("doc_id", d.alias("d"), r.alias("r"), F.coalesce("text", F.lit("")).alias("text"))


def _anchors(spec: Spec):
    def run(batches):
        for b in slices(batches, max_bytes=PIECE):
            a = segments(*spec.symbols(*raw(b)), spec.length, spec.gram)[3]
            yield pa.RecordBatch.from_arrays([pa.array(longs(a))], ["a"])

    return run


def _occurrences(spec: Spec, live):
    def run(batches):
        for b in slices(batches, max_bytes=PIECE):
            row, start, n, a, s = segments(*spec.symbols(*raw(b)), spec.length, spec.gram)
            a = longs(a)
            use = np.flatnonzero(may_hold(live.value, a))
            row = pa.array(row[use])
            yield pa.RecordBatch.from_arrays([pa.array(a[use]), pa.array(longs(s)[use]), b.column(0).take(row), b.column(1).take(row), pa.array(start[use].astype(np.int32)), pa.array(n[use].astype(np.int32))], ["a", "s", "d", "r", "pos", "n"])

    return run


def _cuts(spec: Spec):
    """Texts of segments: rows hold d, r, text and the document's list of segments."""

    def run(batches):
        for b in slices(batches, max_bytes=PIECE):
            lists = b.column(b.schema.get_field_index("segs"))
            per = pa.compute.list_value_length(lists).to_numpy()
            flat = lists.flatten()
            row = np.repeat(np.arange(b.num_rows), per)
            pos, n = flat.field("pos").to_numpy(), flat.field("n").to_numpy()
            texts = spec.cut(*raw(b), row, pos, n + spec.length - 1)
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays([flat.field("a"), flat.field("salt"), flat.field("s"), flat.field("side"), b.column(0).take(at), b.column(1).take(at), flat.field("pos"), flat.field("n"), pa.array(texts, pa.binary())], ["a", "salt", "s", "side", "d", "r", "pos", "n", "seg"])

    return run


def _order(t: pa.Table) -> np.ndarray:
    """Rank of each segment in document order."""
    o = np.lexsort((t.column("pos").to_numpy(), t.column("r").to_numpy(), t.column("d").to_numpy()))
    rank = np.empty(len(o), np.int64)
    rank[o] = np.arange(len(o))
    return rank


def _spans(hit: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of hits within segments: (segment, from, to), to exclusive; first: each segment's first window, flat."""
    n = len(hit)
    seg = np.repeat(np.arange(len(first) - 1), np.diff(first))
    edge = np.concatenate(([True], seg[1:] != seg[:-1])) if n else np.zeros(0, bool)
    begin = np.flatnonzero(hit & (edge | np.concatenate(([True], ~hit[:-1]))))
    last = np.concatenate((edge[1:], [True]))
    end = np.flatnonzero(hit & (last | np.concatenate((~hit[1:], [True])))) + 1
    return seg[begin], begin - first[seg[begin]], end - first[seg[begin]]


def _places(t: pa.Table) -> pa.Table:
    """Each place once: rows equal in doc_id and text are one document."""
    c = [t.column(x).to_numpy() for x in ("pos", "r", "d")]
    o = np.lexsort(c)
    same = np.all([x[o][1:] == x[o][:-1] for x in c], axis=0)
    return t.take(pa.array(np.sort(o[np.concatenate(([True], ~same))])))


def _shard(t: pa.Table, spec: Spec) -> pa.RecordBatch:
    """Marked symbols of the segments of one shard; run: of the last occurrence of a run, its key."""
    t = _places(t) if spec.earlier else t
    n = t.column("n").to_numpy().astype(np.int64)
    first = np.concatenate(([0], np.cumsum(n)))
    rank = _order(t)
    group = spec.match(t.column("seg").to_pylist(), n, rank)
    seg = np.repeat(np.arange(len(n)), n)
    hit = np.zeros(len(group), bool)
    got = np.flatnonzero(group >= 0)
    if spec.earlier:
        o = got[np.lexsort((rank[seg[got]], group[got]))]
        hit[o[1:][group[o[1:]] == group[o[:-1]]]] = True
    else:
        hit[got] = True
    s, lo, hi = _spans(hit, first)
    at = pa.array(s)
    pos = t.column("pos").to_numpy()[s]
    run = pa.array(t.column("a").to_numpy()[s], mask=t.column("side").to_numpy()[s] != LAST)
    return pa.RecordBatch.from_arrays([t.column("d").combine_chunks().take(at), t.column("r").combine_chunks().take(at), pa.array((pos + lo).astype(np.int32)), pa.array((pos + hi - 1 + spec.length).astype(np.int32)), run], ["d", "r", "lo", "hi", "run"])


def _shards(spec: Spec):
    """Cut the rows of a partition, sorted by (runs or not, a, salt), into shards that hold whole groups.

    A place can be in a run and with its anchor, and would repeat itself: no shard holds both.
    """

    def work(t: pa.Table):
        runs = int(np.count_nonzero(t.column("salt").to_numpy() >= 0))
        for part in (t.slice(0, runs), t.slice(runs)):
            if part.num_rows:
                yield from alike(part)

    def alike(t: pa.Table):
        a, salt = t.column("a").to_numpy(), t.column("salt").to_numpy()
        heads = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (salt[1:] != salt[:-1]))))
        size = np.concatenate(([0], np.cumsum(pa.compute.binary_length(t.column("seg")).to_numpy(), dtype=np.int64)))
        at = 0
        while at < len(a):
            i = int(np.searchsorted(size[heads], size[at] + spec.shard_bytes, side="right"))
            to = int(heads[i - 1]) if i and heads[i - 1] > at and i < len(heads) else (int(heads[i]) if i < len(heads) else len(a))
            yield _shard(t.slice(at, to - at), spec)
            at = to

    def run(batches):
        held: list[pa.RecordBatch] = []
        size = 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            size += b.nbytes
            if size < 4 * spec.shard_bytes:
                continue
            t = pa.Table.from_batches(held).combine_chunks()
            a, salt = t.column("a").to_numpy(), t.column("salt").to_numpy()
            last = int(np.flatnonzero((a != a[-1]) | (salt != salt[-1]))[-1]) + 1 if (a != a[-1]).any() or (salt != salt[-1]).any() else 0
            if last:
                yield from work(t.slice(0, last))
                held = t.slice(last).combine_chunks().to_batches()
                size = sum(x.nbytes for x in held)
        if held:
            yield from work(pa.Table.from_batches(held).combine_chunks())

    return run


def _window_hashes(t: pa.Table, spec: Spec) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, segment and offset of all windows."""
    segs = t.column("seg").to_pylist()
    vals, offs = spec.symbols(np.frombuffer(b"".join(segs), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in segs]))))
    n = t.column("n").to_numpy().astype(np.int64)
    seg = np.repeat(np.arange(len(n)), n)
    x = np.arange(len(seg)) - np.repeat(np.cumsum(n) - n, n)
    at = offs[seg] + x
    return longs(prefix_hash(vals)(at, at + spec.length)), seg, x


def _merge_hot(segs: DataFrame, spec: Spec) -> DataFrame:
    """Equal windows across the shards of one anchor."""

    def classes(t: pa.Table) -> pa.Table:
        h, seg, x = _window_hashes(t, spec)
        rank = _order(t)
        o = np.lexsort((rank[seg], h))
        head = o[np.concatenate(([True], h[o][1:] != h[o][:-1]))] if len(o) else o
        s = pa.array(seg[head])
        count = np.diff(np.append(np.flatnonzero(np.concatenate(([True], h[o][1:] != h[o][:-1]))), len(o))) if len(o) else np.zeros(0, np.int64)
        return pa.Table.from_arrays([t.column("a").take(s), t.column("salt").take(s), pa.array(h[head]), pa.array(count), t.column("d").take(s), t.column("r").take(s), pa.array(t.column("pos").to_numpy()[seg[head]] + x[head].astype(np.int32))], ["a", "salt", "h", "n", "d", "r", "at"])

    local = segs.groupBy("a", "salt").applyInArrow(classes, "a long, salt int, h long, n long, d long, r long, at int")
    over = local.groupBy("a", "h").agg(F.count("*").alias("shards"), F.min(F.struct("d", "r", "at")).alias("first")).where("shards > 1")
    wide = local.select("a", "salt", "h").join(over.select("a", "h", "first.*"), ["a", "h"])

    def marks(t: pa.Table, found: pa.Table) -> pa.Table:
        h, seg, x = _window_hashes(t, spec)
        f = found.column("h").to_numpy()
        o = np.argsort(f)
        j = np.minimum(np.searchsorted(f[o], h), max(0, len(f) - 1)) if len(f) else np.zeros(0, np.int64)
        hit = f[o][j] == h if len(f) else np.zeros(len(h), bool)
        if spec.earlier and len(f):
            own = [t.column("d").to_numpy()[seg], t.column("r").to_numpy()[seg], t.column("pos").to_numpy()[seg] + x]
            hit &= ~((own[0] == found.column("d").to_numpy()[o][j]) & (own[1] == found.column("r").to_numpy()[o][j]) & (own[2] == found.column("at").to_numpy()[o][j]))
        n = t.column("n").to_numpy().astype(np.int64)
        s, lo, hi = _spans(hit, np.concatenate(([0], np.cumsum(n))))
        pos = t.column("pos").to_numpy()[s]
        return pa.Table.from_arrays([t.column("d").take(pa.array(s)), t.column("r").take(pa.array(s)), pa.array((pos + lo).astype(np.int32)), pa.array((pos + hi - 1 + spec.length).astype(np.int32))], ["d", "r", "lo", "hi"])

    return segs.groupBy("a", "salt").cogroup(wide.groupBy("a", "salt")).applyInArrow(marks, "d long, r long, lo int, hi int")


def _runs(reps: DataFrame, spec: Spec) -> DataFrame:
    """Segments that recur whole, each with its run: those that follow each other at the same distance of the same two documents."""
    apart = Window.partitionBy("d", "r", "yd", "yr", F.col("ypos") - F.col("pos")).orderBy("pos")
    s = reps.where("cnt > 1").select("a", "s", "cnt", "d", "r", "pos", "n", "yd", "yr", "ypos")
    s = s.withColumn("new", F.coalesce(F.lag(F.col("pos") + F.col("n")).over(apart) != F.col("pos"), F.lit(True)))
    s = s.withColumn("island", F.sum(F.col("new").cast("int")).over(apart))
    return s.withColumn("run", F.xxhash64("d", "r", "yd", "yr", F.col("ypos") - F.col("pos"), "island", F.floor(F.col("pos") / spec.run))).drop("new", "island")


def repeated_ranges(docs: DataFrame, spec: Spec) -> DataFrame:
    """d, r, ranges (array of struct(lo, hi), symbols) of the documents, from keyed(), that hold repeated windows."""
    spark = docs.sparkSession
    marks = "d long, r long, lo int, hi int"
    again = docs.select("text").mapInArrow(_anchors(spec), "a long").groupBy("a").count().where("count > 1")
    live = id_filter(again, "a")
    occ = written(docs.select("d", "r", "text").mapInArrow(_occurrences(spec, live), "a long, s long, d long, r long, pos int, n int"), "occurrences")
    by = occ.groupBy("a", "s").agg(F.count("*").alias("cnt"), F.min(F.struct("d", "r", "pos", "n")).alias("x"), F.max(F.struct(F.col("d").alias("yd"), F.col("r").alias("yr"), F.col("pos").alias("ypos"))).alias("y"))
    per = by.groupBy("a").agg(F.sum("cnt").alias("total"), F.count("*").alias("kinds")).where("total > 1")
    salt = F.pmod(F.xxhash64("s"), F.ceil(F.col("kinds") / spec.hot).cast("int")).cast("int")
    reps = written(by.join(per, "a").select("a", "s", "cnt", "x.*", "y.*", "kinds", salt.alias("salt"), (F.col("kinds") > spec.hot).alias("hot")), "segments")
    whole = written(_runs(reps, spec), "runs")
    ends = whole.groupBy("run").agg(*(F.min(c).alias(c) for c in ("d", "r", "pos", "yd", "yr", "ypos")), F.sum("n").cast("int").alias("n"))
    seg = lambda a, salt, s, side, pos: F.struct(a.alias("a"), salt.alias("salt"), s.alias("s"), F.lit(side).alias("side"), pos.alias("pos"), F.col("n").cast("int").alias("n"))
    run, none = F.col("run"), F.lit(-1)
    wanted = reps.where("kinds > 1").select("d", "r", seg(F.col("a"), F.col("salt"), F.col("s"), ALONE, F.col("pos")).alias("seg"))
    wanted = wanted.unionByName(ends.select("d", "r", seg(run, none, run, FIRST, F.col("pos")).alias("seg")))
    wanted = wanted.unionByName(ends.select(F.col("yd").alias("d"), F.col("yr").alias("r"), seg(run, none, run, LAST, F.col("ypos")).alias("seg")))
    lists = written(wanted.groupBy("d", "r").agg(F.collect_list("seg").alias("segs")), "lists")  # of one document
    texts = docs.select("d", "r", "text").mapInArrow(passing(id_filter(lists, "d")), f"d long, r long, text {docs.schema['text'].dataType.simpleString()}")
    shape = "a long, salt int, s long, side int, d long, r long, pos int, n int, seg binary"
    segs = texts.join(lists, ["d", "r"]).select("d", "r", "text", "segs").mapInArrow(_cuts(spec), shape)
    hot = not reps.where("hot").isEmpty()
    segs = written(segs, "texts") if hot else segs
    found = written(segs.repartition("a", "salt").sortWithinPartitions(F.col("salt") < 0, "a", "salt").mapInArrow(_shards(spec), f"{marks}, run long"), "found")
    # between its first and last occurrence a segment recurs as the index found its last one to
    sure = whole.where("cnt > 2").join(found.where("run is not null").select("run", "lo", "hi"), "run").where((F.col("lo") <= F.col("ypos")) & (F.col("ypos") + F.col("n") - 1 + spec.length <= F.col("hi")))
    sure = sure.select("a", "s", F.struct("d", "r", "pos").alias("first"), F.struct(F.col("yd").alias("d"), F.col("yr").alias("r"), F.col("ypos").alias("pos")).alias("last"))
    place = F.struct("d", "r", "pos")
    between = occ.join(sure, ["a", "s"]).where((place != F.col("first")) & (place != F.col("last")))
    found = found.drop("run").unionByName(between.select("d", "r", F.col("pos").alias("lo"), (F.col("pos") + F.col("n") - 1 + spec.length).cast("int").alias("hi")))
    if hot:
        found = found.unionByName(_merge_hot(segs.join(reps.where("hot").select("a", "s"), ["a", "s"], "left_semi").select("a", "salt", "s", "d", "r", "pos", "n", "seg"), spec))
    return written(found.groupBy("d", "r").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges")), "ranges")


def passing(wanted, hold: bool = True, report: Callable | None = None):
    """Rows whose first column may be in the filter (or surely is not); report, if given, takes them over."""

    def run(batches):
        for b in batches:
            keep = may_hold(wanted.value, b.column(0).to_numpy(zero_copy_only=False)) == hold
            if keep.any():
                yield b.filter(pa.array(keep))

    def reported(batches):
        return report(x.select(["doc_id", "text", "ranges"]) for x in run(batches))

    return reported if report else run


def cover(ranges: list[tuple[int, int]], n: int) -> np.ndarray:
    """True where a symbol is in some range."""
    edge = np.zeros(n + 1, np.int32)
    if ranges:
        r = np.array(ranges, np.int64)
        np.add.at(edge, r[:, 0], 1)
        np.add.at(edge, r[:, 1], -1)
    return np.cumsum(edge[:n]) > 0


def with_ranges(docs: DataFrame, ranges: DataFrame, schema: str, report: Callable) -> DataFrame:
    """report(batches) over (doc_id, text, ranges) of all documents; those surely without ranges are not shuffled."""
    marked = id_filter(ranges, "d")
    cols = docs.select("d", "r", F.col("doc_id").cast("long").alias("doc_id"), "text")
    inside = cols.mapInArrow(passing(marked), "d long, r long, doc_id long, text string").join(ranges, ["d", "r"], "left").select("doc_id", "text", "ranges")
    outside = cols.withColumn("ranges", F.lit(None).cast(ranges.schema["ranges"].dataType)).mapInArrow(passing(marked, False, report), schema)
    return inside.mapInArrow(report, schema).unionByName(outside)
