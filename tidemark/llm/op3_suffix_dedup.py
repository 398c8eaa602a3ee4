"""Substring deduplication of bytes by suffix arrays.

Every byte that lies in a 400-byte string which also starts anywhere else is removed.  ``anchors`` routes the
text around byte runs that recur to shards of bounded size.  A shard concatenates its segments, sorts all
their suffixes by Larsson-Sadakane refinement (groups of equal prefixes are re-sorted by the rank of
what follows, doubling the prefix each round, only groups still tied), and takes the common prefix of
neighbours in the suffix array in text order with Kasai's bound (it shrinks by one from a
suffix to the next).  A window is repeated if a neighbour shares 400 bytes; two suffixes that are alone in sharing ``PAIRED``
bytes are neighbours in either order and are not sorted further.  An anchor with too many different
segments for one shard is dealt over several, whose window classes are merged by grouping their 64-bit hashes.

The query also reports ``n_passage``, the bytes that shorter repeats cover: strings of 256 bytes, which a passage of
some 50 words has and 400 bytes may miss.  A repeat of 400 bytes consists of these, so the longer search reads only the
stretches of 400 bytes and more that they cover.

Defined cases: a null text is empty; texts below 400 bytes keep everything; matches never cross
documents; rows equal in doc_id and text repeat each other; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .anchors import PIECE, Spec, passing, keyed, repeated_ranges, with_ranges
from .store import documents, id_filter, written
from .text import U, mix, raw, slices

LENGTH, PASSAGE = 400, 256
PAIRED = 40  # symbols that a pair of suffixes shares before it is left to the comparison of neighbours
_VALUE = mix(np.arange(1, 257, dtype=U) * U(0xC2B2AE3D27D4EB4F))
SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, n_passage long, kept_sha256 string, spans array<struct<lo:int,hi:int>>"


def byte_symbols(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return _VALUE[buf], offs


def byte_cut(buf: np.ndarray, offs: np.ndarray, row: np.ndarray, start: np.ndarray, n: np.ndarray) -> list[bytes]:
    data, lo = buf.tobytes(), offs[row] + start
    return [data[a:b] for a, b in zip(lo.tolist(), (lo + n).tolist(), strict=True)]


def suffix_array(text: np.ndarray, depth: int, coarse: int = 0, pairs: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of text (small integers) sorted by their first ``depth`` symbols at least, and ranks by some number of
    symbols that is at most ``coarse`` (equal where those are equal).

    Two suffixes that are alone in sharing ``pairs`` symbols or more, if given, stay next to each other unsorted: a third
    suffix that may come between them would share these, and one that leads on to them shares more with one other at most.
    """
    n = len(text)
    wide = max(1, int(n).bit_length())
    bits = max(1, int(text.max(initial=0) + 1).bit_length())
    h = max(1, min(8, (63 - wide) // bits))
    pairs = depth if pairs is None else pairs
    ext = np.concatenate((text.astype(U), np.zeros(h, U)))
    key = np.zeros(n, U)
    for i in range(h):
        key = (key << U(bits)) | ext[i : i + n]
    packed = (key << U(wide)) | np.arange(n, dtype=U)
    packed.sort()
    low = U((1 << wide) - 1)
    kind = np.int32 if n < 1 << 30 else np.int64
    sa = (packed & low).astype(kind)
    packed >>= U(wide)
    rank = np.zeros(n + 1, kind)
    head = np.ones(n + 1, bool)  # one more, for the end
    np.not_equal(packed[1:], packed[:-1], out=head[1:-1]) if n else None
    rank[sa] = np.maximum.accumulate(np.where(head[:-1], np.arange(1, n + 1, dtype=kind), 0))
    half = rank.copy()
    tied = np.flatnonzero(~(head[:-1] & head[1:])).astype(kind)  # slots of groups with over one suffix
    while len(tied) and h < depth:
        half = rank.copy() if h <= coarse < 2 * h else half
        i = sa[tied]
        own, then = rank[i].astype(U), rank[np.minimum(i + kind(h), kind(n))].astype(U)
        if 3 * wide + 1 <= 63:
            own <<= U(2 * wide + 1)
            then <<= U(wide)
            own |= then
            own |= i.astype(U)
            own.sort()
            i = (own & low).astype(kind)
            own >>= U(wide)
            pair = own
        else:
            o = np.lexsort((i, then, own))
            i, pair = i[o], (own[o] << U(32)) | then[o]
        head = np.ones(len(i) + 1, bool)
        np.not_equal(pair[1:], pair[:-1], out=head[1:-1])
        sa[tied] = i
        rank[i] = np.maximum.accumulate(np.where(head[:-1], tied + kind(1), 0))
        h *= 2
        go_on = ~(head[:-1] & head[1:])
        if h >= pairs:
            two = np.flatnonzero(head[:-2] & ~head[1:-1] & head[2:])
            go_on[two] = go_on[two + 1] = False
        tied = tied[go_on]
    return sa, half


def _extend(words: np.ndarray, i: np.ndarray, j: np.ndarray, cap: int) -> np.ndarray:
    """Common prefixes of pairs of suffixes, up to cap; words: the eight bytes from each place on."""
    out = np.zeros(len(i), np.int64)
    act = np.arange(len(i))
    for step in range(0, cap, 8):
        x = words[np.minimum(i[act] + step, len(words) - 1)] ^ words[np.minimum(j[act] + step, len(words) - 1)]
        same = x == 0
        bad = act[~same]
        low = x[~same] & (~x[~same] + U(1))
        out[bad] = step + (np.bitwise_count(low - U(1)).astype(np.int64) >> 3)
        act = act[same]
        if not len(act):
            break
    out[act] = cap
    return np.minimum(out, cap)


def repeated(text: np.ndarray, raw_bytes: np.ndarray, ends: np.ndarray, length: int) -> np.ndarray:
    """For each place of text whether its next ``length`` symbols also start elsewhere.

    ends: for each place the end of its segment, which no match crosses.
    """
    n = len(text)
    sa, half = suffix_array(text, length, length, PAIRED)
    prev = np.full(n, -1, np.int64)
    prev[sa[1:]] = sa[:-1]
    # neighbours that differ early, or whose segment ends sooner, share less
    can = (prev >= 0) & (ends - np.arange(n) >= length)
    p = np.flatnonzero(can)
    p = p[(half[p] == half[prev[p]]) & (ends[prev[p]] - prev[p] >= length)]
    pad = np.concatenate((raw_bytes, np.zeros(8, np.uint8)))
    words = np.zeros(n + 1, U)
    for k in range(8):
        words |= pad[k : k + n + 1].astype(U) << U(8 * k)
    # the common prefix with another place drops by one from a suffix to the next, while both go on
    step = 32
    lead = p[(p % step == 0) | ~np.isin(p - 1, p)]
    reach = np.zeros(n, np.int64)
    reach[lead] = np.minimum(_extend(words, lead, prev[lead], length + step), np.minimum(ends[lead] - lead, ends[prev[lead]] - prev[lead]))
    at = np.zeros(n, np.int64)
    at[lead] = lead
    at = np.maximum.accumulate(at)
    gone = p - at[p]
    other = prev[at[p]] + gone
    sure = reach[at[p]] - gone >= length
    both = np.zeros(n, bool)
    both[p[sure]] = both[other[sure]] = True
    # the place before in the array is another one than the lead goes on to
    rest = p[prev[p] != other]
    rest = rest[_extend(words, rest, prev[rest], length) >= length]
    both[rest] = both[prev[rest]] = True
    return both


def byte_match(segs: list[bytes], windows: np.ndarray, order: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """0 for each window of the segments that occurs more than once in the shard, else -1."""
    lens = np.array([len(x) for x in segs], np.int64)
    data = np.frombuffer(b"\0".join(segs) + b"\0", np.uint8)
    first = np.concatenate(([0], np.cumsum(lens + 1)[:-1]))
    code = np.cumsum(np.bincount(data, minlength=256) > 0)  # few bits a symbol, so that the first sort sees many
    text = code[data]
    text[first + lens] = 0
    ends = np.repeat(first + lens, lens + 1)
    hit = repeated(text, data, ends, length)
    at = np.repeat(first, windows) + np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
    return np.where(hit[at], 0, -1)


SPEC = Spec(LENGTH, 200, byte_symbols, byte_cut, byte_match, earlier=False, shard_bytes=180_000, run=1 << 15)  # arrays of a shard stay in a core's cache


def shorter(spec: Spec, length: int) -> Spec:
    return spec._replace(length=length, gram=length // 2, match=functools.partial(byte_match, length=length))


def _covered(buf: np.ndarray, offs: np.ndarray, row: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """True for each byte of all texts that a range of its row covers."""
    n = len(buf) + 1
    depth = np.zeros(n, np.int32)
    np.add.at(depth, offs[row] + lo, 1)
    np.add.at(depth, offs[row] + hi, -1)
    return np.cumsum(depth[:-1], dtype=np.int32) > 0


def _edges(mask: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of a mask over all texts; runs end with their row."""
    before = np.concatenate(([False], mask[:-1])) if len(mask) else mask
    before[offs[:-1][offs[:-1] < len(mask)]] = False
    after = np.append(mask[1:], False) if len(mask) else mask
    after[offs[1:][offs[1:] > 0] - 1] = False
    return np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1


def _report(batches):
    span = pa.struct([("lo", pa.int32()), ("hi", pa.int32())])
    for b in slices(batches, max_bytes=PIECE):
        buf, offs = raw(b)
        lists = b.column(2)
        per = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        flat = lists.flatten()
        row = np.repeat(np.arange(b.num_rows), per)
        lo, hi, whole = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("lo", "hi", "whole"))
        gone, passage = _covered(buf, offs, row[whole], lo[whole], hi[whole]), _covered(buf, offs, row, lo, hi)
        starts, ends = _edges(gone, offs)
        first = np.searchsorted(starts, offs)
        at = offs[np.searchsorted(offs, starts, side="right") - 1]
        count = lambda mask: np.diff(np.concatenate(([0], np.cumsum(mask)))[offs])
        removed, data = count(gone), buf.tobytes()
        keys = [hashlib.sha256(buf[x:y][~gone[x:y]].tobytes() if r else data[x:y]).hexdigest() for x, y, r in zip(offs[:-1].tolist(), offs[1:].tolist(), removed.tolist(), strict=True)]
        pairs = pa.StructArray.from_arrays([pa.array((starts - at).astype(np.int32)), pa.array((ends - at).astype(np.int32))], fields=list(span))
        spans = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pairs)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(offs)), pa.array(removed), pa.array(np.diff(first)), pa.array(count(passage)), pa.array(keys, pa.string()), spans], ["doc_id", "n_bytes", "n_removed", "n_spans", "n_passage", "kept_sha256", "spans"])


def _stretches(length: int):
    """d, r, at, text of the maximal stretches, of ``length`` bytes at least, that the ranges of a document cover."""

    def run(batches):
        for b in slices(batches, max_bytes=PIECE):
            buf, offs = raw(b)
            lists = b.column(b.schema.get_field_index("ranges"))
            flat = lists.flatten()
            row = np.repeat(np.arange(b.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            starts, ends = _edges(_covered(buf, offs, row, flat.field("lo").to_numpy(), flat.field("hi").to_numpy()), offs)
            keep = ends - starts >= length
            starts, ends = starts[keep], ends[keep]
            row, data = np.searchsorted(offs, starts, side="right") - 1, buf.tobytes()
            texts = [data[x:y] for x, y in zip(starts.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), b.column(1).take(pa.array(row)), pa.array((starts - offs[row]).astype(np.int32)), pa.array(texts, pa.binary())], ["d", "r", "at", "text"])

    return run


def longer_ranges(docs: DataFrame, short: DataFrame, spec: Spec) -> DataFrame:
    """repeated_ranges of the whole documents, looked for in what the ranges of shorter repeats cover."""
    inside = docs.select("d", "r", "text").mapInArrow(passing(id_filter(short, "d")), "d long, r long, text string").join(short, ["d", "r"])
    cut = inside.select("d", "r", "text", "ranges").mapInArrow(_stretches(spec.length), "d long, r long, at int, text binary")
    cut = written(cut.withColumn("own", F.xxhash64("r", "at")), "stretches")
    found = repeated_ranges(cut.select("d", F.col("own").alias("r"), "text"), spec).withColumnRenamed("r", "own")
    back = found.join(cut.select("d", "own", "r", "at").distinct(), ["d", "own"])
    moved = F.transform("ranges", lambda x: F.struct((x["lo"] + F.col("at")).alias("lo"), (x["hi"] + F.col("at")).alias("hi")))
    return back.select("d", "r", moved.alias("ranges"))


def dedup_bytes(docs: DataFrame, spec: Spec = SPEC, passage: int = PASSAGE) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, n_passage, kept_sha256 and the removed spans of every document."""
    d = keyed(docs)
    short = repeated_ranges(d, shorter(spec, passage))
    long = longer_ranges(d, short, spec)
    both = [x.select("d", "r", F.transform("ranges", lambda y: F.struct(y["lo"].alias("lo"), y["hi"].alias("hi"), F.lit(whole).alias("whole"))).alias("ranges")) for x, whole in ((short, False), (long, True))]
    ranges = both[0].unionByName(both[1]).groupBy("d", "r").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))  # of one document
    return with_ranges(d, ranges, SCHEMA, _report)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_bytes(documents(spark, sf_dir)).drop("spans")
