"""Substring deduplication of words with compressed FM-indexes.

A window is 20 consecutive words of one document; every word covered by a window whose words also start
earlier (smaller doc_id, or earlier in the same document) is removed.  ``anchors`` routes the text around word
runs that recur to shards of bounded size.  A shard numbers its words, sorts its suffixes, and keeps the
Burrows-Wheeler transform as a wavelet matrix of packed bits with counts by 64-bit word.  The shard's
documents are then streamed against the index: backward search extends all windows leftwards in
lockstep, giving each its matching statistic (the longest match with another place, up to the window length);
a window that reaches the threshold belongs to the class of its index interval, and all but
the first window of a class are reported.  An anchor with too many different segments for one shard is
dealt over several, whose window classes are merged by grouping their 64-bit hashes.

Words are told apart by a 64-bit hash.  Defined cases: a null text has no words; texts below 20 words keep
everything; rows equal in doc_id and text count as one document, reported for each row; a null doc_id comes
last; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .anchors import Spec, cover, keyed, repeated_ranges, with_ranges
from .op3_suffix_dedup import suffix_array
from .store import documents
from .text import U, raw, word_hashes, words

LENGTH = 20
SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<lo:int,hi:int>>"


def word_symbols(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, per = words(buf, offs)
    return word_hashes(buf, starts, ends), per


def word_cut(buf: np.ndarray, offs: np.ndarray, row: np.ndarray, start: np.ndarray, n: np.ndarray) -> list[bytes]:
    starts, ends, per = words(buf, offs)
    data, at = buf.tobytes(), per[row] + start
    return [data[a:b] for a, b in zip(starts[at].tolist(), ends[at + n - 1].tolist(), strict=True)]


class FMIndex:
    """Backward search for patterns of at most ``depth`` symbols over a text of small integers."""

    def __init__(self, text: np.ndarray, depth: int):
        self.n = len(text)
        sa, _ = suffix_array(text, depth)
        seq = text[sa - 1]  # the symbol before each suffix, cyclic
        sigma = int(text.max(initial=0)) + 1
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=sigma))))
        self.levels = []
        base = np.zeros(sigma, np.int64)
        symbols = np.arange(sigma)
        for shift in range(max(1, int(sigma - 1).bit_length()) - 1, -1, -1):
            bit = (seq >> shift) & 1
            padded = np.concatenate((bit.astype(np.uint8), np.zeros(-self.n % 64 + 64, np.uint8)))
            packed = np.packbits(padded, bitorder="little").view("<u8").astype(U)
            count = np.concatenate(([0], np.cumsum(np.bitwise_count(packed).astype(np.int64))))[:-1]
            zeros = self.n - int(bit.sum())
            self.levels.append((shift, packed, count, zeros))
            base = self._down(base, (symbols >> shift) & 1, packed, count, zeros)
            seq = np.concatenate((seq[bit == 0], seq[bit == 1]))
        self.base = base

    @staticmethod
    def _down(at, bit, packed, count, zeros):
        w = at >> 6
        ones = count[w] + np.bitwise_count(packed[w] & ((U(1) << (at & 63).astype(U)) - U(1)))
        return np.where(bit == 1, zeros + ones, at - ones)

    def step(self, lo: np.ndarray, hi: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The interval of c followed by what [lo, hi) stands for."""
        at, cc = np.concatenate((lo, hi)), np.concatenate((c, c))
        for shift, packed, count, zeros in self.levels:
            at = self._down(at, (cc >> shift) & 1, packed, count, zeros)
        at = self.first[cc] + at - self.base[cc]
        return at[: len(lo)], at[len(lo) :]


def matching_statistics(index: FMIndex, text: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For windows that end before ``ends``: symbols matched elsewhere, from the right, up to length; and the interval's start or -1."""
    n = len(ends)
    stat, where = np.zeros(n, np.int64), np.full(n, -1, np.int64)
    act = np.arange(n)
    lo, hi = np.zeros(n, np.int64), np.full(n, index.n, np.int64)
    for k in range(length):
        lo, hi = index.step(lo, hi, text[ends[act] - 1 - k])
        many = hi - lo > 1  # one place is the window itself
        stat[act[many]] = k + 1
        act, lo, hi = act[many], lo[many], hi[many]
        if not len(act):
            break
    where[act] = lo
    return stat, where


def word_match(segs: list[bytes], windows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The class of each window of the segments that occurs more than once in the shard, else -1."""
    offs = np.concatenate(([0], np.cumsum([len(x) for x in segs])))
    h, per = word_symbols(np.frombuffer(b"".join(segs), np.uint8), offs)
    _, ids = np.unique(h, return_inverse=True)
    text = np.insert(ids.astype(np.int64) + 1, per[1:], 0)
    first = per[:-1] + np.arange(len(segs))
    index = FMIndex(text, LENGTH)
    at = np.repeat(first, windows) + np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
    return matching_statistics(index, text, at + LENGTH, LENGTH)[1]


SPEC = Spec(LENGTH, 8, word_symbols, word_cut, word_match, earlier=True, shard_bytes=1_200_000)


def _report(batches):
    for b in batches:
        if not b.num_rows:
            continue
        buf, offs = raw(b)
        data = buf.tobytes()
        rows = {k: [] for k in ("doc_id", "n_words", "n_removed", "kept_sha256", "spans")}
        for i, (doc, found) in enumerate(zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True)):
            w = data[offs[i] : offs[i + 1]].split()  # bytes split on 0x20 and 0x09-0x0D
            spans, removed, kept = [], 0, w
            if found:
                gone = cover([(r["lo"], r["hi"]) for r in found], len(w))
                edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
                spans = [{"lo": int(lo), "hi": int(hi)} for lo, hi in zip(edge[::2], edge[1::2], strict=True)]
                removed, kept = int(gone.sum()), compress(w, (~gone).tolist())
            rows["doc_id"].append(doc)
            rows["n_words"].append(len(w))
            rows["n_removed"].append(removed)
            rows["kept_sha256"].append(hashlib.sha256(b" ".join(kept)).hexdigest())
            rows["spans"].append(spans)
        span = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
        yield pa.RecordBatch.from_arrays([pa.array(v, span if k == "spans" else pa.string() if k == "kept_sha256" else pa.int64()) for k, v in rows.items()], list(rows))


def dedup_words(docs: DataFrame, spec: Spec = SPEC) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and the removed spans (in words) of every document."""
    d = keyed(docs)
    return with_ranges(d, repeated_ranges(d, spec), SCHEMA, _report)


def op2_fm_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_words(documents(spark, sf_dir)).drop("spans")
