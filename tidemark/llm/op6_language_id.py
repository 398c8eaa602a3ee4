"""Language identification by rank-order profiles.

A language's profile is its most frequent letter n-grams (1 to 3 characters, words padded), ranked by
their count over all training documents.  A document's own ranked n-grams are compared with
each profile: the distance is the sum of rank differences, a missing n-gram costing the full
profile length ("out of place").  The nearest language wins, ties to the smaller name.

Counting runs in ``mapInArrow`` over whole texts; counts are summed per partition before the
shuffle, and only ``profile_size`` rows a language reach the driver.

Defined cases: a null text, or one without letters, gives ``und`` and score 0; rows without a
language are not learned from but are predicted; with nothing to learn from everything is ``und``;
an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import documents
from .text import U, mix, raw, slices, tidy

PROFILE = 400
UNKNOWN = "und"
#: Bytes of text, or one document, whose n-grams are sorted at once: a worker holds some 100 times as much.
SLICE = 512 << 10
HELD = 1_500_000  # distinct n-grams that a task sums before it passes them on
_DOC_BITS = 20
_GRAM = (np.uint64(1) << np.uint64(64 - _DOC_BITS)) - np.uint64(1)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == fold


@functools.cache
def _letters() -> np.ndarray:
    """Code point to lower-case letter, 0 for everything that is not a letter."""
    out = np.zeros(0x110000, np.int64)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            low = c.lower()
            out[cp] = ord(low) if len(low) == 1 else cp
    return out


def _grams(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct (row << 44 | n-gram) keys of all rows and their counts."""
    rows = len(offs) - 1
    cps = np.frombuffer(bytes(buf).decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    first = np.concatenate(([0], np.cumsum((buf & 0xC0) != 0x80)))[offs]  # code points before each row
    seq = _letters()[cps]
    row = np.repeat(np.arange(rows), np.diff(first))
    # a word end before each row's first character and after the last one keeps rows apart
    seq, row = np.insert(seq, first[:-1], 0), np.insert(row, first[:-1], np.arange(rows))
    seq, row = np.append(seq, [0, 0, 0]), np.append(row, [rows, rows, rows])
    keep = np.ones(len(seq), bool)
    keep[1:] = (seq[1:] != 0) | (seq[:-1] != 0) | (row[1:] != row[:-1])
    seq, row = seq[keep].astype(U), row[keep].astype(U)
    a, b, c = seq[:-2], seq[1:-1], seq[2:]
    r = row[:-2]
    # past a row's end there is a word end
    b0, c0 = np.where(row[1:-1] != r, U(0), b), np.where(row[2:] != r, U(0), c)
    two, three = (a != 0) | (b0 != 0), b0 != 0
    shift = U(64 - _DOC_BITS)
    keys = [(r[m] << shift) | (mix(code[m]) & _GRAM) for code, m in ((a, a != 0), ((b0 << U(21)) | a | U(1 << 62), two), ((c0 << U(42)) | (b0 << U(21)) | a | U(1 << 63), three))]
    keys = np.sort(np.concatenate(keys))
    keys = keys[keys < (U(rows) << shift)]
    new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[new], np.diff(np.append(new, len(keys)))


def _count(batches):
    """(lang, gram, n) summed over a task."""
    langs: list[str] = []
    known: dict[str, int] = {}
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def fold():
        k = np.concatenate([x[0] for x in held])
        n = np.concatenate([x[1] for x in held])
        o = np.argsort(k, kind="stable")
        k, n = k[o], n[o]
        new = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
        return k[new], np.add.reduceat(n, new)

    shift = U(64 - _DOC_BITS)
    for b in slices(tidy(batches), max_bytes=SLICE):
        names = b.column(b.schema.get_field_index("lang")).to_pylist()
        ids = np.array([known.setdefault(x, len(known)) for x in names], dtype=U)
        keys, n = _grams(*raw(b))
        keys = (ids[(keys >> shift).astype(np.int64)] << shift) | (keys & _GRAM)
        held.append((keys, n))
        size += len(keys)
        if size > HELD:
            held, size = [fold()], 0
            size = len(held[0][0]) // 2
    if held:
        k, n = fold()
        langs = list(known)
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()).take(pa.array((k >> shift).astype(np.int64))), pa.array((k & _GRAM).astype(np.int64)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])


def train_profiles(labelled: DataFrame, profile_size: int = PROFILE) -> dict[str, list[int]]:
    """Ranked n-grams of each language of (text, lang); rows with a null lang are left out."""
    counts = labelled.where(F.col("lang").isNotNull()).select("text", "lang").mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    top = counts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).where(F.col("rank") <= profile_size)
    out: dict[str, list[int]] = {}
    for x in top.orderBy("lang", "rank").collect():  # profile_size rows a language
        out.setdefault(x["lang"], []).append(x["gram"])
    return out


def identify(docs: DataFrame, profiles: dict[str, list[int]], profile_size: int = PROFILE, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of docs, and lang_pred and score (1 less the relative distance)."""
    keep = ["doc_id"] if keep is None else keep
    names = sorted(profiles)
    tables = []
    for x in names:
        g = np.array(profiles[x], dtype=np.uint64)
        o = np.argsort(g)
        tables.append((g[o], o.astype(np.int64)))
    sent = docs.sparkSession.sparkContext.broadcast((names, tables))

    def predict(batches):
        names, tables = sent.value
        shift = U(64 - _DOC_BITS)
        for b in slices(tidy(batches), "__text", SLICE):
            rows = b.num_rows
            keys, n = _grams(*raw(b, "__text"))
            row, gram = (keys >> shift).astype(np.int64), keys & _GRAM
            # rank within the row: by count, then by n-gram, as in the profiles
            o = np.argsort((row.astype(U) << U(32)) | (U(0xFFFFFFFF) - np.minimum(n, 0xFFFFFFFF).astype(U)), kind="stable")
            row, gram = row[o], gram[o]
            per = np.bincount(row, minlength=rows)
            rank = np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)
            use = rank < profile_size
            row, gram, rank = row[use], gram[use], rank[use]
            used = np.bincount(row, minlength=rows)
            dist = np.full((max(1, len(names)), rows), np.inf)
            for i, (g, at) in enumerate(tables):
                j = np.minimum(np.searchsorted(g, gram), len(g) - 1)
                d = np.where(g[j] == gram, np.minimum(np.abs(at[j] - rank), profile_size), profile_size)
                dist[i] = np.bincount(row, weights=d, minlength=rows)
            best = dist.argmin(axis=0)
            blank = (used == 0) | (len(names) == 0)
            score = np.where(blank, 0.0, 1.0 - dist[best, np.arange(rows)] / (np.maximum(used, 1) * float(profile_size))) if names else np.zeros(rows)
            pred = [UNKNOWN if x else names[i] for x, i in zip(blank, best, strict=True)]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), pa.array(pred, pa.string()), pa.array(np.clip(score, 0.0, 1.0))], [*keep, "lang_pred", "score"])

    picked = docs.select(*keep, F.col("text").alias("__text"))
    fields = [docs.schema[c] for c in keep]
    from pyspark.sql import types as T

    return picked.mapInArrow(predict, T.StructType([*fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = held_out(F.col("doc_id"), 4, 2)
    profiles = train_profiles(docs.where(~out))
    return identify(docs, profiles).select("doc_id", out.alias("held_out"), "lang_pred", "score")
