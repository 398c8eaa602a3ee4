"""Scoring texts by a hashed maximum-entropy language model with a class-factored softmax.

P(word | history) = P(class | history) * P(word | class, history).  A word's class is a hash of its last two
bytes (the end of a text is a class of its own), and its code is ``WORD_BITS`` bits of its hash, so no vocabulary is
broadcast and unseen words have both.  Hashed features of the history are the word before, the word
before that (skip), and both (bigram); each has a row of ``CLASS_BITS + WORD_BITS`` trained weights, and a
history's vector v is the sum of its rows.  The first factor is a softmax over the classes with logits
bias + v . signs(class number).  The second is proportional to (count + 1) * exp(v . signs(code)), so words of a
class are told apart by the history as far as their codes differ; words of one class and code differ by their counts
alone.  It is normalised exactly, over the sums of count + 1 by class and code; each class and code has one pooled
unseen word besides.

Each kind of feature has as many hashed rows as there are training tokens (``ROWS`` at least), so the table grows with the corpus.
It is never in one place: a group of documents takes minibatch AdaGrad steps over all its training tokens once, on the
rows it meets; the rows go to shards by row number, where those of all groups are averaged by occurrences (clipped at 255), and each
group gets back the rows that its texts meet.  On the way a weight has four bits (steps of ``STEP``).

Counts cover the whole training corpus and are exact up to a 64-bit hash of the token.  Documents are
dealt into groups of about ``GROUP_BYTES`` of text by a hash of their id; each group's distinct tokens go to the shards
by ranges of their hash, with the rows, and come back with their corpus counts, so a frequent token
costs one entry a group, and no task holds the vocabulary.  Texts are shuffled once, compressed: training and scoring are one plan.

Defined cases: a null or empty text is the end token alone; with an empty training part N = V = 0 and
all counts are 0; repeated rows are scored each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .op6_language_id import held_out
from .store import documents, written
from .text import LOWER, U, longs, mix, raw, slices, tidied, tidy, word_hashes, words

GROUP_BYTES = 8 << 20
END_TOKEN = np.uint64(0x656E64206F662074)
START = np.uint64(0x7374617274206F66)
FEATURES = 3
CLASS_BITS, WORD_BITS = 5, 7
WIDTH = CLASS_BITS + WORD_BITS
ROWS = 8192
STEP = 0.2
LARGE = np.float32(5)  # of a history's weight; seven of them stay within single precision
_ZSTD = pa.Codec("zstd", compression_level=1)


class Shape(NamedTuple):
    """Classes with the end's (at most 2 ** CLASS_BITS), and the training's batch and rate."""

    classes: int = 32
    batch: int = 4096
    rate: float = 0.3


def signs(bits: int) -> np.ndarray:
    """A column of +1 and -1 for every number of so many bits."""
    return (((np.arange(1 << bits) >> np.arange(bits)[:, None]) & 1) * 2 - 1).astype(np.float32)


def codes(h: np.ndarray) -> np.ndarray:
    """The code of each word hash."""
    return ((h >> U(20)) & U((1 << WORD_BITS) - 1)).astype(np.int64)


def tokens(b: pa.RecordBatch, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes (each text's words, then the end), their classes, and offsets by text."""
    buf, offs = raw(b)
    buf = LOWER[buf]
    starts, ends, per = words(buf, offs)
    h = word_hashes(buf, starts, ends)
    last = buf[ends - 1].astype(U) if len(ends) else np.zeros(0, U)
    prior = np.where(ends - starts > 1, buf[np.maximum(ends - 2, 0)], 0).astype(U) if len(ends) else np.zeros(0, U)
    k = (mix((prior << U(8)) | last | U(1 << 40)) % U(shape.classes - 1)).astype(np.int64)
    h = np.insert(h, per[1:], END_TOKEN)
    k = np.insert(k, per[1:], shape.classes - 1)
    return h, k, per + np.arange(len(per))


def histories(h: np.ndarray, offs: np.ndarray, size: int) -> np.ndarray:
    """Rows of the weight table, of size rows for each kind of feature, for each token's history: FEATURES columns."""
    pos = np.arange(len(h)) - np.repeat(offs[:-1], np.diff(offs))
    one, two = np.full(len(h), START), np.full(len(h), START)
    one[1:] = np.where(pos[1:] >= 1, h[:-1], START)
    two[2:] = np.where(pos[2:] >= 2, h[:-2], START)
    n = U(size)
    both = mix(one * U(0x9E3779B97F4A7C15) + two)
    return np.stack([(mix(one) % n), (mix(two ^ U(0xABCDEF)) % n) + n, (both % n) + U(2) * n], axis=1).astype(np.int64)


class Texts(NamedTuple):
    """A group's tokens: hashes, classes, offsets by text, the distinct rows of their histories, and each token's places among these."""

    h: np.ndarray
    k: np.ndarray
    offs: np.ndarray
    rows: np.ndarray
    at: np.ndarray


def _numbered(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and each value's place among them."""
    coded = pa.array(x).dictionary_encode()
    found = coded.dictionary.to_numpy()
    o = np.argsort(found)
    place = np.empty(len(o), np.int32)
    place[o] = np.arange(len(o), dtype=np.int32)
    return found[o], place[coded.indices.to_numpy()]


def read(docs: pa.Table, shape: Shape, size: int) -> Texts:
    hs, ks, lens, rows = [], [], [np.zeros(1, np.int64)], []
    kind = np.int32 if FEATURES * size < 1 << 31 else np.int64  # at half the memory
    for b in slices(docs.to_batches()):
        h, k, offs = tokens(b, shape)
        hs.append(h)
        ks.append(k.astype(np.uint8))
        lens.append(np.diff(offs))
        rows.append(histories(h, offs, size).astype(kind))
    h, found = np.concatenate(hs), []
    at = np.empty((len(h), FEATURES), np.int32)
    for j in range(FEATURES):  # a kind's rows come before those of the next
        distinct, place = _numbered(np.concatenate([x[:, j] for x in rows]))
        at[:, j] = place + sum(map(len, found))
        found.append(distinct)
    return Texts(h, np.concatenate(ks), np.cumsum(np.concatenate(lens)), np.concatenate(found).astype(np.int64), at)


def _exponentials(v: np.ndarray) -> np.ndarray:
    """exp(v . signs) of every history (a column): products of exp(v), doubled bit by bit."""
    ratio = np.exp(np.float32(2) * v)
    out = np.empty((1 << len(v), v.shape[1]), np.float32)
    np.exp(-v.sum(axis=0), out=out[0])
    for j in range(len(v)):
        np.multiply(out[: 1 << j], ratio[j], out=out[1 << j : 2 << j])
    return out


class Softmax(NamedTuple):
    """Both factors: class biases, and the sums of count + 1 (and of the unseen word) by class and code.

    Tokens come ordered by class, a token a column, so that those of one class share one product of matrices.
    """

    bias: np.ndarray
    mass: np.ndarray

    def sums(self, v: np.ndarray, k: np.ndarray, parts: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """For each row of parts the sum, over the classes and over the codes of the token's class, of its products with the weights of these."""
        first = (parts[0] * np.exp(self.bias)) @ _exponentials(v[:CLASS_BITS])[: len(self.bias)]
        e, second = _exponentials(v[CLASS_BITS:]), np.empty((len(parts[1]), len(k)), np.float32)
        cut = np.searchsorted(k, np.arange(len(self.mass) + 1))
        for i in np.flatnonzero(np.diff(cut)):
            x = slice(cut[i], cut[i + 1])
            second[:, x] = (parts[1] * self.mass[i]) @ e[:, x]
        return first, second

    def logs(self, v: np.ndarray, k: np.ndarray, h: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Natural logs of P(word | history) for words with hashes h and counts n, in any order; v has a row a word."""
        o = np.argsort(k.astype(np.uint8), kind="stable")
        c, s = signs(CLASS_BITS)[:, : len(self.bias)], signs(WORD_BITS)
        x, k, code = np.clip(v[o].T, -LARGE, LARGE), k[o], codes(h[o])
        first, second = self.sums(x, k, (np.ones((1, c.shape[1]), np.float32), np.ones((1, s.shape[1]), np.float32)))
        own = (x[:CLASS_BITS] * c[:, k]).sum(axis=0) + (x[CLASS_BITS:] * s[:, code]).sum(axis=0) + self.bias[k]
        out = np.empty(len(o))
        out[o] = own - np.log(first[0].astype(np.float64)) - np.log(second[0].astype(np.float64)) + np.log(n[o] + 1.0)
        return out


def fit(t: Texts, learn: np.ndarray, model: Softmax, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """Weights of t.rows after one pass over the tokens marked in learn, and how often these met each row."""
    w = np.zeros((len(t.rows), WIDTH + 1), np.float32)  # the last column: summed squares of the slopes
    w[:, WIDTH] = 1e-6
    c, s = signs(CLASS_BITS)[:, : shape.classes], signs(WORD_BITS)
    with_sum = lambda x: np.concatenate([np.ones((1, x.shape[1]), np.float32), x])
    parts = with_sum(c), with_sum(s)
    order = np.random.default_rng(len(t.h)).permutation(np.flatnonzero(learn))  # a batch mixes texts
    for lo in range(0, len(order), shape.batch):
        i = order[lo : lo + shape.batch]
        i = i[np.argsort(t.k[i], kind="stable")]
        flat, k = t.at[i].ravel(), t.k[i]
        o = np.argsort(flat, kind="stable")
        sorted_ = flat[o]
        new = np.concatenate(([True], sorted_[1:] != sorted_[:-1]))
        at, place = np.flatnonzero(new), np.empty(len(o), np.int32)
        place[o] = np.cumsum(new, dtype=np.int32) - 1
        u = sorted_[at]
        x = w.take(u, axis=0)  # each row is fetched and stored once a batch
        one, two, both = place.reshape(-1, FEATURES).T
        v = x.take(one, axis=0) + x.take(two, axis=0) + x.take(both, axis=0)
        first, second = model.sums(np.clip(v[:, :WIDTH].T, -LARGE, LARGE), k, parts)
        g = np.concatenate([first[1:] / first[0] - c[:, k], second[1:] / second[0] - s[:, codes(t.h[i])]]).T.copy()
        d = np.add.reduceat(g.take(o // FEATURES, axis=0), at, axis=0)
        x[:, WIDTH] += np.einsum("ij,ij->i", d, d) / np.float32(WIDTH)
        x[:, :WIDTH] -= d * (np.float32(shape.rate) / np.sqrt(x[:, WIDTH:]))
        w[u] = x
    return w[:, :WIDTH], np.bincount(t.at[order].ravel(), minlength=len(t.rows))


def packed(w: np.ndarray) -> bytes:
    """Two weights a byte."""
    q = np.empty((WIDTH // 2, len(w)), np.uint8)
    for j, out in enumerate(q):
        pair = (np.clip(np.rint(w[:, 2 * j : 2 * j + 2] / np.float32(STEP)), -7, 7) + 8).astype(np.uint8)
        out[:] = (pair[:, 0] << 4) | pair[:, 1]
    return q.tobytes()


def unpacked(data: np.ndarray) -> np.ndarray:
    q = data.reshape(WIDTH // 2, -1)
    out = np.empty((q.shape[1], WIDTH), np.float32)
    for j, x in enumerate(q):
        out[:, 2 * j], out[:, 2 * j + 1] = x >> 4, x & 15
    out -= 8
    out *= np.float32(STEP)
    return out


def _squeezed(*parts: bytes) -> bytes:
    data = b"".join(parts)
    return len(data).to_bytes(4, "little") + _ZSTD.compress(data, asbytes=True)


def _full(body: bytes) -> np.ndarray:
    return np.frombuffer(_ZSTD.decompress(body[4:], int.from_bytes(body[:4], "little"), asbytes=True), np.uint8)


def _bytes_apart(x: np.ndarray) -> bytes:
    """All first bytes, then all second ones, and so on."""
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def _together(data: np.ndarray, kind: str) -> np.ndarray:
    return np.ascontiguousarray(data.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _cuts(rows: np.ndarray, size: int, shards: int) -> tuple[np.ndarray, int]:
    """Where the rows of each shard begin among sorted rows (and the end), and a shard's number of rows."""
    span = -(-FEATURES * size // shards)
    return np.searchsorted(rows, np.arange(shards + 1) * span), span


def _word_cuts(h: np.ndarray, shards: int) -> np.ndarray:
    """Where the hashes of each shard begin among sorted hashes (and the end)."""
    return np.concatenate((np.searchsorted(h, np.arange(shards, dtype=U) * U(((1 << 64) - 1) // shards)), [len(h)]))


def _texts(docs: pa.Table) -> pa.Table:
    """docs with the texts that ``dealt`` has packed, in an order of their own, whatever order they came in."""
    text = pa.array([_ZSTD.decompress(x[4:], int.from_bytes(x[:4], "little"), asbytes=True) for x in docs.column("text").to_pylist()], pa.binary())
    docs = docs.set_column(docs.column_names.index("text"), "text", text)
    return docs.take(pc.sort_indices(docs, [("doc_id", "ascending"), ("text", "ascending")])).combine_chunks()


def dealt(d: DataFrame) -> DataFrame:
    """d with texts compressed, as all of them are shuffled."""

    def run(batches):
        for b in slices(tidy(batches)):
            at = b.schema.get_field_index("text")
            text = pa.array([_squeezed(x) for x in b.column(at).cast(pa.binary()).to_pylist()], pa.binary())
            yield b.set_column(at, "text", text)

    return d.mapInArrow(run, "doc_id long, text binary, held_out boolean, g int")


def learned(d: DataFrame, sent, shape: Shape, size: int, shards: int) -> DataFrame:
    """g, shard, body, words: trained weights of the rows, and corpus counts of the tokens, that a group's texts meet in a shard, in their order."""
    schema = "g int, shard int, body binary, words binary"
    names = ["g", "shard", "body", "words"]

    @tidied
    def train(docs: pa.Table) -> pa.Table:
        docs = _texts(docs)
        t = read(docs, shape, size)
        learn = np.repeat(~docs.column("held_out").to_numpy(), np.diff(t.offs))
        h, place = _numbered(t.h)
        c, of_word = np.bincount(place[learn], minlength=len(h)), _word_cuts(h, shards)
        w, n = fit(t, learn, sent.value, shape)
        n = np.minimum(n, 255).astype(np.uint8)
        cut, span = _cuts(t.rows, size, shards)
        shard = np.flatnonzero(np.diff(cut) + np.diff(of_word))
        body, words = [], []
        for i in shard:
            x, y = slice(cut[i], cut[i + 1]), slice(of_word[i], of_word[i + 1])
            gaps = np.diff(t.rows[x] - i * span, prepend=0).astype("<u4")
            body.append(_squeezed(_bytes_apart(gaps), n[x].tobytes(), packed(w[x])))
            words.append(_squeezed(h[y].astype("<u8").tobytes(), _bytes_apart(c[y].astype("<u4"))))
        return pa.table([pa.repeat(docs.column("g")[0], len(shard)), pa.array(shard, pa.int32()), pa.array(body, pa.binary()), pa.array(words, pa.binary())], names)

    def means(bodies: list[bytes]) -> list[bytes]:
        rows, n, q = [], [], []
        for body in bodies:
            x = _full(body)
            m = len(x) // (5 + WIDTH // 2)
            rows.append(np.cumsum(_together(x[: 4 * m], "<u4"), dtype=np.int64))
            n.append(x[4 * m : 5 * m])
            q.append(x[5 * m :].reshape(WIDTH // 2, m))
        _, at = _numbered(np.concatenate(rows))
        times, cut = np.concatenate(n).astype(np.float64), np.cumsum([0, *map(len, rows)])
        total, q = np.maximum(np.bincount(at, times), 1), np.concatenate(q, axis=1)
        for pair in q:
            high, low = (np.rint(np.bincount(at, (x.astype(np.float64) - 8) * times) / total).astype(np.int8) + 8 for x in (pair >> 4, pair & 15))
            pair[:] = ((high << 4) | low).astype(np.uint8)[at]
        return [_squeezed(q[:, a:b].tobytes()) for a, b in zip(cut, cut[1:], strict=False)]

    def counts(words: list[bytes]) -> list[bytes]:
        h, c = [], []
        for x in map(_full, words):
            m = len(x) // 12
            h.append(x[: 8 * m].view("<u8"))
            c.append(_together(x[8 * m :], "<u4"))
        _, at = _numbered(np.concatenate(h))
        total, cut = np.bincount(at, np.concatenate(c)).astype("<i8"), np.cumsum([0, *map(len, h)])
        return [_squeezed(_bytes_apart(total[at[a:b]])) for a, b in zip(cut, cut[1:], strict=False)]

    @tidied
    def merge(t: pa.Table) -> pa.Table:
        body, words = means(t.column("body").to_pylist()), counts(t.column("words").to_pylist())
        return pa.table([t.column("g"), t.column("shard"), pa.array(body, pa.binary()), pa.array(words, pa.binary())], names)

    return d.groupBy("g").applyInArrow(train, schema).groupBy("shard").applyInArrow(merge, schema)


def _distinct(shape: Shape):
    """(token, class, n): tokens of training texts with their number, summed over a run of rows."""

    def run(batches):
        for b in slices(tidy(batches), max_bytes=8 << 20):
            h, k, _ = tokens(b, shape)
            distinct, place = _numbered(h)
            kinds = np.empty(len(distinct), np.int16)
            kinds[place] = k
            yield pa.RecordBatch.from_arrays([pa.array(longs(distinct)), pa.array(kinds), pa.array(np.bincount(place, minlength=len(distinct)))], ["h", "k", "n"])

    return run


def score(docs: DataFrame, held: Column, shape: Shape = Shape()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of all rows; learns from those not held."""
    spark = docs.sparkSession
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), held.alias("held_out"))
    size = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, math.ceil(size / GROUP_BYTES))
    d = d.withColumn("g", F.pmod(F.xxhash64(F.coalesce(F.col("doc_id"), F.lit(0)), F.octet_length("text")), F.lit(groups)).cast("int"))
    counts = d.where(~F.col("held_out")).select("text").mapInArrow(_distinct(shape), "h long, k short, n long").groupBy("h").agg(F.first("k").alias("k"), F.sum("n").alias("c"))
    code = F.shiftrightunsigned("h", 20).bitwiseAND((1 << WORD_BITS) - 1)
    n, v = np.zeros((2, shape.classes, 1 << WORD_BITS))
    for x in counts.groupBy("k", code.alias("s")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():  # classes x codes rows
        n[x["k"], x["s"]], v[x["k"], x["s"]] = x["n"], x["v"]
    total, distinct = int(n.sum()), int(v.sum())
    bias = np.log((n.sum(axis=1) + 1) / (total + shape.classes)).astype(np.float32)
    sent = spark.sparkContext.broadcast(Softmax(bias, (n + v + 1).astype(np.float32)))
    rows = max(ROWS, total)
    base_log = math.log10(total + distinct + 1)

    @tidied
    def group(docs: pa.Table, known: pa.Table) -> pa.Table:
        none = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
        if not docs.num_rows:
            return none.empty_table()
        model = sent.value
        docs = _texts(docs)
        t = read(docs, shape, rows)
        known = known.take(pc.sort_indices(known, [("shard", "ascending")]))
        w = np.concatenate([unpacked(_full(x)) for x in known.column("body").to_pylist()])
        n = np.concatenate([_together(_full(x), "<i8") for x in known.column("words").to_pylist()])[_numbered(t.h)[1]]
        p = np.empty(len(t.h))
        for lo in range(0, len(p), shape.batch):
            s = slice(lo, lo + shape.batch)
            one, two, both = t.at[s].T
            p[s] = model.logs(w.take(one, axis=0) + w.take(two, axis=0) + w.take(both, axis=0), t.k[s], t.h[s], n[s])
        at, n_tokens = t.offs[:-1], np.diff(t.offs)
        base = np.add.reduceat(np.log10(n + 1.0), at) - n_tokens * base_log
        cols = [docs.column("doc_id"), docs.column("held_out"), n_tokens, np.add.reduceat((n > 0).astype(np.int64), at), np.full(len(at), total), base, np.add.reduceat(p, at) / math.log(10)]
        return pa.table(cols, schema=none)

    # one plan, so that both uses of the texts share one shuffle
    texts = dealt(d.select("doc_id", "text", "held_out", "g"))
    known = learned(texts, sent, shape, rows, groups)
    scores = texts.groupBy("g").cogroup(known.groupBy("g")).applyInArrow(group, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return written(scores, "scores")


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir), held_out(F.col("doc_id"), 7, 2))
