"""Spelling variants: words one edit apart, found in k-d trees over letter counts.

One inserted, deleted or replaced letter moves a word's vector of letter counts by an L1 distance of at most two,
and in a known direction: a replacement adds one to at most one count and takes one from at most one, an insertion
only adds one.  So for each pair of lengths (l, l) and (l, l + 1) a box-pruned range search over the vectors gives few
candidates, and a look at the order of letters decides.  Letters beyond a-z share six counts; sharing only shrinks distances.

Two levels.  Above, one k-d tree a word length, split at medians of a bounded sample of words (``Shape.sample``, lowest
hashes; it shapes the cells, never the results), gives cells of some ``block`` words; a cell that the exact counts find larger
is dealt by hash into several blocks.  Every word is home in one block and asks each block of its own length that stands after its
own, and each of the next length, whose cell can hold a word one edit away: each pair meets in exactly one block.  Below,
a task builds a k-d tree over a block's words and takes its askers down it together, a whole array at a node.
A block that many words ask is searched in lanes of ``lane`` askers, counted before.

Words are counted in ``mapInArrow`` from whole texts, summed in each task before the shuffle.  Only the top tree's
cells with their counts (``Shape.cells`` at most) reach the driver.

Defined cases: null and empty texts hold no words; repeated rows count each; a null id is an empty one in the hash; of
near words with equal n the smallest in code-point order is the form; an empty table gives no rows; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import documents, written
from .text import slices


class Shape(NamedTuple):
    least: int = 7  # code points of a word
    twice: int = 2  # occurrences of a word
    spoilt: int = 31  # one run in so many loses a code point
    factor: int = 10  # a form is so many times as frequent
    sample: int = 100_000  # words that shape the cells, at most
    cells: int = 32_768  # at most
    block: int = 4096  # words in a block, about
    lane: int = 65_536  # askers of a block in one task, about
    leaf: int = 32


#: Word characters of the query, A-Z lower-cased: all are one byte in Latin-1.
RUN = "[a-zÀ-ÿ]"
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DIMS = 32


def _counted(shape: Shape):
    """(word, n) summed over a task's texts, in parts of bounded size."""
    find = re.compile(f"{RUN}{{{shape.least},}}").findall

    def out(held: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    def run(batches):
        held: dict[str, int] = {}
        for b in slices(batches):
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if not text:
                    continue
                own = Counter(find(text.lower() if text.isascii() else text.translate(_LOWER)))
                key = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for w, n in own.items():
                    h = zlib.crc32(w.encode(), key)
                    if h % shape.spoilt == 0:
                        at = h % len(w)
                        w = w[:at] + w[at + 1 :]
                        if len(w) < shape.least:
                            continue
                    held[w] = held.get(w, 0) + n
                if len(held) > 200_000:
                    yield out(held)
                    held = {}
        if held:
            yield out(held)

    return run


def word_counts(docs: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """(word, n): the words of all texts that are long and frequent enough."""
    got = docs.select("doc_id", F.col("text").cast("string")).mapInArrow(_counted(shape), "word string, n long")
    return got.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= shape.twice)


class Words(NamedTuple):
    """Words of one length as an array of letters and one of letter counts."""

    letters: np.ndarray
    counts: np.ndarray


def spell(words: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The letters of all words, one after the other, and where each word begins (one more at the end)."""
    x = [w.encode("latin-1") for w in words.to_pylist()]
    return np.frombuffer(b"".join(x), np.uint8), np.concatenate(([0], np.cumsum([len(w) for w in x], dtype=np.int64)))


def letter_counts(letters: np.ndarray, starts: np.ndarray) -> np.ndarray:
    dim = np.where((letters >= 97) & (letters <= 122), letters - 97, 26 + letters % 6).astype(np.int64)
    row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    return np.bincount(row * DIMS + dim, minlength=(len(starts) - 1) * DIMS).reshape(-1, DIMS).astype(np.int16)


def of_length(letters: np.ndarray, starts: np.ndarray, which: np.ndarray, length: int) -> Words:
    rows = letters[starts[which][:, None] + np.arange(length)] if len(which) else np.zeros((0, length), np.uint8)
    return Words(rows, letter_counts(rows.ravel(), np.arange(len(rows) + 1) * length))


def within(x: np.ndarray, lo: np.ndarray, hi: np.ndarray, down: int) -> np.ndarray:
    """Whether the box can hold x with at most one count more and at most ``down`` counts less."""
    more = np.maximum(lo - x, 0).sum(axis=-1)
    less = np.maximum(x - hi, 0).sum(axis=-1)
    return (more <= 1) & (less <= down)


def halves(x: np.ndarray) -> tuple[int, int] | None:
    """Count and bound of the most even cut along the widest spread: left is below the bound."""
    spread = x.var(axis=0)
    for d in np.argsort(-spread, kind="stable")[:4]:
        if spread[d] == 0:
            break
        low = np.bincount(x[:, d]).cumsum()[:-1]
        at = int(np.abs(low - len(x) / 2).argmin())
        if 0 < low[at] < len(x):
            return int(d), at + 1
    return None


def near_in_block(home: Words, asker: Words, leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """(asker, home) rows of all pairs one edit apart; askers are as long as the home words or one letter shorter."""
    down = 1 - (home.letters.shape[1] - asker.letters.shape[1])
    found = []
    todo = [(np.arange(len(home.counts)), np.arange(len(asker.counts)))]
    while todo:
        h, a = todo.pop()
        if not len(h) or not len(a):
            continue
        x = home.counts[h]
        a = a[within(asker.counts[a], x.min(axis=0), x.max(axis=0), down)]
        cut = halves(x) if len(h) > leaf and len(a) else None
        if cut:
            left = x[:, cut[0]] < cut[1]
            todo += [(h[left], a), (h[~left], a)]
            continue
        # words with equal counts cannot be told apart by boxes, so a leaf may be large: a bounded piece of it at once
        for p in range(0, len(h), 256):
            for q in range(0, len(a), 4096):
                hp, aq = h[p : p + 256], a[q : q + 4096]
                i, j = np.nonzero(within(asker.counts[aq][:, None], home.counts[hp][None], home.counts[hp][None], down))
                i, j = aq[i], hp[j]
                ok = one_edit(asker.letters[i], home.letters[j])
                found.append((i[ok], j[ok]))
    return tuple(np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))


def one_edit(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether rows of letters, the second as long or one longer, differ by exactly one edit."""
    n = short.shape[1]
    if long.shape[1] == n:
        return (short != long).sum(axis=1) == 1
    # equal letters from the front, and from the back, cover the shorter word
    front = np.logical_and.accumulate(short == long[:, :n], axis=1).sum(axis=1)
    back = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return front + back >= n


class Cells(NamedTuple):
    """The top tree: for each length its nodes (dimension, bound, left, right) with leaves as -1 - cell, and the cells' boxes."""

    trees: dict[int, list[tuple[int, int, int, int]]]
    roots: dict[int, int]
    lo: np.ndarray
    hi: np.ndarray


def grow(letters: np.ndarray, starts: np.ndarray, share: float, shape: Shape) -> Cells:
    """Cells of some block's words each, by a sample that holds ``share`` of all words."""
    sizes = np.diff(starts)
    counts = letter_counts(letters, starts)
    most = max(1.0, shape.block * share / 2, len(sizes) * 2 / shape.cells)
    trees, roots, lo, hi = {}, {}, [], []
    top = np.iinfo(np.int16).max

    def node(x, nodes, low, high):
        cut = halves(x) if len(x) > most else None
        if not cut:
            lo.append(low)
            hi.append(high)
            return -len(lo)
        at = len(nodes)
        nodes.append(None)
        d, bound = cut
        left = x[:, d] < bound
        up, down = high.copy(), low.copy()
        up[d], down[d] = bound - 1, bound
        nodes[at] = (d, bound, node(x[left], nodes, low, up), node(x[~left], nodes, down, high))
        return at

    for length in np.unique(sizes).tolist():
        trees[length] = []
        roots[length] = node(counts[sizes == length], trees[length], np.zeros(DIMS, np.int16), np.full(DIMS, top, np.int16))
    return Cells(trees, roots, np.array(lo, np.int16).reshape(-1, DIMS), np.array(hi, np.int16).reshape(-1, DIMS))


def home_cells(x: np.ndarray, length: int, cells: Cells) -> np.ndarray:
    """The cell of each vector; -1 if the sample had no word of the length."""
    out = np.full(len(x), -1)
    todo = [(cells.roots[length], np.arange(len(x)))] if length in cells.roots else []
    while todo:
        at, who = todo.pop()
        if at < 0:
            out[who] = -1 - at
        elif len(who):
            d, bound, left, right = cells.trees[length][at]
            low = x[who, d] < bound
            todo += [(left, who[low]), (right, who[~low])]
    return out


def asked_cells(x: np.ndarray, length: int, cells: Cells, down: int) -> tuple[np.ndarray, np.ndarray]:
    """(vector, cell) for the cells of a length that can hold a near word."""
    got = []
    todo = [(cells.roots[length], np.arange(len(x)), np.zeros(DIMS, np.int16), np.full(DIMS, np.iinfo(np.int16).max, np.int16))] if length in cells.roots else []
    while todo:
        at, who, lo, hi = todo.pop()
        who = who[within(x[who], lo, hi, down)]
        if not len(who):
            continue
        if at < 0:
            got.append((who, np.full(len(who), -1 - at)))
            continue
        d, bound, left, right = cells.trees[length][at]
        up, low = hi.copy(), lo.copy()
        up[d], low[d] = bound - 1, bound
        todo += [(left, who, lo, up), (right, who, low, hi)]
    return tuple(np.concatenate([g[k] for g in got]) if got else np.zeros(0, np.int64) for k in (0, 1))


def _hashed(starts: np.ndarray, letters: np.ndarray) -> np.ndarray:
    from .text import word_hashes

    return word_hashes(letters, starts[:-1], starts[1:])


def _dealt(sent):
    """(block, home, h, word, n): every word to its home block and to each block that it asks; h is a hash of the word."""

    def run(batches):
        cells, first, salts, odd = sent.value
        for b in batches:
            if not b.num_rows:
                continue
            letters, starts = spell(b.column(0))
            sizes, h = np.diff(starts), _hashed(starts, letters)
            row, block, home = [], [], []

            def put(r, to, is_home, row=row, block=block, home=home):
                row.append(r)
                block.append(to)
                home.append(np.full(len(r), is_home))

            for length in np.unique(sizes).tolist():
                who = np.flatnonzero(sizes == length)
                x = of_length(letters, starts, who, length).counts
                own = home_cells(x, length, cells)
                # lengths that the sample lacks have one cell each, outside the tree
                mine = np.where(own >= 0, first[own] + (h[who] % salts[own].astype(np.uint64)).astype(np.int64), -1 - length)
                put(who, mine, True)
                for other, down in ((length, 1), (length + 1, 0)):
                    if other not in cells.roots:
                        if other > length and other in odd:
                            put(who, np.full(len(who), -1 - other), False)
                        continue
                    i, cell = asked_cells(x, other, cells, down)
                    times = salts[cell]
                    i = np.repeat(i, times)
                    at = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                    to = np.repeat(first[cell], times) + at
                    ask = to > mine[i] if other == length else np.ones(len(to), bool)
                    put(who[i[ask]], to[ask], False)
            take = pa.array(np.concatenate(row))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(block).astype(np.int64)), pa.array(np.concatenate(home)), pa.array(h.view(np.int64)).take(take), b.column(0).take(take), b.column(1).take(take)],
                ["block", "home", "h", "word", "n"],
            )

    return run


def _pairs(leaf: int):
    """Near pairs of one block and lane, each word with the other's n."""

    def run(t: pa.Table) -> pa.Table:
        letters, starts = spell(t.column("word"))
        sizes, home = np.diff(starts), t.column("home").to_numpy(zero_copy_only=False)
        own = t.column("own").to_numpy(zero_copy_only=False)
        rows = np.flatnonzero(home)
        left, right = [], []
        if len(rows):
            length = int(sizes[rows[0]])
            base = of_length(letters, starts, rows, length)
            for size in (length, length - 1):
                who = np.flatnonzero(~home & (sizes == size))
                i, j = near_in_block(base, of_length(letters, starts, who, size), leaf)
                left.append(who[i])
                right.append(rows[j])
            # pairs of the block's own words, in its first lane only
            if own[rows[0]]:
                i, j = near_in_block(base, base, leaf)
                left.append(rows[i[i < j]])
                right.append(rows[j[i < j]])
        a, b = (pa.array(np.concatenate(x) if x else np.zeros(0, np.int64)) for x in (left, right))
        word, n = t.column("word").combine_chunks(), t.column("n").combine_chunks()
        both = [pa.concat_arrays([p.take(x), p.take(y)]) for p, x, y in ((word, a, b), (word, b, a), (n, b, a))]
        return pa.Table.from_arrays(both, ["word", "near", "near_n"])

    return run


def near_words(words: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """(word, near, near_n) for every ordered pair of distinct words (word, n) one edit apart."""
    spark = words.sparkSession
    total = words.count()
    got = words.select("word").orderBy(F.xxhash64("word"), "word").limit(shape.sample).toArrow()
    letters, starts = spell(got.column("word"))
    cells = grow(letters, starts, len(got) / max(1, total), shape)
    held = spark.sparkContext.broadcast(cells)

    def at_home(batches):
        for b in batches:
            letters, starts = spell(b.column(0))
            sizes, out = np.diff(starts), np.zeros(b.num_rows, np.int64)
            for length in np.unique(sizes).tolist():
                who = np.flatnonzero(sizes == length)
                own = home_cells(of_length(letters, starts, who, length).counts, length, held.value)
                out[who] = np.where(own >= 0, own, -1 - length)
            yield pa.RecordBatch.from_arrays([pa.array(out)], ["cell"])

    sized = dict(words.select("word").mapInArrow(at_home, "cell long").groupBy("cell").count().toArrow().to_pandas().itertuples(index=False))
    salts = np.array([-(-int(sized.get(c, 0)) // (2 * shape.block)) or 1 for c in range(len(cells.lo))], np.int64)
    sent = spark.sparkContext.broadcast((cells, np.cumsum(salts) - salts, salts, {-1 - c for c in sized if c < 0}))
    dealt = words.select("word", "n").mapInArrow(_dealt(sent), "block long, home boolean, h long, word string, n long")
    # blocks asked by many words are searched in several lanes
    busy = dealt.where(~F.col("home")).groupBy("block").count().where(F.col("count") > shape.lane)
    lanes = spark.sparkContext.broadcast({r["block"]: -(-r["count"] // shape.lane) for r in busy.toLocalIterator()})

    def laned(batches):
        for b in batches:
            block, home, h = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            of = np.ones(len(block), np.int64)
            for k, v in lanes.value.items():
                of[block == k] = v
            times = np.where(home, of, 1)
            row = np.repeat(np.arange(len(block)), times)
            copy = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            lane = np.where(home[row], copy, (h[row].view(np.uint64) >> np.uint64(20)) % of[row].astype(np.uint64)).astype(np.int64)
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays([b.column(0).take(take), pa.array(lane), b.column(1).take(take), pa.array(lane == 0), b.column(3).take(take), b.column(4).take(take)], ["block", "lane", "home", "own", "word", "n"])

    spread = dealt.mapInArrow(laned, "block long, lane long, home boolean, own boolean, word string, n long")
    return spread.groupBy("block", "lane").applyInArrow(_pairs(shape.leaf), "word string, near string, near_n long")


def variants(docs: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of the texts."""
    words = written(word_counts(docs, shape), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    by_word = near_words(words, shape).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    far = F.col("best.less") * -1 >= shape.factor * F.col("n")
    formed = words.join(by_word, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(far, F.col("best.near")).alias("form"), F.when(far, -F.col("best.less")).alias("form_n")
    )
    formed = written(formed, "forms")
    # n grows by the factor at each step, so a chain of forms is short; each round doubles the steps taken
    most = formed.agg(F.max("n")).head()[0] or 1
    roots = formed.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(math.log(most, max(2, shape.factor)) + 1))):
        roots = written(roots, "roots")
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = roots.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(documents(spark, sf_dir))
