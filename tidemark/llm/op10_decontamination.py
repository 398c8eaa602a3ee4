"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared lower-cased with white space runs as one space.  An item of n characters may
differ by k = floor(error_rate * n) edits; cut into k + 1 pieces, at least one piece must occur
unchanged in any match.  Pieces go into one Aho-Corasick automaton; each piece hit fixes
where in the document the item can lie, and Myers' bit-parallel algorithm gives the smallest edit
distance of the whole item to any substring there.

The benchmark is broadcast only in blocks of bounded size (``block_chars``), one pass of the
documents for each block, so it may grow beyond one block.  Nothing is shuffled but the matches.

Defined cases: null and empty items match nothing; null or empty documents hold nothing; items
shorter than ``min_chars`` after normalisation match without edits and only where no word goes on beyond their ends;
repeated items match each on its own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import documents
from .text import tidy

ERROR_RATE = 0.08
MIN_CHARS = 20
BLOCK_CHARS = 4 << 20


def normal(s: str) -> str:
    return " ".join(s.lower().split())


def budget(item: str, error_rate: float, min_chars: int) -> int:
    """The edits that an item may differ by."""
    return int(len(item) * error_rate) if len(item) >= min_chars else 0


def apart(t: str, lo: int, hi: int) -> bool:
    """Whether no word of t goes on beyond either end of t[lo:hi]."""
    return not (lo and t[lo - 1].isalnum() and t[lo].isalnum()) and not (hi < len(t) and t[hi].isalnum() and t[hi - 1].isalnum())


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """(offset, piece) of errors + 1 pieces of nearly equal length."""
    n = errors + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def myers(pattern: str, text: str, limit: int) -> tuple[int, int]:
    """The smallest edit distance of pattern to a substring of text, and where that ends; (limit + 1, -1) if above limit.

    Columns of the distance matrix are kept as two bit vectors of vertical differences, in Python's
    integers of any width.
    """
    m = len(pattern)
    peq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | (1 << i)
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best, end = full, 0, m, limit + 1, -1
    for j, c in enumerate(text):
        eq = peq.get(c, 0)
        x = eq | down
        d0 = ((((eq & up) + up) ^ up) | x) & full
        hp = down | (full & ~(d0 | up))
        hn = up & d0
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        hp, hn = (hp << 1) & full, (hn << 1) & full  # a match may begin anywhere, so row 0 stays 0
        up = hn | (full & ~(d0 | hp))
        down = hp & d0
        if score < best:
            best, end = score, j + 1
    return best, end


def automaton(items: list[tuple[int, str]], error_rate: float, min_chars: int = MIN_CHARS):
    """Aho-Corasick automaton over all pieces; a hit gives (piece length, [(item index, offset)])."""
    import ahocorasick

    a = ahocorasick.Automaton()
    found: dict[str, list[tuple[int, int]]] = {}
    for i, (_, s) in enumerate(items):
        for at, piece in pieces(s, budget(s, error_rate, min_chars)):
            found.setdefault(piece, []).append((i, at))
    for piece, where in found.items():
        a.add_word(piece, (len(piece), where))
    a.make_automaton()
    return a


def scan(text: str, machine, items: list[tuple[int, str]], error_rate: float, min_chars: int = MIN_CHARS) -> list[tuple[int, int, int, int]]:
    """(item_id, edits, start, end) of the best match of each item found; start and end in the normalised text.

    start is the earliest place a match of this distance can begin: end less item length less edits, at least 0.
    """
    t = normal(text)
    spans: dict[int, list[tuple[int, int]]] = {}
    short: dict[int, tuple[int, int, int, int]] = {}
    for e, (n, where) in machine.iter(t):
        for i, at in where:
            if len(items[i][1]) < min_chars:  # one piece, the item itself
                if i not in short and apart(t, e + 1 - n, e + 1):
                    short[i] = (items[i][0], 0, e + 1 - n, e + 1)
                continue
            k = budget(items[i][1], error_rate, min_chars)
            lo = e + 1 - n - at
            spans.setdefault(i, []).append((max(0, lo - k), min(len(t), lo + len(items[i][1]) + k)))
    out = list(short.values())
    for i, found in spans.items():
        item_id, s = items[i]
        k = budget(s, error_rate, min_chars)
        best = (k + 1, -1)
        found.sort()
        lo, hi = found[0]
        for a, b in [*found[1:], (len(t) + 1, len(t) + 1)]:
            if a <= hi - len(s):  # nearly the same place: one verification over both
                hi = max(hi, b)
                continue
            if best[0] and hi - lo >= len(s) - k:
                at = t.find(s, lo, hi)
                d, end = (0, at + len(s) - lo) if at >= 0 else myers(s, t[lo:hi], k)
                if d < best[0]:
                    best = (d, lo + end)
            lo, hi = a, b
        if best[0] <= k:
            out.append((item_id, best[0], max(0, best[1] - len(s) - best[0]), best[1]))
    return out


def blocks(benchmark: DataFrame, block_chars: int):
    """Items as (item_id, normalised text), in blocks of about block_chars characters."""
    block, size = [], 0
    for x in benchmark.select("item_id", "text").where(F.col("text").isNotNull()).toLocalIterator():
        s = normal(x["text"])
        if not s:
            continue
        block.append((x["item_id"], s))
        size += len(s)
        if size > block_chars:
            yield block
            block, size = [], 0
    if block:
        yield block


def find_leaks(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, min_chars: int = MIN_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row a document and item found in it: doc_id, item_id, edits, start, end."""
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, edits int, start int, end int"
    parts = []
    for block in blocks(benchmark, block_chars):
        sent = spark.sparkContext.broadcast(block)

        def match(batches, sent=sent):
            items = sent.value
            machine = automaton(items, error_rate, min_chars)
            for b in tidy(batches):
                rows = [(d, *hit) for d, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) if s for hit in scan(s, machine, items, error_rate, min_chars)]
                if rows:
                    cols = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()), strict=True)], ["doc_id", "item_id", "edits", "start", "end"])

        parts.append(docs.select("doc_id", "text").mapInArrow(match, schema))
    out = parts[0] if parts else spark.createDataFrame([], schema)
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, min_chars: int = MIN_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """docs less the rows that hold some item; nothing is shuffled."""
    at = docs.columns.index("text")
    for block in blocks(benchmark, block_chars):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def clean(batches, sent=sent):
            items = sent.value
            machine = automaton(items, error_rate, min_chars)
            for b in tidy(batches):
                keep = [not (s and scan(s, machine, items, error_rate, min_chars)) for s in b.column(at).to_pylist()]
                yield b.filter(pa.array(keep, pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
