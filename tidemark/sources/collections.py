"""Features of GeoJSON documents of any size: one document is read by many tasks.

The text reader cuts files into byte ranges and records at "}", so a range begins behind a brace, at a place whose meaning
only the text before it tells: it may be in a string, and at any depth.  Three passes settle that without any guess:

1. every range reports what it does to a reader that comes in outside a string, and to one that comes in inside: depth gained,
   in a string at the end, and by depth, relative to its start, the objects and the arrays that it opens;
2. the reports of a file, a row a range, are chained in order: each range's true start (``Start``) and its features' places;
3. every range is read again from its true start and gives its features.  Those that cross a border come in parts, one a
   range, and are the only rows that are shuffled.

Rows of pass 2 are bytes / ``spark.sql.files.maxPartitionBytes`` in number; the starts are broadcast, at most ``MOST_RANGES``.
Compressed documents cannot be cut and are one range each, but those in blocks: gzip of many members, as any reader of gzip reads it, each of
which tells its size in its header, so that it can be found and read alone.  A block is a range; it ends between two tokens.
"""

from __future__ import annotations

import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import kept

#: Ranges behind the first of their file, 32 bytes each; more want a larger maxPartitionBytes.
MOST_RANGES = 1 << 20
BLOCK = 4 << 20
STEP = np.zeros(256, np.int8)
STEP[[ord("{"), ord("[")]] = 1
STEP[[ord("}"), ord("]")]] = -1
BRACE = STEP != 0
#: Features are objects at this depth, in an array that is the value of the document's key of this name.
DEPTH, KEY = 2, b'"features"'
#: A gzip member's header with one extra field, TM: bytes of the member.  PLAIN is one without fields, as Hadoop writes it.
HEADER = struct.Struct("<4s6sH2sHQ")
MAGIC, PLAIN = b"\x1f\x8b\x08\x04", b"\x1f\x8b\x08\x00"
#: Tasks that blocks are dealt over, at most.
MOST_TASKS = 10_000


def header(size: int) -> bytes:
    return HEADER.pack(MAGIC, bytes(6), 12, b"TM", 8, size)


def block(text: bytes) -> bytes:
    """A text as a block."""
    z = zlib.compressobj(wbits=-15)
    body = z.compress(text) + z.flush() + struct.pack("<II", zlib.crc32(text), len(text) & 0xFFFFFFFF)
    return header(HEADER.size + len(body)) + body


def copy_block(stream, size: int, out) -> None:
    """A gzip file of one plain member and so many bytes, copied as a block."""
    if stream.read(10)[:4] != PLAIN:
        raise ValueError("not a plain gzip file")
    out.write(header(size - 10 + HEADER.size))
    while chunk := stream.read(BLOCK):
        out.write(chunk)


class Start(NamedTuple):
    """What holds where a range begins."""

    text: bool = False  # within a string
    depth: int = 0
    listed: bool = False  # the last array opened in the document itself is that of the features
    place: int = 0  # features before
    begun: int = -1  # start of the range in which the open feature began


class Marks(NamedTuple):
    """Braces and brackets outside strings: places, characters and depth before each."""

    at: np.ndarray
    char: np.ndarray
    depth: np.ndarray
    text: bool  # whether the block ends within a string
    end: int


class Places(NamedTuple):
    """Braces and brackets, in strings or not: places, characters and the parity of the quotes before each; and that of all quotes."""

    at: np.ndarray
    char: np.ndarray
    odd: np.ndarray
    last: int


def places(b: np.ndarray) -> Places:
    quote = b == ord('"')
    back = np.flatnonzero(b == ord("\\"))
    if len(back):  # what follows an odd run of backslashes is escaped
        first = np.flatnonzero(np.diff(back, prepend=-2) > 1)
        length = np.diff(np.append(first, len(back)))
        after = (back[first] + length)[length % 2 == 1]
        quote[after[after < len(b)]] = False
    odd = np.cumsum(quote, dtype=np.uint8)  # parity outlives the overflow
    at = np.flatnonzero(BRACE[b])
    return Places(at, b[at], odd[at] & 1, int(odd[-1]) & 1 if len(b) else 0)


def marks(b: np.ndarray, text: bool, depth: int, found: Places | None = None) -> Marks:
    """found: ``places`` of b, which hold for both ways in."""
    at, char, odd, last = found or places(b)
    out = odd == text
    at, char = at[out], char[out]
    step = STEP[char]
    moved = np.cumsum(step, dtype=np.int64)
    return Marks(at, char, depth + moved - step, bool(last) != text, depth + int(moved[-1]) if len(at) else depth)


def of_features(b: np.ndarray, at: int) -> bool:
    """Whether the array opened at a place is the value of the key of features."""
    before = b[max(0, at - 256) : at].tobytes().rstrip()
    return before.endswith(b":") and before[:-1].rstrip().endswith(KEY)


def listed(b: np.ndarray, m: Marks, depth: int, known: bool | None) -> tuple[np.ndarray, np.ndarray, bool | None]:
    """Objects opened at a depth: their marks' index, 1 if in the array of features, 0 if not, -1 if ``known`` is None and tells; and what holds after."""
    objects = np.flatnonzero((m.char == ord("{")) & (m.depth == depth))
    arrays = np.flatnonzero((m.char == ord("[")) & (m.depth == depth - 1))
    last = np.searchsorted(arrays, objects) - 1
    seen = {int(i): of_features(b, int(m.at[arrays[i]])) for i in np.unique(last[last >= 0])}
    start = -1 if known is None else int(known)
    flag = np.array([seen[i] if i >= 0 else start for i in last.tolist()], np.int8)
    return objects, flag, of_features(b, int(m.at[arrays[-1]])) if len(arrays) else known


def blocks(batches):
    """(file, start of the range, bytes) in order, some MB at once; the reader took the braces away."""
    key, held, size = None, [], 0
    for b in batches:
        for file, at, piece in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if key != (file, at) or size > BLOCK:
                if held:
                    yield *key, np.frombuffer(b"".join(held), np.uint8)
                key, held, size = (file, at), [], 0
            held += [piece, b"}"]
            size += len(piece) + 1
    if held:
        yield *key, np.frombuffer(b"".join(held), np.uint8)


def _members(batches):
    """(file, at, size) of all blocks of each file; a header leads to the next."""
    from pyarrow import fs

    for b in batches:
        rows = []
        for file, length in zip(*(c.to_pylist() for c in b.columns), strict=True):
            system, path = fs.FileSystem.from_uri(file)
            at = 0
            with system.open_input_file(path) as f:
                while at < length:
                    f.seek(at)
                    h = f.read(HEADER.size)
                    magic, _, *field, size = HEADER.unpack(h) if len(h) == HEADER.size else (b"", b"", 0)
                    if magic != MAGIC or field != [12, b"TM", 8] or not HEADER.size < size <= length - at:
                        raise ValueError(f"{file} is not in blocks")
                    rows.append((file, at, size))
                    at += size
        cols = list(zip(*rows, strict=True)) or [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.int64(), pa.int64()), strict=True)], ["file", "at", "size"])


def inflated(batches):
    """``blocks`` of (file, at, size) of blocks; some MB at once, which end behind a brace."""
    from pyarrow import fs

    for b in batches:
        for file, at, left in zip(*(c.to_pylist() for c in b.columns), strict=True):
            system, path = fs.FileSystem.from_uri(file)
            z, held = zlib.decompressobj(31), b""
            with system.open_input_file(path) as f:
                f.seek(at)
                while left:
                    data = f.read(min(left, BLOCK >> 3))
                    left -= len(data)
                    if not data:
                        break
                    more = True
                    while more:
                        got = z.decompress(data, BLOCK)
                        data = z.unconsumed_tail
                        more = data or len(got) == BLOCK
                        held += got
                        if len(held) >= BLOCK and (cut := held.rfind(b"}") + 1):
                            yield file, at, np.frombuffer(held[:cut], np.uint8)
                            held = held[cut:]
            if left or not z.eof:
                raise ValueError(f"{file} is cut off")
            if held:
                yield file, at, np.frombuffer(held, np.uint8)


def _reported(pieces: Iterator):
    """Pass 1, of ``blocks``: a row for each range, way in and relative depth."""
    ranges: dict = {}
    for file, at, b in pieces:
        ways = ranges.setdefault((file, at), [{"text": bool(w), "depth": 0, "sure": defaultdict(int), "open": defaultdict(int), "last": {}} for w in (0, 1)])
        found = places(b)
        for way in ways:
            m = marks(b, way["text"], way["depth"], found)
            deep = np.unique(m.depth[m.char == ord("{")]).tolist()
            for depth in deep:
                _, flag, way["last"][depth - 1] = listed(b, m, depth, way["last"].get(depth - 1))
                way["sure"][depth] += int((flag == 1).sum())
                way["open"][depth] += int((flag == -1).sum())
            for depth in np.unique(m.depth[m.char == ord("[")]).tolist():
                if depth + 1 not in deep:
                    arrays = m.at[(m.char == ord("[")) & (m.depth == depth)]
                    way["last"][depth] = of_features(b, int(arrays[-1]))
            way["text"], way["depth"] = m.text, m.end
    rows = []
    for (file, at), ways in ranges.items():
        for w, way in enumerate(ways):
            for depth in {*way["sure"], *way["last"], 0}:
                rows.append((file, at, bool(w), way["text"], way["depth"], depth, way["sure"].get(depth, 0), way["open"].get(depth, 0), way["last"].get(depth)))
    cols = list(zip(*rows, strict=True)) or [[]] * 9
    kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["file", "at", "way", "text", "gained", "depth", "sure", "open", "last"])


def chain(reports: list[dict]) -> list[tuple[int, Start]]:
    """Pass 2, for one file: the true start of each range."""
    ways: dict = defaultdict(dict)
    for r in reports:
        ways[r["at"], r["way"]][r["depth"]] = r
    out, now = [], Start()
    for at in sorted({r["at"] for r in reports}):
        out.append((at, now))
        way = ways[at, now.text]
        here, array = way.get(DEPTH - now.depth), way.get(DEPTH - 1 - now.depth)
        n = here["sure"] + here["open"] * now.listed if here else 0
        on = array["last"] if array and array["last"] is not None else now.listed
        any_ = next(iter(way.values()))
        depth = now.depth + any_["gained"]
        begun = -1 if depth <= DEPTH or not on else at if n else now.begun
        now = Start(any_["text"], depth, on, now.place + n, begun)
    return out


def _chained(t: pa.Table) -> pa.Table:
    out = chain(t.to_pylist())
    cols = [[at for at, _ in out], *([s[i] for _, s in out] for i in range(5))]
    return pa.Table.from_arrays([pa.array([t.column("file")[0].as_py()] * len(out)), *map(pa.array, cols)], ["file", "at", *Start._fields])


def _read(starts, cut):
    """Pass 3: features, or parts of those that cross a border of ranges; cut: ``blocks`` or ``inflated``."""

    def run(batches):
        key, now, index, held, out = None, Start(), 0, None, []
        size = 0

        def done():
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()), strict=True)], ["file", "begun", "place", "at", "whole", "text"])

        def closing():
            # what is open at a range's end goes on in the next
            if held is not None:
                text, place, begun = b"".join(held[0]), held[1], held[2]
                out.append((key[0], begun, place, key[1], False, text))

        for file, at, b in cut(batches):
            if key != (file, at):
                closing()
                key, now, index = (file, at), starts.value.get((file, at), Start()), 0
                text, depth, known = now.text, now.depth, now.listed
                held = ([], now.place - 1, now.begun) if now.begun >= 0 else None
            m = marks(b, text, depth)
            objects, flag, known = listed(b, m, DEPTH, known)
            begins = m.at[objects[flag == 1]]
            ends = m.at[(m.char == ord("}")) & (m.depth == DEPTH + 1)] + 1
            from_ = 0
            if held is not None:
                stop = int(ends[0]) if len(ends) else len(b)
                held[0].append(b[:stop].tobytes())
                if len(ends):
                    out.append((file, held[2], held[1], at, held[2] == at, b"".join(held[0])))
                    held = None
                from_ = stop
            begins, all_ = begins[begins >= from_], b.tobytes()
            after = np.searchsorted(ends, begins, side="right")
            stops = np.append(ends, 0)[after]  # 0: it goes on
            for start, stop in zip(begins.tolist(), stops.tolist(), strict=True):
                place = now.place + index
                index += 1
                if not stop:
                    held = ([all_[start:]], place, at)
                    break
                out.append((file, at, place, at, True, all_[start:stop]))
                size += len(out[-1][-1])
                if size > BLOCK:
                    yield done()
                    out, size = [], 0
            text, depth = m.text, m.end
        if key is not None:
            closing()
        if out:
            yield done()

    return run


def feature_texts(spark: SparkSession, path: str | list[str], blocked: bool = False) -> DataFrame:
    """(file, place, text) of every object in the ``features`` of each document; place counts from 0 in its document.

    blocked: the documents are in blocks, in a store that Arrow opens by their URI.
    """
    if blocked:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(F.regexp_replace("path", "^file:/+", "file:///").alias("file"), "length")
        found = kept(files.mapInArrow(_members, "file string, at long, size long"), "members")
        pieces, cut = found.repartition(min(max(1, found.count()), MOST_TASKS)), inflated
    else:
        text = spark.read.option("lineSep", "}").option("recursiveFileLookup", True).text(path)
        pieces, cut = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.col("value").cast("binary").alias("piece")), blocks
    reports = pieces.mapInArrow(lambda batches: _reported(cut(batches)), "file string, at long, way boolean, text boolean, gained long, depth long, sure long, open long, last boolean")
    starts = reports.groupBy("file").applyInArrow(_chained, "file string, at long, text boolean, depth long, listed boolean, place long, begun long").where("at > 0")
    got = starts.limit(MOST_RANGES + 1).toArrow()
    if got.num_rows > MOST_RANGES:
        raise ValueError(f"more than {MOST_RANGES} ranges: raise spark.sql.files.maxPartitionBytes")
    sent = spark.sparkContext.broadcast({(r["file"], r["at"]): Start(*(r[f] for f in Start._fields)) for r in got.to_pylist()})
    found = pieces.mapInArrow(_read(sent, cut), "file string, begun long, place long, at long, whole boolean, text binary")
    whole = found.where("whole").select("file", "place", F.col("text").cast("string").alias("text"))
    if all(s.begun < 0 for s in sent.value.values()):
        return whole  # no feature crosses a border
    parts = found.where("not whole").groupBy("file", "place").agg(F.array_sort(F.collect_list(F.struct("at", "text"))).alias("p"))
    joined = F.array_join(F.transform("p", lambda x: x["text"].cast("string")), "")
    return whole.unionByName(parts.select("file", "place", joined.alias("text")))
