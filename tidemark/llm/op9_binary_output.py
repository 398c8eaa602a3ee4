"""Token ids as length-delimited binary records with masked checksums and a separate offset index.

File format, all integers little-endian:

* data file ``part-NNNNN-<attempt>.rec``: records one after the other,
  ``length u64 | mask(crc32(length bytes)) u32 | payload | mask(crc32(payload)) u32``;
  mask(c) = rotate_right(c, 15) + 0xA282EAD8 modulo 2**32, so a checksum of data that hold
  checksums stays sound.  Payload: ``doc_id i64 | id width u8 (2 or 4; 128 more where doc_id is null) | ids``.
* index file ``part-NNNNN-<attempt>.idx``: one ``doc_id i64 | null id u8 | offset u64 | length u64 |
  n_tokens u64`` a record, for reads in any order without a scan.

Documents are dealt by ranges of doc_id and a hash of the text, sorted within them, in as many ranges as their bytes
ask for; each task encodes and writes one
file; a retried task writes another name and only the names that a task returned are read, so a
lost executor costs nothing but its task.  Files go through ``pyarrow.fs`` to the shared folder.

The library's own encoder sees each distinct chunk (a run of non-space characters with the space
before it) once; the vocabulary's pre-tokenizer never joins two such chunks, so a text's ids are
its chunks' ids in order.  New words of a space and letters go to it many at once, as one text.  Texts that hold an added token's string go to the encoder whole.

Defined cases: a null or empty text is a record of the end id alone; equal doc_ids keep all their
rows; null doc_ids come last; an empty table gives no rows and no files; other columns of the input are ignored.
"""

from __future__ import annotations

import functools
import math
import re
import struct
import uuid
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import documents, fresh, local_uri
from .text import slices, tidy

END = 0
MASK = 0xA282EAD8
HEAD = struct.Struct("<QI")
META = struct.Struct("<qB")
NO_ID = 128
RANGE_BYTES = 256 << 20  # of text in a file, about
READ_BYTES = 4 << 20
WRITE_BYTES = 512 << 10  # of text encoded at once; the chunks of more only cost memory
INDEX = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("offset", "<u8"), ("length", "<u8"), ("n_tokens", "<u8")])
#: Unicode white space, as the vocabulary's pre-tokenizer sees it.
_WS = "\t-\r \x85\xa0  -     　"
_CHUNKS = re.compile(f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]")
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # no apostrophe, which may belong to letters after it
JOINED = 200  # words that are encoded as one text
CACHE = 1_500_000  # chunks a worker remembers; some 200 MB


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + MASK) & 0xFFFFFFFF


@functools.cache
def encoder(path: str):
    """The tokenizer, its added tokens' strings, the id type, the worker's cache of chunks, and by id whether a token begins with a space."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    kind = "<u2" if t.get_vocab_size(True) <= 65536 else "<u4"
    first = np.zeros(max(t.get_vocab(True).values(), default=0) + 1, bool)
    first[[i for x, i in t.get_vocab(True).items() if x.startswith("\u0120")]] = True  # a space, in the byte-level alphabet
    return t, [x.content for x in t.get_added_tokens_decoder().values()], kind, {}, first


def _remember(chunks: list[str], path: str) -> None:
    """Put the ids of chunks, each encoded alone, into the cache."""
    t, _, kind, cache, _ = encoder(path)
    code = "H" if kind == "<u2" else "I"
    for lo in range(0, len(chunks), 20_000):
        lot = chunks[lo : lo + 20_000]
        for c, e in zip(lot, t.encode_batch_fast(lot, add_special_tokens=False), strict=True):
            cache[c] = array(code, e.ids).tobytes()


def _remember_words(words: list[str], path: str) -> None:
    """The same for words of a space and letters, many as one text: their spaces are the only ones, so they tell where each begins."""
    t, _, kind, cache, first = encoder(path)
    native = np.dtype(kind).newbyteorder("=")
    lots = [words[lo : lo + JOINED] for lo in range(0, len(words), JOINED)]
    for lot, e in zip(lots, t.encode_batch_fast(["".join(x) for x in lots], add_special_tokens=False), strict=True):
        ids = np.array(e.ids, native)
        at = np.flatnonzero(first[ids])
        if len(at) != len(lot):
            _remember(lot, path)
            continue
        data, cuts = ids.tobytes(), [*(at * native.itemsize).tolist(), ids.nbytes]
        cache.update(zip(lot, map(data.__getitem__, map(slice, cuts[:-1], cuts[1:])), strict=True))


def encode(texts: list[str], path: str, most: int = CACHE) -> list[np.ndarray]:
    """Ids of each text, without special tokens; the worker forgets its chunks when it has more than ``most``."""
    t, added, kind, cache, _ = encoder(path)
    chunked = [None if any(x in s for x in added) else _CHUNKS.findall(s) for s in texts]
    if len(cache) > most:
        cache.clear()
    # letters and marks after them are never joined: such a chunk is its word's ids and those of the marks
    marked, words, other = [], set(), set()
    for c in set().union(*(x for x in chunked if x)).difference(cache):
        w = c.rstrip(MARKS)
        if not w.lstrip(" ").isalpha():
            other.add(c)
            continue
        (words if w[0] == " " else other).add(w)
        if len(w) < len(c):
            marked.append((c, w, c[len(w) :]))
            other.add(c[len(w) :])
    _remember_words(list(words.difference(cache)), path)
    _remember(list(other.difference(cache)), path)
    for c, w, m in marked:
        cache[c] = cache[w] + cache[m]
    get = cache.__getitem__
    native = np.dtype(kind).newbyteorder("=")
    return [np.array(t.encode(s, add_special_tokens=False).ids, native) if chunks is None else np.frombuffer(b"".join(map(get, chunks)), native) for s, chunks in zip(texts, chunked, strict=True)]


def framed(doc: int | None, ids: np.ndarray) -> bytes:
    width = 2 if ids.max() < 65536 else 4
    payload = META.pack(doc or 0, width | (NO_ID if doc is None else 0)) + ids.astype(f"<u{width}").tobytes()
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload))))


def write_records(docs: DataFrame, tokenizer: str, folder: str, partitions: int | None = None, cache: int = CACHE, forget: bool = False) -> DataFrame:
    """Write doc_id and text of docs to folder; returns one row a file: part, name, docs, tokens (with end ids).

    A worker remembers the chunks it has seen, up to ``cache`` of them, until its file is written (forget) or for all its files.
    """
    spark = docs.sparkSession
    n = partitions
    if n is None:
        size = docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
        n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / RANGE_BYTES))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    dealt = docs.select("doc_id", "text").repartitionByRange(n, *order).sortWithinPartitions(*order)

    def write(batches):
        from pyarrow import fs

        part, name, at, total, index, out = TaskContext.get().partitionId(), "", 0, 0, [], None
        store, root = fs.FileSystem.from_uri(folder)
        for b in slices(tidy(batches), max_bytes=WRITE_BYTES):
            if out is None:
                name = f"part-{part:05d}-{uuid.uuid4().hex}"
                store.create_dir(root, recursive=True)
                out = store.open_output_stream(f"{root}/{name}.rec")
            frames = []
            for doc, e in zip(b.column(0).to_pylist(), encode([x or "" for x in b.column(1).to_pylist()], tokenizer, cache), strict=True):
                v = np.append(e, e.dtype.type(END))
                frame = framed(doc, v)
                frames.append(frame)
                index.append((doc or 0, doc is None, at, len(frame) - 16, len(v)))
                at += len(frame)
                total += len(v)
            out.write(b"".join(frames))
        if out is not None:
            out.close()
            with store.open_output_stream(f"{root}/{name}.idx") as f:
                f.write(np.array(index, INDEX).tobytes())
            if forget:
                encoder(tokenizer)[3].clear()
            yield pa.RecordBatch.from_pylist([{"part": part, "name": name, "docs": len(index), "tokens": total}], pa.schema([("part", pa.int32()), ("name", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64())]))

    return dealt.mapInArrow(write, "part int, name string, docs long, tokens long")


def opened(frame: bytes, offset: int = 0) -> tuple[int | None, np.ndarray]:
    """A record's doc_id and ids, with both checksums verified."""
    length = len(frame) - 16
    if HEAD.unpack_from(frame)[0] != length or struct.unpack_from("<I", frame, 8)[0] != masked(frame[:8]) or struct.unpack_from("<I", frame, 12 + length)[0] != masked(frame[12 : 12 + length]):
        raise ValueError(f"damaged record at {offset}")
    doc, width = META.unpack_from(frame, 12)
    size = width & ~NO_ID
    return None if width & NO_ID else doc, np.frombuffer(frame, f"<u{size}", (length - META.size) // size, 12 + META.size)


def read_record(f, offset: int, length: int) -> tuple[int | None, np.ndarray]:
    """One record at an index entry's place."""
    f.seek(offset)
    return opened(f.read(length + 16), offset)


def read_records(spark: SparkSession, files: list[tuple[str, int]], folder: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) from the files; files: (name, tokens in the files before it)."""
    frame = spark.createDataFrame(files or [], "name string, before long")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids

    def read(batches):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        for b in batches:
            for name, at in zip(*(c.to_pylist() for c in b.columns), strict=True):
                with store.open_input_file(f"{root}/{name}.idx") as f:
                    index = np.frombuffer(f.read(), INDEX)
                with store.open_input_file(f"{root}/{name}.rec") as f:
                    lo = 0
                    while lo < len(index):  # a run of records in one read
                        base = int(index["offset"][lo])
                        hi = max(lo + 1, int(np.searchsorted(index["offset"], base + READ_BYTES)))
                        f.seek(base)
                        data = f.read(int(index["offset"][hi - 1] + index["length"][hi - 1]) + 16 - base)
                        rows = []
                        for x in index[lo:hi]:
                            a = int(x["offset"]) - base
                            doc, ids = opened(data[a : a + int(x["length"]) + 16], int(x["offset"]))
                            row = {"doc_id": doc, "start": at, "n_tokens": len(ids), "ids_crc32": zlib.crc32(ids.astype("<u4").tobytes())}
                            rows.append(row | {"ids": ids.astype(np.int32)} if with_ids else row)
                            at += len(ids)
                        lo = hi
                        cols = {k: pa.array([r[k] for r in rows], pa.list_(pa.int32()) if k == "ids" else pa.int64()) for k in rows[0]}
                        yield pa.RecordBatch.from_pydict(cols)

    return frame.repartition(max(1, len(files)), "name").mapInArrow(read, schema) if files else spark.createDataFrame([], schema)


def tokens_out(docs: DataFrame, tokenizer: str, folder: str | None = None, cache: int = CACHE, forget: bool = False) -> DataFrame:
    """Write docs, then what the files hold: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    folder = folder or fresh(spark, "records")
    folder = folder if "://" in folder else f"file://{local_uri(folder)}"
    files, before = [], 0
    for x in sorted(write_records(docs, tokenizer, folder, cache=cache, forget=forget).collect(), key=lambda x: x["part"]):  # one row a file
        files.append((x["name"], before))
        before += x["tokens"]
    return read_records(spark, files, folder)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op9_binary_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens_out(documents(spark, sf_dir), tokenizer_path())
