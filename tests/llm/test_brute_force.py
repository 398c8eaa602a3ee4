"""The numbered queries against plain brute force on the smallest tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from tidemark.llm import op2_fm_dedup as o2
from tidemark.llm import op3_suffix_dedup as o3
from tidemark.llm import op10_decontamination as o10
from tidemark.llm.anchors import keyed, repeated_ranges
from tidemark.llm.op1_source_mixing import min_cost_flow, op1_source_mixing, share_out
from tidemark.llm.op4_url_filter import OP4_SQL, op4_url_filter
from tidemark.llm.op5_learned_partitions import op5_learned_partitions
from tidemark.llm.op6_language_id import op6_language_id
from tidemark.llm.op7_lm_scoring import op7_lm_scoring
from tidemark.llm.op8_jaccard_join import op8_jaccard_join
from tidemark.llm.op9_binary_output import op9_binary_output, read_records, tokenizer_path, write_records

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def crc(i):
    return zlib.crc32(str(i).encode())


def removed_windows(texts, length, earlier):
    """{id: mask} of symbols in windows that occur elsewhere (or earlier)."""
    where = defaultdict(list)
    for i in sorted(texts):
        for p in range(len(texts[i]) - length + 1):
            where[tuple(texts[i][p : p + length])].append((i, p))
    gone = {i: np.zeros(len(t), bool) for i, t in texts.items()}
    for at in where.values():
        for i, p in at[1:] if earlier else at if len(at) > 1 else []:
            gone[i][p : p + length] = True
    return gone


@pytest.mark.parametrize("hot", [4096, 1])
def test_words(spark, docs, hot):
    texts = {i: re.findall(rb"[^\x20\x09-\x0D]+", (r["text"] or "").encode()) for i, r in docs.items()}
    gone = removed_windows(texts, 20, True)
    want = {i: (len(w), int(gone[i].sum()), hashlib.sha256(b" ".join(x for x, g in zip(w, gone[i], strict=True) if not g)).hexdigest()) for i, w in texts.items()}
    got = o2.dedup_words(spark.read.parquet(f"{SF}/documents.parquet"), o2.SPEC._replace(hot=hot))
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got.collect()} == want


@pytest.mark.parametrize("hot", [4096, 1])
def test_bytes(spark, docs, hot):
    few = {i: (r["text"] or "").encode() for i, r in docs.items()}
    seen = Counter(hashlib.blake2b(t[p : p + 400], digest_size=12).digest() for t in few.values() for p in range(len(t) - 399))
    want = {}
    for i, t in few.items():
        mask = np.zeros(len(t), bool)
        for p in range(len(t) - 399):
            if seen[hashlib.blake2b(t[p : p + 400], digest_size=12).digest()] > 1:
                mask[p : p + 400] = True
        x = np.frombuffer(t, np.uint8)
        want[i] = (len(t), int(mask.sum()), int((np.diff(np.concatenate(([0], mask.astype(np.int8)))) == 1).sum()), hashlib.sha256(x[~mask].tobytes()).hexdigest())
    got = o3.dedup_bytes(spark.read.parquet(f"{SF}/documents.parquet"), o3.SPEC._replace(hot=hot))
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got.collect()} == want


@pytest.mark.parametrize("module", [o2, o3])
def test_nothing_is_marked_past_the_index(spark, module):
    """An index that finds nothing leaves every document as it is."""
    blind = module.SPEC._replace(match=lambda segs, windows, order: np.full(int(windows.sum()), -1))
    docs = keyed(spark.read.parquet(f"{SF}/documents.parquet"))
    assert repeated_ranges(docs, module.SPEC).count() > 0
    assert repeated_ranges(docs, blind).count() == 0


def variants(seed=5):
    """Texts with copies, copies with one word changed, periodic texts, a long one, and rows equal in id and text."""
    rng = np.random.default_rng(seed)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 5000, n)]
    base = [word(400) for _ in range(3)]
    rows = []
    for i in range(24):
        w = list(base[i % 3])
        if i % 4:
            w[int(rng.integers(0, 400))] = f"x{i}"
        rows.append((i, " ".join(w[: 60 + 40 * (i % 9)])))
    rows += [(100, " ".join(["aa", "bb", "cc"] * 120)), (101, " ".join(word(30) * 6)), (102, " ".join(base[0] + base[1] + word(50) + base[0]))]
    return rows + [rows[3], rows[3], rows[24], (104, None), (105, "")]


@pytest.mark.parametrize("run", [1 << 16, 150])
@pytest.mark.parametrize("hot", [4096, 1])
def test_words_of_variants(spark, hot, run):
    rows = variants()
    texts = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in rows}
    gone = removed_windows(texts, 20, True)
    got = o2.dedup_words(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), o2.SPEC._replace(hot=hot, run=run)).collect()
    assert sorted((r["doc_id"], r["n_removed"]) for r in got) == sorted((i, int(gone[i].sum())) for i, _ in rows)


@pytest.mark.parametrize("run", [1 << 16, 500])
@pytest.mark.parametrize("hot", [4096, 1])
def test_bytes_of_variants(spark, hot, run):
    """Rows equal in id and text repeat each other."""
    rows = variants()
    gone = removed_windows({n: (t or "").encode() for n, (_, t) in enumerate(rows)}, 400, False)
    got = o3.dedup_bytes(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), o3.SPEC._replace(hot=hot, run=run)).collect()
    assert sorted((r["doc_id"], r["n_removed"]) for r in got) == sorted((i, int(gone[n].sum())) for n, (i, _) in enumerate(rows))


def test_suffix_arrays_and_index():
    rng = np.random.default_rng(1)
    for n, k in ((1, 2), (50, 2), (3000, 3), (2000, 300)):
        text = rng.integers(1, k + 1, n)
        sa, _ = o3.suffix_array(text, n + 1)
        t = text.tolist()
        assert sa.tolist() == sorted(range(n), key=lambda i: t[i:])
        index = o2.FMIndex(np.append(text, 0), 20)  # 0 ends every segment
        for m in (1, 2, 5):
            if n >= m:
                p = text[rng.integers(0, n - m + 1) :][:m]
                lo, hi = np.zeros(1, np.int64), np.full(1, n + 1)
                for c in p[::-1]:
                    lo, hi = index.step(lo, hi, np.array([c]))
                assert hi[0] - lo[0] == sum(t[i : i + m] == p.tolist() for i in range(n))


def test_near_duplicates(spark, docs):
    sets, parent = {}, {i: i for i in docs}
    for i, r in docs.items():
        w = WORD.findall((r["text"] or "").translate(LOWER))
        sets[i] = {tuple(w[p : p + 5]) for p in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in docs:
        for b in docs:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    got = op8_jaccard_join(spark, SF).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {i: (len(sets[i]), find(i)) for i in docs}


def test_language_accuracy(spark, docs):
    rows = [r for r in op6_language_id(spark, SF).collect()]
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(docs) and all(r["held_out"] == (crc(r["doc_id"]) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    assert np.mean([r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held]) >= 0.95


def test_language_model(spark, docs):
    tokens = {i: [*WORD.findall((r["text"] or "").translate(LOWER)), None] for i, r in docs.items()}
    c = Counter(t for i, ts in tokens.items() if crc(i) % 7 != 2 for t in ts)
    total, distinct = sum(c.values()), len(c)
    rows = op7_lm_scoring(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ts = tokens[r["doc_id"]]
        base = sum(math.log10((c[t] + 1) / (total + distinct + 1)) for t in ts)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (len(ts), sum(c[t] > 0 for t in ts), total, crc(r["doc_id"]) % 7 == 2)
        assert abs(r["base_score"] - base) <= 1e-6 * abs(base)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_tokens_round_trip(spark, docs, tmp_path):
    from tokenizers import Tokenizer

    t, start = Tokenizer.from_file(tokenizer_path()), 0
    want, ids = {}, {}
    for i in sorted(docs):
        ids[i] = [*t.encode(docs[i]["text"] or "", add_special_tokens=False).ids, 0]
        want[i] = (start, len(ids[i]), zlib.crc32(np.array(ids[i], "<u4").tobytes()))
        start += len(ids[i])
    got = op9_binary_output(spark, SF).collect()
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in got} == want
    files = write_records(spark.read.parquet(f"{SF}/documents.parquet"), tokenizer_path(), f"file://{tmp_path}/x", 3).collect()
    back = read_records(spark, [(f["name"], 0) for f in files], f"file://{tmp_path}/x", with_ids=True)
    assert {r["doc_id"]: r["ids"] for r in back.collect()} == ids
    victim = next(p for p in (tmp_path / "x").iterdir() if p.suffix == ".rec")
    data = bytearray(victim.read_bytes())
    data[40] ^= 1
    victim.write_bytes(bytes(data))
    with pytest.raises(Exception, match="damaged record"):
        read_records(spark, [(victim.stem, 0)], f"file://{tmp_path}/x").collect()


def test_chunks_encode_as_whole_texts():
    from tokenizers import Tokenizer

    from tidemark.llm.op9_binary_output import encode

    t = Tokenizer.from_file(tokenizer_path())
    odd = ["", "a  b", "a \n b", "\n\n x", "x \t\ty  ", "don't  I'll '", "\x1c a\x1f b", "é  b　c", "  lead", "trail   ", "a<|endoftext|> b", " ​ x", "日本 語  テ", "\x85 z", "'s 's", "a᠎b", " \r\n a"]
    assert [e.tolist() for e in encode(odd, tokenizer_path())] == [t.encode(s, add_special_tokens=False).ids for s in odd]


def test_urls_against_sql(spark):
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{SF}/pages.parquet'")
    rel = con.sql(OP4_SQL)
    want = sorted((tuple(dict(zip(rel.columns, r, strict=True))[c] for c in ("page_id", "host", "path", "rule", "verdict")) for r in rel.fetchall()), key=repr)
    assert sorted((tuple(r) for r in op4_url_filter(spark, SF).collect()), key=repr) == want


def test_vectors_recall(spark):
    x = {r["vec_id"]: np.array(r["embedding"], float) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    ids, m = np.array(list(x)), np.array(list(x.values()))
    found = defaultdict(dict)
    for r in op5_learned_partitions(spark, SF).collect():
        found[r["query_id"]][r["vec_id"]] = r["score"]
    hits = []
    for q in ids[ids % 20 == 0]:
        s = m @ x[q]
        s[ids == q] = -np.inf
        hits.append(len(set(ids[np.argsort(-s)[:20]]) & set(found[q])) / 20)
        assert all(abs(v - x[q] @ x[i]) < 1e-12 for i, v in found[q].items())
    assert np.mean(hits) >= 0.9


def test_mix(spark, docs):
    got = op1_source_mixing(spark, SF).collect()
    assert sorted(got) == sorted(op1_source_mixing(spark, SF).collect())
    size = {i: len(WORD.findall(r["text"] or "")) for i, r in docs.items()}
    by, taken, target = Counter(), Counter(), {}
    for r in got:
        s = docs[r["doc_id"]]["source"]
        assert r["size"] == size[r["doc_id"]] and r["taken"] <= 3 * r["size"]
        by[s] += r["size"]
        taken[s] += r["taken"]
        target[s] = r["target"]
    assert abs(sum(target.values()) - sum(size.values())) < 1
    assert all(abs(taken[s] - target[s]) <= max(0.03 * target[s], 60) for s in target) and all(target[s] <= 3 * by[s] + 1e-6 for s in target)


def test_flow_and_shares():
    assert share_out({"a": 10, "b": 100, "c": 100}, {"a": 1, "b": 1, "c": 1}, 210) == {"a": 30.0, "b": 90.0, "c": 90.0}
    patterns = [(["a"], 10), (["a", "b"], 20), (["b"], 5)]
    flows = min_cost_flow(patterns, {"a": 25, "b": 20})
    assert sum(f.get("a", 0) for f in flows) == 25 and sum(f.get("b", 0) for f in flows) == 20
    used = [sum(f.values()) for f in flows]
    assert all(u <= 3 * n for u, (_, n) in zip(used, patterns, strict=True)) and used[2] >= 5


def test_edit_distance():
    rng = np.random.default_rng(2)

    def plain(p, t):
        row = [0] * (len(t) + 1)
        for i, c in enumerate(p):
            new = [i + 1]
            for j, d in enumerate(t):
                new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
            row = new
        return min(row)

    for _ in range(200):
        p, t = ("".join(rng.choice(list("abc"), rng.integers(1, 80))) for _ in range(2))
        assert o10.myers(p, t, len(p))[0] == plain(p, t)
    item = "the quick brown fox jumps over the lazy dog and then some more words follow here"
    edited = "xx " + item.replace("jumps", "jumpz").replace("lazy ", "lazi ") + " yy"
    m = o10.automaton([(7, item)], 0.08)
    assert [h[:2] for h in o10.scan(edited, m, [(7, item)], 0.08)] == [(7, 2)]
    assert o10.scan(item[:40] + " other " * 9, m, [(7, item)], 0.08) == []


def test_pipeline(spark, docs):
    out = corpus_pipeline.run(spark, SF).collect()
    kept = {r["doc_id"] for r in out}
    near = {r["doc_id"]: r["component_id"] for r in op8_jaccard_join(spark, SF).collect()}
    leaks = {r["doc_id"] for r in o10.find_leaks(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert kept and kept <= {i for i in docs if near[i] == i and i not in leaks}
    at = 0
    for r in sorted(out, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
