"""Fill-in-middle, spelling variants and near vectors against plain computations, and on small cases."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import op11_fill_in_middle as o11
from tidemark.llm import op12_spelling_variants as o12
from tidemark.llm import op13_cover_tree_dedup as o13

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASHING = ("n", "h", "word", "form", "output", "id", "v", "w", "block", "lane", "a", "b", "links", "comp", "rep")


def clashing(df):
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHING) if c not in df.columns])


def rearranged(doc_id, text, rate=100, spm=50, seed=7):
    """n, form, output by plain lists of lines."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in o11.Marks()) or h3 % 100 >= rate:
        return len(units), "plain", text, None, None
    if h4 % 100 < spm:
        return len(units), "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m)
    return len(units), "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m)


TEXTS = ["a\nb\nc\n", "\n", "\n\n\n", "no end", "x\r\ny\x0b\x85z w", "<<P", "<", "has <S> mark\nin it", "é\n😀 four bytes\n", "$1 \\2 $0\n\\", "ends\n\n", None, "", " ", "q\n" * 60_000, "w" * 300_000]


def test_middle_small_cases(spark):
    rows = [(i * 100 + k, t) for i in range(7) for k, t in enumerate(TEXTS)] + [(None, "null\nid\n"), (5, "a\nb"), (5, "a\nb")]
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    for rate, spm in ((100, 50), (40, 0), (0, 50)):
        done = o11.fill_in_middle(docs, rate=rate, spm=spm)
        got = done.select("doc_id", "text", "n", "form", "output", *o11.parts(), o11.restored()).collect()
        assert Counter((r[0], *r[2:7]) for r in got) == Counter((i, *rearranged(i, t, rate, spm)) for i, t in rows)
        assert all(r[7] == r[1] for r in got)
    assert o11.fill_in_middle(docs.limit(0)).count() == 0


def test_middle_of_other_units(spark):
    docs = spark.createDataFrame([(i, "ab cd ef gh") for i in range(20)] + [(99, "  ")], "doc_id long, text string")
    marks = o11.Marks("[p$", "(s)", "{m\\")
    done = o11.fill_in_middle(docs, unit=r"\w+ ?", marks=marks).withColumn("back", o11.restored(marks))
    got = done.collect()
    assert all(r["back"] == r["text"] for r in got) and {r["n"] for r in got if r["doc_id"] < 99} == {4}
    assert {r["form"] for r in got} == {"psm", "spm"}


def test_middle_query(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.execute(o11.OP11_SQL).fetchall()
    names = [d[0] for d in con.description]
    got = o11.op11_fill_in_middle(spark, SF).select(names).collect()
    assert Counter(map(tuple, got)) == Counter(want) and len(want) == 200
    plan = o11.op11_fill_in_middle(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def variants_of(rows, least=7, twice=2):
    count = Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= least:
                count[w] += 1
    count = {w: n for w, n in count.items() if n >= twice}
    near, holes = defaultdict(set), defaultdict(set)
    for w in count:
        for p in range(len(w)):
            holes[w[:p], w[p + 1 :]].add(w)
            short = w[:p] + w[p + 1 :]
            if short in count:
                near[w].add(short)
                near[short].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w, n in count.items():
        best = min(near[w], key=lambda v: (-count[v], v), default=None)
        form[w] = best if best and count[best] >= 10 * n else None
    out = set()
    for w in count:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, count[w], len(near[w]), count.get(form[w])))
    return out


def found(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("shape", [o12.Shape(), o12.Shape(sample=150, block=8, lane=10, leaf=3)])
def test_variants(spark, shape):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = variants_of((r["doc_id"], r["text"]) for r in docs.collect())
    assert found(o12.variants(docs, shape)) == want and len(want) > 1000


def test_variants_small_cases(spark):
    words = ["straße", "straßen", "straẞen", "ÉCOLIERS", "écoliers", "ecoliers", "colours", "COLOURS", "colors", "colourss", "cloours", "aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "÷×÷×÷×÷", "÷×÷×÷××"]
    rows = [(i, " ".join(words[k % len(words)] for k in range(i, i + 40))) for i in range(60)]
    rows += [(1000 + i, "international " * 40 + "internationl") for i in range(30)] + [(2000, "internationll " * 3 + "internatonl " * 2 + "x" * 200_000 + " y" * 50_000)]
    # equal counts of letters: boxes cannot tell them apart, and one third of the words are such
    letters = "abcdefg"
    rows += [(3000 + i, " ".join("".join(np.roll(list(letters), i % 7)) + letters[i % 7] for _ in range(2))) for i in range(50)]
    rows += [(7, None), (8, ""), (9, "9 \n 9"), (None, "nullidword nullidword"), (5, "repeated row"), (5, "repeated row")]
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    want = variants_of(rows)
    for shape in (o12.Shape(), o12.Shape(sample=6, block=2, lane=2, leaf=1)):
        assert found(o12.variants(docs, shape)) == want
    assert any(r[1] and r[2] != r[1] for r in want) or any(r[1] for r in want)
    assert o12.variants(docs.limit(0)).count() == 0


def test_chains_of_forms(spark):
    """A word's root is many forms away."""
    chain = ["abcdefg" + "h" * i for i in range(5)]
    rows = [(i, " ".join([w] * 2 * 10**k)) for k, w in enumerate(chain[:4]) for i in (k,)] + [(9, " ".join([chain[4]] * 25_000))]
    shape = o12.Shape(spoilt=10**9)
    got = {r["word"]: (r["form"], r["root"], r["n"]) for r in o12.variants(spark.createDataFrame(rows, "doc_id long, text string"), shape).collect()}
    assert got[chain[0]] == (chain[1], chain[4], 2) and got[chain[3]] == (chain[4], chain[4], 2000) and got[chain[4]][0] is None


def test_near_in_block():
    rng = np.random.default_rng(5)
    words = sorted({"".join(rng.choice(list("abé"), 8)) for _ in range(1500)})
    short = sorted({"".join(rng.choice(list("abé"), 7)) for _ in range(700)})
    spell = lambda w: o12.of_length(*o12.spell(pa.array(w)), np.arange(len(w)), len(w[0]))
    i, j = o12.near_in_block(spell(words), spell(short), 16)
    want = {(a, b) for a, s in enumerate(short) for b, w in enumerate(words) if any(w[:p] + w[p + 1 :] == s for p in range(8))}
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == want and len(want) == len(i)
    i, j = o12.near_in_block(spell(words), spell(words), 16)
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == {(a, b) for a, s in enumerate(words) for b, w in enumerate(words) if sum(x != y for x, y in zip(s, w, strict=True)) == 1}


def near_vectors_of(rows, cosine=0.9):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    dim = Counter(len(v) for _, v in good).most_common(1)[0][0] if good else 0
    good = [(i, v / np.linalg.norm(v / np.abs(v).max()) / np.abs(v).max()) for i, v in good if len(v) == dim]
    x = np.array([v for _, v in good])
    cos = x @ x.T >= cosine
    root = np.arange(len(x))
    for _ in range(len(x)):
        low = np.array([root[c].min() for c in cos])
        if (low == root).all():
            break
        root = low
    low = {r: min(good[k][0] for k in np.flatnonzero(root == r)) for r in set(root.tolist())}
    out = Counter((i, int(c.sum()) - 1, low[r], i == low[r]) for (i, _), c, r in zip(good, cos, root.tolist(), strict=True))
    rest = Counter(i for i, _ in rows) - Counter(i for i, _ in good)
    return out + Counter({(i, 0, i, True): n for i, n in rest.items()})


def vectors(seed=3, dim=12):
    rng = np.random.default_rng(seed)
    x = list(rng.normal(size=(300, dim)))
    for spread, n in ((0.05, 400), (0.1, 60), (0.25, 60), (1e-9, 40)):  # a hot group, looser ones, one nearly equal
        c = rng.normal(size=dim)
        x += [c + spread * rng.normal(size=dim) for _ in range(n)]
    walk = rng.normal(size=dim)
    for _ in range(40):  # a chain: neighbours link, ends do not
        walk = walk + 0.3 * rng.normal(size=dim)
        x.append(walk)
    x += [x[5]] * 100 + [x[6] * 1e200, x[7] * 1e-200]  # copies, and the same direction
    return [v.tolist() for v in x]


ODD = [(9001, None), (9002, [0.0] * 12), (9003, [None] + [1.0] * 11), (9004, [float("nan")] + [1.0] * 11), (9005, [float("inf")] * 12), (9006, [1.0, 2.0]), (9007, [])]


@pytest.mark.parametrize("shape", [o13.Shape(), o13.Shape(sample=200, block=40, lane=2, leaf=4, probe=16), o13.Shape(cells=3, block=100, leaf=2)])
def test_near_vectors(spark, shape):
    rows = [(int(i), v) for i, v in zip(np.random.default_rng(1).permutation(2000), vectors(), strict=False)] + ODD
    rows += [(rows[3][0], rows[4][1]), (rows[3][0], rows[3][1]), (None, rows[0][1])]  # repeated ids, a null one
    got = o13.near_vectors(clashing(spark.createDataFrame(rows, "vec_id long, embedding array<double>")), shape=shape)
    assert Counter((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got.collect()) == near_vectors_of(rows)
    assert o13.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>"), shape=shape).count() == 0
    assert [tuple(r) for r in o13.near_vectors(spark.createDataFrame(ODD[:2], "vec_id long, embedding array<double>")).orderBy("vec_id").collect()] == [(9001, 0, 9001, True), (9002, 0, 9002, True)]


def test_trees_prune_and_cover():
    x = o13.unit(np.array(vectors(seed=8)))
    shape = o13.Shape(leaf=8, probe=64)
    root = o13.tree(x, np.arange(len(x)), x[0], 2.0, shape)
    todo, leaves = [root], []
    while todo:
        n = todo.pop()
        assert o13.distances(x[n.rows], n.centre).max() <= n.reach + 1e-12
        if n.below:
            assert sorted(np.concatenate([c.rows for c in n.below]).tolist()) == sorted(n.rows.tolist())
        else:
            leaves.append(len(n.rows))
        todo += n.below
    assert len(leaves) > 5
    links = o13.Links(np.ones(len(x), np.int64))
    seen = []
    compare, o13.compare = o13.compare, lambda x, a, b, c, k: (seen.append(len(a) * (len(a) - 1) // 2 if b is None else len(a) * len(b)), compare(x, a, b, c, k))
    try:
        o13.traverse(x, root, None, 0.9, links)
    finally:
        o13.compare = compare
    assert (links.count == (x @ x.T >= 0.9).sum(axis=1) - 1).all()
    assert sum(seen) < len(x) * (len(x) - 1) / 2 / 3  # bounds decide the most


def test_vectors_query(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    cols = ("vec_id", "n_links", "component_id", "kept")
    got = Counter(tuple(r[c] for c in cols) for r in o13.op13_cover_tree_dedup(spark, SF).collect())
    assert got == Counter(con.execute(o13.OP13_SQL).fetchall())
    table = pa.table({"vec_id": list(range(len(vectors()))), "embedding": pa.array(vectors(), pa.list_(pa.float64()))})
    few = pa.concat_tables([table.slice(0, 40), table.slice(640, 120), table.slice(860, 90)])
    con.execute("drop view embeddings")
    con.register("embeddings", few)
    got = Counter(tuple(r[c] for c in cols) for r in o13.near_vectors(spark.createDataFrame(few)).collect())
    assert got == Counter(con.execute(o13.OP13_SQL).fetchall())
