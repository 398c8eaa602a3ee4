"""Every operator on nulls, empties, ties, repeated rows, empty tables and clashing extra columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import op1_source_mixing as o1
from tidemark.llm import op4_url_filter as o4
from tidemark.llm import op6_language_id as o6
from tidemark.llm import op7_lm_scoring as o7
from tidemark.llm import op9_binary_output as o9
from tidemark.llm import op10_decontamination as o10
from tidemark.llm.op2_fm_dedup import dedup_words
from tidemark.llm.op3_suffix_dedup import dedup_bytes
from tidemark.llm.op5_learned_partitions import search, valid
from tidemark.llm.op8_jaccard_join import near_duplicates, one_of_each

LONG = " ".join(f"word{i % 700}x{i % 13}" for i in range(30_000))
COPY = " ".join(f"same{i}" for i in range(60))
ROWS = [(1, COPY, "en", "a"), (2, COPY, "en", None), (2, COPY, "en", None), (3, None, None, "b"), (4, "", "en", "b"), (5, LONG, "en", "a"), (6, "one", "fr", "a"), (None, COPY + " tail", None, None), (None, None, None, None), (7, " \t\n ", "fr", "c"), (8, "ein Satz über Ähren und Öl", "de", "c")]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    extra = [F.lit(i).alias(c) for i, c in enumerate(("score", "size", "sig", "ranges", "d", "r", "copies", "row", "n", "a", "comp"))]
    return spark.createDataFrame(ROWS, SCHEMA).select("*", *extra)


OPERATORS = {
    "op1": lambda d: o1.mix(d, F.array("source")).select("doc_id", "size", "source_size", "target", "taken"),
    "op2": dedup_words,
    "op3": dedup_bytes,
    "op6": lambda d: o6.identify(d, o6.train_profiles(d)),
    "op7": lambda d: o7.score(d, o6.held_out(F.col("doc_id"), 7, 2)),
    "op8": near_duplicates,
    "op9": lambda d: o9.tokens_out(d, o9.tokenizer_path()),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_rows_out(docs, name):
    got = OPERATORS[name](docs).collect()
    assert len(got) == len(ROWS)
    assert OPERATORS[name](docs.limit(0)).count() == 0


def test_results(docs):
    by = lambda df, *c: sorted([tuple(r[x] for x in c) for r in df.collect()], key=repr)
    w = by(OPERATORS["op2"](docs), "doc_id", "n_words", "n_removed")
    assert (1, 60, 0) in w and w.count((2, 60, 60)) == 2 and (None, 61, 60) in w and (3, 0, 0) in w
    b = {r["doc_id"]: r for r in OPERATORS["op3"](docs).where("doc_id is not null").collect()}
    assert b[1]["n_removed"] == b[2]["n_removed"] == b[1]["n_bytes"] and b[1]["n_spans"] == 1 and b[3]["n_bytes"] == 0
    lang = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in OPERATORS["op6"](docs).collect()}
    assert lang[3] == lang[4] == lang[7] == ("und", 0.0)
    c = by(near_duplicates(docs), "doc_id", "n_shingles", "component_id")
    assert c.count((2, 56, 1)) == 2 and (None, 57, 1) in c and (6, 1, 6) in c and (4, 0, 4) in c
    kept = one_of_each(docs)
    assert kept.columns == docs.columns and by(kept, "doc_id") == sorted([(1,), (3,), (4,), (5,), (6,), (7,), (8,), (None,)], key=repr)
    t = OPERATORS["op1"](docs).collect()
    assert all(r["taken"] <= 3 * r["size"] and r["taken"] >= 0 for r in t)


def test_unlabelled_is_unknown(docs):
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in o6.identify(docs, o6.train_profiles(none)).collect()} == {"und"}


def test_urls(spark):
    urls = [(1, None), (2, "nohost"), (3, "HTTP://A.Example.COM/en/x?y"), (4, "http://www.example.com/en/"), (5, "http://x.www.example.com/en/1"), (6, "http://example.net/fr/x"), (7, "x://com"), (8, "x://com/"), (9, "a://zcom/"), (10, "a://example.com.zz/en/"), (11, "q://net/es/\n"), (11, "q://net/es/\n"), (12, "")]
    pages = spark.createDataFrame(urls, "page_id long, url string").withColumns({"host": F.lit("h"), "stack": F.lit(1), "rule": F.lit("r")})
    got = o4.filter_urls(pages, o4.rule_table(spark))
    rules = {r["page_id"]: r["rule"] for r in got.collect()}
    assert rules == {1: None, 2: None, 3: "example.com/en/", 4: "www.example.com/en/", 5: "www.example.com/en/", 6: "net/fr/", 7: None, 8: "com/", 9: None, 10: None, 11: "net/es/", 12: None}
    assert got.count() == 13 and o4.filter_urls(pages.limit(0), o4.rule_table(spark)).count() == 0
    nested = [("allow", "b.c", "/"), ("block", "a.b.c", "/x"), ("allow", "z.a.b.c", "/x/y"), ("block", "c", "/")]
    more = spark.createDataFrame([(1, "h://q.z.a.b.c/x/y"), (2, "h://z.a.b.c/x"), (3, "h://k.b.c/x"), (4, "h://d.c/"), (5, "h://cc/")], "page_id long, url string")
    assert {r["page_id"]: r["rule"] for r in o4.filter_urls(more, o4.rule_table(spark, nested)).collect()} == {1: "z.a.b.c/x/y", 2: "a.b.c/x", 3: "b.c/", 4: "c/", 5: None}


def test_vectors(spark):
    vs = [(i, [float(i % 7) + 1, 1.0, float(i % 3)]) for i in range(0, 50)] + [(100, None), (101, [0.0, 0.0, 0.0]), (102, [1.0, None, 1.0]), (103, [float("nan"), 1.0, 1.0]), (104, [float("inf"), 1.0, 1.0]), (105, [1.0]), (None, [1.0, 1.0, 1.0])]
    x = valid(spark.createDataFrame(vs, "vec_id long, embedding array<double>").withColumn("v", F.lit(1)), "embedding")
    got = search(x, x.where("vec_id % 20 = 0"), k=4).collect()
    assert len(got) == 3 * 4
    data = dict(vs[:50])
    for q in (0, 20, 40):
        want = sorted((-sum(a * b for a, b in zip(data[q], data[i], strict=True)), i) for i in data if i != q)[:4]
        assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] == [i for _, i in want]
    assert search(x.limit(0), x.limit(0)).count() == 0
    few = x.where("vec_id < 3")
    assert search(few, few.where("vec_id = 0"), k=20).count() == 2


def test_leaks(spark, docs):
    bench = spark.createDataFrame([(1, COPY[:200]), (2, None), (3, ""), (4, "tiny"), (5, "nowhere to be found in any of these documents at all")], "item_id long, text string").withColumn("doc_id", F.lit(9))
    found = o10.find_leaks(docs, bench)
    assert sorted((r["doc_id"], r["item_id"], r["edits"]) for r in found.where("doc_id is not null").collect()) == [(1, 1, 0), (2, 1, 0), (2, 1, 0)]
    assert o10.without_leaks(docs, bench).count() == len(ROWS) - 4
    assert o10.find_leaks(docs, bench.limit(0)).count() == 0 and o10.find_leaks(docs.limit(0), bench).count() == 0


def test_pipeline_stages(spark, docs, tmp_path):
    d = str(tmp_path)
    spark.createDataFrame([(1, COPY[:200])], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    for rows in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, rows, d)
            assert out.columns == docs.columns, name
            out.collect()


def test_groups_give_free_memory_back_before_and_after(monkeypatch):
    from tidemark.llm import text

    seen = []
    monkeypatch.setattr(text, "release", lambda: seen.append("release"))
    assert text.tidied(lambda a, b: seen.append("groups") or a + b)(1, 2) == 3
    assert text.tidied(lambda a: seen.append("group") or a)(1) == 1
    assert seen == ["release", "groups", "release", "release", "group", "release"]
