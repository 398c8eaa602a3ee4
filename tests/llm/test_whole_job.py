"""Places where an operator once did less than its whole job."""

import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import op7_lm_scoring as o7
from tidemark.llm import op10_decontamination as o10
from tidemark.llm.op1_source_mixing import mix
from tidemark.llm.op6_language_id import UNKNOWN, identify, train_profiles
from tidemark.llm.op9_binary_output import tokenizer_path

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_words_of_a_class_follow_the_history(spark):
    """'cat' and 'hat' end alike and are equally frequent: only the word before tells them apart."""
    rows = [(i, "red cat" if i % 2 else "blue hat") for i in range(600)]
    rows += [(1000, "red cat"), (1001, "red hat"), (1002, "blue hat"), (1003, "blue cat")]
    got = {r["doc_id"]: r["score"] for r in o7.score(spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") >= 1000).collect()}
    assert got[1000] > got[1001] + 0.3 and got[1002] > got[1003] + 0.3


def test_word_probabilities_sum_to_one():
    rng = np.random.default_rng(3)
    h, k, c = rng.integers(0, 2**63, 900).astype(np.uint64), rng.integers(0, 32, 900), rng.integers(1, 50, 900)
    mass = np.ones((32, 1 << o7.WORD_BITS), np.float32)
    np.add.at(mass, (k, o7.codes(h)), c + 1)
    unseen = np.arange(32 << o7.WORD_BITS)
    h = np.append(h, (unseen >> 5).astype(np.uint64) << np.uint64(20))
    k, c = np.append(k, unseen & 31), np.append(c, np.zeros(len(unseen), int))
    model = o7.Softmax(rng.normal(size=32).astype(np.float32), mass)
    v = np.repeat(rng.normal(size=(1, o7.WIDTH)).astype(np.float32), len(h), axis=0)
    assert abs(np.exp(model.logs(v, k, h, c)).sum() - 1) < 1e-4


def test_weight_rows_grow_with_the_corpus():
    h = np.arange(1, 200_001, dtype=np.uint64)
    rows = o7.histories(o7.mix(h), np.array([0, len(h)]), len(h))
    assert all(len(np.unique(rows[:, i])) > 0.6 * len(h) for i in range(o7.FEATURES))


def test_short_items_match_whole_words(spark):
    docs = spark.createDataFrame([(1, "a  Blue whale."), (2, "blue whales, a bluewhale"), (3, "the blue whalf"), (4, "blue whales and a blue whale")], "doc_id long, text string")
    items = spark.createDataFrame([(9, "Blue whale"), (8, ""), (7, None)], "item_id long, text string")
    assert sorted(tuple(r) for r in o10.find_leaks(docs, items).collect()) == [(1, 9, 0, 2, 12), (4, 9, 0, 18, 28)]
    assert sorted(r["doc_id"] for r in o10.without_leaks(docs, items).collect()) == [2, 3]


def test_pipeline_keeps_every_clean_document(spark):
    """Exact rows, repeats and token ids of run(); near duplicates, leaks and ids are computed plainly, languages and repeats by op6 and op1 alone."""
    from tokenizers import Tokenizer

    table = spark.read.parquet(f"{SF}/documents.parquet")
    named = identify(table, train_profiles(table)).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= corpus_pipeline.LEAST_SCORE))
    good = {r["doc_id"] for r in named.collect()}
    text = {r["doc_id"]: r["text"] or "" for r in table.collect() if r["doc_id"] in good}
    sets, root = {}, {i: i for i in text}
    for i, t in text.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", t.translate(LOWER))
        sets[i] = {tuple(w[p : p + 5]) for p in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}
    for a in sorted(text):
        for b in sorted(text):
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root[a], root[b]))
                root = {i: x if r == y else r for i, r in root.items()}
    items = [o10.normal(r["text"] or "") for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = [i for i in text if root[i] == i and not any(s and s in o10.normal(text[i]) for s in items)]
    assert len(clean) > 0.5 * len(text)
    copies = {r["doc_id"]: r["copies"] for r in mix(table.where(F.col("doc_id").isin(clean)), F.array("source")).collect()}
    tokenizer, want = Tokenizer.from_file(tokenizer_path()), Counter()
    for i in clean:
        ids = [*tokenizer.encode(text[i], add_special_tokens=False).ids, 0]
        if copies[i]:
            want[i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] = copies[i]
    got = corpus_pipeline.run(spark, SF).collect()
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want


FOREIGN = [
    "Tämä on suomenkielinen teksti, joka ei kuulu mihinkään opituista kielistä, ja sen pitäisi siksi pudota pois aineistosta. Talvella järvet jäätyvät.",
    "To jest tekst napisany po polsku, który nie należy do żadnego z wyuczonych języków i powinien zostać odrzucony. Zimą jeziora zamarzają.",
    "Bu metin Türkçe yazılmıştır ve öğrenilen dillerden hiçbirine ait değildir, bu yüzden veri kümesinden çıkarılmalıdır. Kışın göller donar.",
    "Это русский текст, который не относится ни к одному из выученных языков и должен быть удалён из набора данных.",
    "Ez egy magyar nyelvű szöveg, amely nem tartozik a megtanult nyelvek egyikéhez sem, ezért ki kell esnie az adathalmazból.",
    "x1 9z qq zzk 3u8 kkq wx yy zq jj vv xk qz kj zx",
    "12345 67890 --- 2020",
    None,
]


def test_language_stage_drops_foreign_text_and_nothing_else(spark):
    """All rows of the table stay, in one of its languages each; texts in other languages, without letters or null go."""
    table = spark.read.parquet(f"{SF}/documents.parquet")
    more = spark.createDataFrame([(10**6 + i, t, None, "web", 0) for i, t in enumerate(FOREIGN)], table.schema)
    got = corpus_pipeline.language_id(spark, table.unionByName(more), SF)
    assert sorted(r["doc_id"] for r in got.select("doc_id").collect()) == sorted(r["doc_id"] for r in table.select("doc_id").collect())
