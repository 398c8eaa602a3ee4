"""What the operators shuffle, write and encode."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import op3_suffix_dedup as o3
from tidemark.llm import op7_lm_scoring as o7
from tidemark.llm import op9_binary_output as o9

SF = "/root/testdata/sf0.001"


def test_language_model_shuffles_texts_once(spark, monkeypatch):
    """Training and scoring share one shuffle of compressed texts, and nothing but the scores is written."""
    seen = {}
    monkeypatch.setattr(o7, "written", lambda df, name: seen.setdefault(name, df))
    table = spark.read.parquet(f"{SF}/documents.parquet")
    assert o7.score(table, F.col("doc_id") % 7 == 2).count() == table.count()
    assert list(seen) == ["scores"]
    seen["scores"].collect()
    assert "ReusedExchange" in seen["scores"]._jdf.queryExecution().executedPlan().toString()


def test_encoder_gets_words_together(monkeypatch):
    """Words of letters are encoded many at once, with the ids that each text has alone."""
    path = o9.tokenizer_path()
    t, *rest = o9.encoder(path)
    given = []

    class Counted:
        def encode_batch_fast(self, texts, **options):
            given.extend(texts)
            return t.encode_batch_fast(texts, **options)

        def encode(self, *args, **options):
            return t.encode(*args, **options)

    monkeypatch.setattr(o9, "encoder", lambda _: (Counted(), rest[0], rest[1], cache, *rest[3:]))
    cache: dict[str, bytes] = {}
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghéüßñŁжλ漢ªǅ") for _ in range(rng.randint(1, 9)))
    texts = [" ".join(word() + rng.choice(["", "", "", ".", ",", "!!", ".%%%", "'s", "'", ".'", "½", "_", "7", "́", "-x", "<|"]) for _ in range(300)) for _ in range(20)]
    texts += ["an end<|endoftext|> within", "", " ", "  a  b\n c d　e", "a b  c. d,, e", " 're I'll don't 'S", "x.y z!", "\U0001e900\U00010d4a \U0002ebf0"]
    got = o9.encode(texts, path)
    assert [x.tolist() for x in got] == [t.encode(x, add_special_tokens=False).ids for x in texts]
    alike = {x for x in cache if x[0] == " " and x[1:].isalpha()}
    assert len(alike) > 1000 and sum(x in alike for x in given) < len(alike) / 10


def test_bytes_repeated_in_several_near_copies():
    """Exactly the windows that recur, among near copies that part at different places (before, places next to repeats in the array were marked as well)."""
    rng = np.random.default_rng(7)
    for alphabet, copies, length in ((60, 5, 256), (4, 3, 96), (60, 8, 400), (30, 2, 100)):
        segs = []
        for _ in range(12):
            base = rng.integers(60, 60 + alphabet, 1500, dtype=np.uint8)
            for _ in range(copies):
                x = base.copy()
                x[rng.integers(0, len(x), 3)] = 59
                segs.append(x.tobytes()[: rng.integers(length, 1501)])
        n = np.array([len(s) - length + 1 for s in segs])
        count = Counter(s[i : i + length] for s in segs for i in range(len(s) - length + 1))
        want = [count[s[i : i + length]] > 1 for s in segs for i in range(len(s) - length + 1)]
        assert (o3.byte_match(segs, n, np.arange(len(segs)), length) == 0).tolist() == want


def test_pairs_of_suffixes_are_not_sorted_to_the_end():
    """Two suffixes that are alone in what they share leave the sort, next to each other."""
    text = np.tile(np.random.default_rng(3).integers(1, 60, 3000), 2)
    sa, _ = o3.suffix_array(text, 400, 400, 40)
    place = np.empty(6000, int)
    place[sa] = np.arange(6000)
    assert all(abs(place[i] - place[i + 3000]) == 1 for i in range(2900))
