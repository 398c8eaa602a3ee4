"""Results worked out again in plain Python: profiles and distances, the model's training and scores, edited matches, flows."""

import functools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import op6_language_id as o6
from tidemark.llm import op7_lm_scoring as o7
from tidemark.llm import op10_decontamination as o10
from tidemark.llm.op1_source_mixing import min_cost_flow, mix, share_out
from tidemark.llm.text import mix as scrambled
from tidemark.llm.text import word_hashes

SF = "/root/testdata/sf0.001"
U = np.uint64
M64 = (1 << 64) - 1


def crc(i):
    return zlib.crc32(str(i).encode())


def scramble(n):
    return int(scrambled(np.array([n & M64], U))[0])


# language profiles


@functools.cache
def order_of(gram):
    """The number that settles ties between n-grams of one count."""
    a, b, c = [*map(ord, gram), 0, 0][:3]
    tag = (0, 1 << 62, 1 << 63)[len(gram) - 1]
    return scramble((c << 42) | (b << 21) | a | tag) & ((1 << 44) - 1)


def grams(text):
    n = Counter()
    for word in re.findall(r"[^\W\d_]+", text or ""):
        w = "".join(c.lower() if len(c.lower()) == 1 else c for c in word)
        padded = f"\0{w}\0"
        n.update(w)
        n.update(padded[i : i + 2] for i in range(len(w) + 1))
        n.update(padded[i : i + 3] for i in range(len(w)))
    return n


def ranked(n, size=400):
    return sorted(n, key=lambda g: (-n[g], order_of(g)))[:size]


def test_languages_recomputed(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    by = defaultdict(Counter)
    for r in docs:
        if crc(r["doc_id"]) % 4 != 2 and r["lang"] is not None:
            by[r["lang"]] += grams(r["text"])
    profiles = {x: {g: i for i, g in enumerate(ranked(by[x]))} for x in sorted(by)}
    got = {r["doc_id"]: r for r in o6.op6_language_id(spark, SF).collect()}
    assert len(got) == len(docs)
    for r in docs:
        own = ranked(grams(r["text"]))
        far = {x: sum(min(abs(p[g] - i), 400) if g in p else 400 for i, g in enumerate(own)) for x, p in profiles.items()}
        best = min(far, key=lambda x: (far[x], x))
        assert got[r["doc_id"]]["lang_pred"] == (best if own else "und")
        assert abs(got[r["doc_id"]]["score"] - (1 - far[best] / (400 * len(own)) if own else 0)) < 1e-12


def test_languages_of_equal_distance(spark):
    """Two languages with the same profile: the smaller name."""
    d = spark.createDataFrame([(1, "ab ab ba", "zz"), (2, "ab ab ba", "aa")], "doc_id long, text string, lang string")
    assert {(r["lang_pred"], r["score"]) for r in o6.identify(d, o6.train_profiles(d)).collect()} == {("aa", 1.0)}


# language model


def word_hash(w):
    return word_hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0]


class Plain:
    """The model a token at a time in double precision, for texts of one group."""

    def __init__(self, texts, held):
        self.shape, end = o7.Shape(), o7.END_TOKEN
        seen: dict[bytes, U] = {}
        self.tokens, self.classes = [], []
        for t in texts:
            ws = re.findall(rb"[^\x20\x09-\x0D]+", t.encode().lower())
            self.tokens.append([*(seen.setdefault(w, word_hash(w)) for w in ws), end])
            self.classes.append([*(scramble((w[-2] if len(w) > 1 else 0) << 8 | w[-1] | 1 << 40) % 31 for w in ws), 31])
        c = Counter(int(h) for x, out in zip(self.tokens, held, strict=True) if not out for h in x)
        kind = {int(h): k for x, ks in zip(self.tokens, self.classes, strict=True) for h, k in zip(x, ks, strict=True)}
        self.n, self.size = c, max(o7.ROWS, sum(c.values()))
        self.mass = np.ones((32, 1 << o7.WORD_BITS))
        of_class = np.zeros(32)
        for h, n in c.items():
            self.mass[kind[h], self.code(h)] += n + 1
            of_class[kind[h]] += n
        self.bias = np.log((of_class + 1) / (of_class.sum() + 32))
        self.w = defaultdict(lambda: np.zeros(o7.WIDTH))
        self.train([not out for out in held])

    @staticmethod
    def code(h):
        return (int(h) >> 20) & 127

    def rows(self, x, i):
        one = int(x[i - 1]) if i >= 1 else int(o7.START)
        two = int(x[i - 2]) if i >= 2 else int(o7.START)
        return [(0, scramble(one) % self.size), (1, scramble(two ^ 0xABCDEF) % self.size), (2, scramble(one * 0x9E3779B97F4A7C15 + two) % self.size)]

    def factors(self, v, k):
        p = np.exp(self.bias + v[:5] @ o7.signs(5))
        q = self.mass[k] * np.exp(v[5:] @ o7.signs(7))
        return p / p.sum(), q / q.sum()

    def train(self, learn):
        all_tokens = [(d, i) for d, x in enumerate(self.tokens) for i in range(len(x))]
        marked = np.array([learn[d] for d, _ in all_tokens])
        order = np.random.default_rng(len(all_tokens)).permutation(np.flatnonzero(marked))
        squares = defaultdict(lambda: 1e-6)
        for lo in range(0, len(order), self.shape.batch):
            slope = defaultdict(lambda: np.zeros(o7.WIDTH))
            for j in order[lo : lo + self.shape.batch]:
                d, i = all_tokens[j]
                rows, k, s = self.rows(self.tokens[d], i), self.classes[d][i], self.code(self.tokens[d][i])
                p, q = self.factors(sum(self.w[r] for r in rows), k)
                g = np.concatenate([o7.signs(5) @ p - o7.signs(5)[:, k], o7.signs(7) @ q - o7.signs(7)[:, s]])
                for r in rows:
                    slope[r] += g
            for r, g in slope.items():
                squares[r] += (g * g).mean()
                self.w[r] = self.w[r] - self.shape.rate * g / math.sqrt(squares[r])
        self.w = defaultdict(lambda: np.zeros(o7.WIDTH), {r: np.clip(np.rint(w / o7.STEP), -7, 7) * o7.STEP for r, w in self.w.items()})

    def score(self, d):
        total = 0.0
        for i, (h, k) in enumerate(zip(self.tokens[d], self.classes[d], strict=True)):
            p, q = self.factors(sum(self.w[r] for r in self.rows(self.tokens[d], i)), k)
            s = self.code(h)
            total += math.log10(p[k] * q[s] * (self.n[int(h)] + 1) / self.mass[k, s])
        return total


def test_model_recomputed(spark):
    """Training and scores, up to weights that single precision rounds to the next step."""
    table = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60")
    docs = sorted(table.collect(), key=lambda r: r["doc_id"])
    plain = Plain([r["text"] or "" for r in docs], [crc(r["doc_id"]) % 7 == 2 for r in docs])
    got = {r["doc_id"]: r["score"] for r in o7.score(table, o6.held_out(F.col("doc_id"), 7, 2)).collect()}
    want = {r["doc_id"]: plain.score(i) for i, r in enumerate(docs)}
    assert len(docs) > 40 and got.keys() == want.keys()
    assert max(abs(got[i] / want[i] - 1) for i in want) < 5e-3
    assert abs(sum(got.values()) / sum(want.values()) - 1) < 5e-4


# benchmark items with edits


def least_edits(item, text):
    """The smallest edit distance of item to any substring of text, a row of the matrix at a time."""
    t, j = np.array([ord(c) for c in text]), np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for i, c in enumerate(item, 1):
        new = np.minimum(row + 1, np.concatenate(([i], row[:-1] + (t != ord(c)))))
        row = np.minimum.accumulate(new - j) + j
    return int(row.min())


def edited(rng, s, n):
    out = list(s)
    for _ in range(n):
        at, what = rng.randrange(len(out)), rng.randrange(3)
        if what == 0:
            out[at] = rng.choice("abcxyz ")
        elif what == 1:
            del out[at]
        else:
            out.insert(at, rng.choice("abcxyz "))
    return "".join(out)


@pytest.mark.parametrize("rate", [0.08, 0.1])
def test_edited_items_against_plain_distance(spark, rate):
    """Items with 0 to 12% edits: found with their least distance if that is within the budget, and nothing else is."""
    rng = random.Random(11)
    texts = {r["doc_id"]: r["text"][:1500] for r in spark.read.parquet(f"{SF}/documents.parquet").where("length(text) > 400").orderBy("doc_id").limit(30).collect()}
    items = {}
    for i in range(48):
        t = texts[rng.choice(list(texts))]
        at, n = rng.randrange(len(t) - 160), rng.randint(20, 150)
        items[i] = edited(rng, t[at : at + n], round(n * (i % 13) / 100))
    plain_texts = {d: o10.normal(t) for d, t in texts.items()}
    want = {}
    for i, s in items.items():
        s = o10.normal(s)
        for d, t in plain_texts.items():
            if len(s) >= 20 and (e := least_edits(s, t)) <= int(rate * len(s)):
                want[d, i] = e
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    bench = spark.createDataFrame([x for x in items.items() if len(o10.normal(x[1])) >= 20], "item_id long, text string")
    got = o10.find_leaks(docs, bench, error_rate=rate, block_chars=2000).collect()  # several blocks
    assert {(r["doc_id"], r["item_id"]): r["edits"] for r in got} == want and len(got) == len(want)
    assert len({e for e in want.values()}) > 4 and any(i not in {x for _, x in want} for i in items)
    for r in got:
        s, t = o10.normal(items[r["item_id"]]), plain_texts[r["doc_id"]]
        assert least_edits(s, t[r["start"] : r["end"]]) == r["edits"]
    held = {d for d, _ in want}
    assert sorted(r["doc_id"] for r in o10.without_leaks(docs, bench, error_rate=rate, block_chars=2000).collect()) == sorted(set(texts) - held)


# mixing


def best_flow(patterns, quotas, repeats=3):
    """(words, cost) of a largest flow of least cost, by trying all splits word by word."""
    states = {tuple(0 for _ in quotas): 0}
    names = list(quotas)
    for sources, words in patterns:
        mine = [names.index(s) for s in sources]
        options = [()]
        for s in mine:
            options = [(*o, (s, n)) for o in options for n in range(quotas[names[s]] + 1) if sum(x for _, x in o) + n <= repeats * words]
        after = {}
        for used, cost in states.items():
            for o in options:
                to = list(used)
                for s, n in o:
                    to[s] += n
                if all(n <= quotas[x] for n, x in zip(to, names, strict=True)):
                    q, r = divmod(sum(n for _, n in o), words) if words else (0, 0)
                    c = cost + words * q * q + r * (2 * q + 1)
                    if c < after.get(tuple(to), math.inf):
                        after[tuple(to)] = c
        states = after
    return min(((sum(u), c) for u, c in states.items()), key=lambda x: (-x[0], x[1]))


def test_flow_costs_least():
    rng = random.Random(4)
    for _ in range(120):
        names = ["a", "b", None][: rng.randint(1, 3)]
        patterns = [(rng.sample(names, rng.randint(0, len(names))), rng.randint(0, 3)) for _ in range(rng.randint(1, 4))]
        quotas = {s: rng.randint(0, 6) for s in names}
        flows = min_cost_flow(patterns, quotas)
        cost = 0
        for (sources, words), f in zip(patterns, flows, strict=True):
            assert set(f) <= set(sources) and sum(f.values()) <= 3 * words
            q, r = divmod(sum(f.values()), words) if words else (0, 0)
            cost += words * q * q + r * (2 * q + 1)
        assert all(sum(f.get(s, 0) for f in flows) <= quotas[s] for s in names)
        assert (sum(sum(f.values()) for f in flows), cost) == best_flow(patterns, quotas)


def test_flow_takes_back_what_others_need():
    """A long chain: each pattern must leave its first source to the one before it."""
    n = 300
    patterns = [([i, i + 1], 1) for i in range(n)] + [([0], 1)]
    flows = min_cost_flow(patterns, dict.fromkeys(range(n + 1), 1), max_repeats=1)
    assert flows == [{i + 1: 1} for i in range(n)] + [{0: 1}]


def test_mix_of_documents_in_several_sources(spark):
    rng = random.Random(9)
    rows = []
    for i in range(3000):
        m = ["a"] if i % 3 == 0 else rng.sample(["a", "b", "c", None], rng.randint(1, 3))
        rows.append((i, m, rng.randint(0, 80)))
    docs = spark.createDataFrame(rows, "doc_id long, m array<string>, n long")
    got = {r["doc_id"]: r for r in mix(docs, F.col("m"), F.col("n")).collect()}
    assert len(got) == len(rows)
    sizes, taken, total = Counter(), Counter(), sum(n for *_, n in rows)
    for i, m, n in rows:
        sizes.update(dict.fromkeys(m, n))
        r = got[i]
        assert r["quota_source"] in m and 0 <= r["copies"] <= 3 and r["taken"] == r["copies"] * n
        taken[r["quota_source"]] += r["taken"]
    names = ["a", "b", "c", None]
    target = share_out({s: sizes[s] for s in names}, dict(zip(names, (1, 2, 3, 1), strict=True)), total)
    assert all(abs(taken[s] - target[s]) <= 0.08 * target[s] for s in names)
    assert abs(sum(taken.values()) - sum(target.values())) <= 0.01 * total
