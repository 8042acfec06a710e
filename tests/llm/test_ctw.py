import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from loamflow.llm import ctw as C

DOCS = "doc_id long, text string, ctx long, byte long, n long, word string, row long"


def kt(a, b):
    return (math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi))


class Plain:
    """The same mixture by recursion over a dictionary of counts."""

    def __init__(self, texts, share):
        self.count = defaultdict(Counter)
        for t in texts:
            data = bytes([C.EDGE]) * C.DEPTH + t + bytes([C.EDGE])
            for i in range(C.DEPTH, len(data)):
                for d in range(C.DEPTH + 1):
                    self.count[data[i - d:i]][data[i]] += 1
        total = sum(self.count[b""].values())
        self.node = {c for c, n in self.count.items() if sum(n.values()) * share >= total}
        self.kids = defaultdict(list)
        for c in self.node:
            if c:
                self.kids[c[1:]].append(c)
        self.memo = {}

    def bits(self, counts, u, depth):
        a = b = 0
        for y, n in counts.items():
            if (y | 256) >> (8 - depth) == u:
                if y >> (7 - depth) & 1:
                    b += n
                else:
                    a += n
        return a, b

    def rest(self, c):
        out = Counter(self.count[c])
        for k in self.kids[c]:
            out.subtract(self.count[k])
        return out

    def weighted(self, c, u, depth):
        if (c, u) not in self.memo:
            own = kt(*self.bits(self.count[c], u, depth))
            deep = None
            if len(c) < C.DEPTH:
                deep = kt(*self.bits(self.rest(c), u, depth)) + sum(self.weighted(k, u, depth)[0] for k in self.kids[c])
                both = np.logaddexp(own, deep) - math.log(2)
                self.memo[c, u] = (both, math.exp(own - math.log(2) - both))
            else:
                self.memo[c, u] = (own, 1.0)
        return self.memo[c, u]

    def log10(self, text):
        data = bytes([C.EDGE]) * C.DEPTH + text + bytes([C.EDGE])
        out = 0.0
        for i in range(C.DEPTH, len(data)):
            path = [data[i - d:i] for d in range(C.DEPTH + 1) if data[i - d:i] in self.node]
            for depth in range(8):
                u = (data[i] | 256) >> (8 - depth)
                a, b = self.bits(self.count[path[-1]] if len(path[-1]) == C.DEPTH else self.rest(path[-1]), u, depth)
                p = (b + 0.5) / (a + b + 1)
                for c in reversed([x for x in path if len(x) < C.DEPTH]):
                    a, b = self.bits(self.count[c], u, depth)
                    w = self.weighted(c, u, depth)[1]
                    p = w * (b + 0.5) / (a + b + 1) + (1 - w) * p
                out += math.log10(p if data[i] >> (7 - depth) & 1 else 1 - p)
        return out


def corpus(n=40):
    rnd = random.Random(7)
    words = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 5))) for _ in range(30)]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 12)))) for i in range(n)]
    return rows + [(100, None), (101, ""), (None, "abc UNSEEN"), (3, rows[3][1]), (102, "ABC abc " * 400)]


def test_scores_match_the_plain_mixture_and_counts(spark, monkeypatch):
    monkeypatch.setattr(C, "STRETCH", 16)
    rows = corpus()
    df = spark.createDataFrame([(*r, 1, 1, 1, "w", 1) for r in rows], DOCS).repartition(3)
    got = C.score(df, frequent=8).collect()
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    train = [low(t) for i, t in rows if not held(i)]
    model = Plain([t.encode() for t in train], C.NODE_SHARE)
    toks = lambda t: re.findall(r"[^\x20\x09-\x0D]+", low(t)) + [None]
    count = Counter(w for t in train for w in toks(t))
    n, v = sum(count.values()), len(count)
    want = sorted((str(i), held(i), len(toks(t)), sum(count[w] > 0 for w in toks(t)), n,
                   round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in toks(t)), 6)) for i, t in rows)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    by = {r.doc_id: r.score for r in got}
    for i, t in rows[:8] + rows[-5:]:
        assert by[i] == pytest.approx(model.log10(low(t).encode()), rel=1e-5)


def test_rare_contexts_share_a_node(spark, monkeypatch):
    monkeypatch.setattr(C, "NODE_SHARE", 20)
    texts = [t for _, t in corpus(60) if t]
    m = C.train(spark.createDataFrame([(t,) for t in texts], "text string"))
    plain = Plain([C.LOWER[np.frombuffer(t.encode(), np.uint8)].tobytes() for t in texts], 20)
    assert len(m.log10) == len(plain.node) < 200
    assert np.allclose((10 ** m.log10.astype(float)).sum(1), 1, atol=1e-5)
    raw = np.frombuffer("abc dé unseen".encode(), np.uint8)
    assert C.log10_of(m, raw, np.array([0, len(raw)]))[0] == pytest.approx(plain.log10(raw.tobytes()), rel=1e-5)


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(i, "a b", 1, 1, 1, "w", 1) for i in range(40) if zlib.crc32(str(i).encode()) % 7 == 2], DOCS)
    for r in C.score(df).collect():
        assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (3, 0, 0, 0.0)
        assert r.score == pytest.approx(-4 * math.log10(256), rel=1e-5)
    assert C.score(df.limit(0)).collect() == []


def test_the_tree_grows_with_the_text(spark, monkeypatch):
    monkeypatch.setattr(C, "NODE_SHARE", 20)  # no bound of the scores
    monkeypatch.setattr(C, "CHUNK", 50)
    rows = [(i, t) for i, t in corpus(60) if i is not None]
    df = spark.createDataFrame([(*r, 1, 1, 1, "w", 1) for r in rows], DOCS).repartition(3)
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    model = Plain([low(t).encode() for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2], 1 << 40)
    for few in (0, 40, 1 << 20):  # grams sent to the tasks: none, some, all
        by = {r.doc_id: r.score for r in C.score(df, frequent_grams=few).collect()}
        for i, t in rows[:9] + rows[-4:]:
            assert by[i] == pytest.approx(model.log10(low(t).encode()), rel=1e-6)
