import random
import re

import numpy as np
from loamflow.llm import partenum as P
from loamflow.llm.components import connected_components

DOCS = "doc_id long, text string, cls string, sig long, n int, root string"


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) or (frozenset([tuple(w)]) if w else frozenset())


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                up[find(a)] = find(b)
    comp = {}
    for a in range(len(rows)):
        if sets[a][0] is not None:
            comp[find(a)] = min(comp.get(find(a), sets[a][0]), sets[a][0])
    return sorted((str(sets[a][0]), len(sets[a][1]), str(comp.get(find(a)) if sets[a][1] else sets[a][0]))
                  for a in range(len(rows)))


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda: "w%d" % rnd.randrange(4000)
    passage = [word() for _ in range(60)]
    rows, made = [], []
    for i in range(260):
        p = rnd.random()
        if p < 0.45 and made:  # a copy with some words changed, near the threshold too
            w = list(rnd.choice(made))
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 4, len(w) // 40])):
                if w:
                    w[rnd.randrange(len(w))] = word()
            if rnd.random() < 0.3:
                w = w[:rnd.randint(len(w) * 4 // 5, len(w))]
        elif p < 0.6:
            w = passage + [word() for _ in range(rnd.randint(0, 60))]
            rnd.random() < 0.5 and w.reverse()
        else:
            w = [word() for _ in range(rnd.choice([1, 2, 4, 5, 6, 7, 9, 15, 30, 60, 120, 400]))]
        made.append(w)
        rows.append((rnd.randrange(-5, 9999), " ".join(w)))
    rows += [(1, None), (2, ""), (3, "  \n"), (None, rows[0][1]), (None, "alone in the world with nobody here"), rows[4], rows[4],
             (10_001, "Same case FOLDED text here."), (10_000, "same CASE folded text here."), (20_000, " ".join("x%d" % i for i in range(20_000)))]
    return rows


def test_components_match_brute_force(spark):
    for seed in (1, 2):
        rows = corpus(seed)
        df = spark.createDataFrame([(*r, "c", 1, 2, "r") for r in rows], DOCS).repartition(4)
        got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in P.jaccard_components(df).collect())
        assert got == brute(rows)


def brute_links(rows):
    sets = [shingles(t) for _, t in rows]
    links = lambda x, y: bool(x) and bool(y) and 100 * len(x & y) >= 80 * len(x | y)
    return sorted((str(i), len(x), sum(links(x, y) for y in sets) - links(x, x)) for (i, _), x in zip(rows, sets))


def test_links_match_brute_force(spark):
    for seed in (1, 3):
        rows = corpus(seed)
        df = spark.createDataFrame([(*r, "c", 1, 2, "r") for r in rows], DOCS).repartition(4)
        got, links = P.jaccard_links(df)
        got = got.collect()
        assert sorted((str(r.doc_id), r.n_shingles, r.n_links) for r in got) == brute_links(rows)
        classes = {r.cls for r in got}
        pairs = [tuple(r) for r in links.collect()]
        assert len(set(pairs)) == len(pairs) and all(u < v and {u, v} <= classes for u, v in pairs)
    rows, links = P.jaccard_links(df.limit(0))
    assert rows.collect() == [] and links.collect() == []


def test_groups_of_many_blocks(spark, monkeypatch):
    """With blocks of four, most signature groups are of many, of one component or of several."""
    monkeypatch.setattr(P, "BLOCK", 4)
    rnd = random.Random(5)
    word = lambda: "w%d" % rnd.randrange(4000)
    first = [word() for _ in range(80)]
    rows = []
    for i in range(120):  # two families around one passage that link within, a few drifting between
        w = list(first)
        if i % 2:
            w[60:] = ["v%d" % k for k in range(20)]
        for _ in range(i % 3):
            w[rnd.randrange(len(w))] = word()
        rows.append((i, " ".join(w)))
    rows += [(500 + i, rows[0][1]) for i in range(40)]
    df = spark.createDataFrame([(*r, "c", 1, 2, "r") for r in rows], DOCS).repartition(3)
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in P.jaccard_components(df).collect())
    assert got == brute(rows)
    got = sorted((str(r.doc_id), r.n_shingles, r.n_links) for r in P.jaccard_links(df)[0].collect())
    assert got == brute_links(rows)


def test_empty_table_and_no_copies(spark):
    df = spark.createDataFrame([(1, "a b c", "c", 1, 1, "r"), (2, None, "c", 1, 1, "r")], DOCS)
    assert P.jaccard_components(df.limit(0)).collect() == []
    assert sorted(map(tuple, P.jaccard_components(df).collect())) == [(1, 1, 1), (2, 0, 2)]


def test_linked_sets_always_share_a_signature():
    rnd = np.random.default_rng(4)
    for size in [1, 2, 3, 4, 5, 6, 8, 9, 10, 13, 17, 21, 26, 40, 55, 70, 111, 160, 333, 700]:
        for _ in range(60):
            a = np.unique(rnd.integers(0, 2**63, size).astype(np.uint64))
            n = len(a)
            other = n * 5 // 4 if rnd.random() < 0.5 else n
            diff = int(P.distance(n, other))
            drop = (diff - (other - n)) // 2
            b = np.unique(np.concatenate([a[max(drop, 0):], rnd.integers(0, 2**63, other - n + max(drop, 0)).astype(np.uint64)]))
            if not P.linked(a >> np.uint64(16), b >> np.uint64(16)):
                continue
            x, y = P.all_signatures([a, b])
            assert len(np.intersect1d(x, y)), (n, other)


def test_bands_hold_linked_sizes():
    edges = P.band_edges(3000)
    for a in range(1, 2400):
        band = lambda n: np.searchsorted(edges, n, "right") - 1
        assert band(a * 5 // 4) - band(a) <= 1


def test_connected_components(spark):
    rnd = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rnd.randrange(90), rnd.randrange(90)) for _ in range(60)] + [(5, 5)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x
    for u, v in edges:
        a, b = sorted((find(u), find(v)))
        up[b] = a
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert got == {x: find(x) for x in up if find(x) != x}
    assert connected_components(spark.createDataFrame([(7, 7)], "u long, v long")).collect() == []


def test_one_of_each_group_stays(spark):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (3, "other words here"), (3, "other words here"), (None, "no id"), (4, None),
            (5, "a b c d e f"), (6, "different text"), (6, "of one id")]
    df = spark.createDataFrame([(*r, "c", 1, 2, "r") for r in rows], DOCS)
    got = sorted((str(r.doc_id), r.text) for r in P.one_of_each(df).collect())
    assert P.one_of_each(df).columns == df.columns
    assert got == sorted([("1", rows[0][1]), ("3", rows[2][1]), ("None", "no id"), ("4", None), ("6", rows[7][1]), ("6", rows[8][1])], key=lambda x: (x[0], x[1] or ""))
    assert P.one_of_each(df.limit(0)).collect() == []
