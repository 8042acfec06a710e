import random
import re

import numpy as np
from loamflow.llm import tiling as T

DOCS = "doc_id long, text string, key long, tokens string, item string"
ITEMS = "item_id long, text string, seeds string"


def slow_tiles(p, t, least):
    """Longest unmarked common run first, found by trying all; ties by place."""
    least, out = min(least, len(p)), []
    used_p, used_t = [False] * len(p), [False] * len(t)
    while least:
        best = (0, 0, 0)
        for i in range(len(p)):
            for j in range(len(t)):
                k = 0
                while i + k < len(p) and j + k < len(t) and p[i + k] == t[j + k] and not used_p[i + k] and not used_t[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        if best[0] < least:
            break
        k, i, j = best
        used_p[i:i + k] = [True] * k
        used_t[j:j + k] = [True] * k
        out.append(best)
    return out


def test_tiles_match_the_plain_search():
    rnd = random.Random(1)
    for _ in range(1500):
        p = [rnd.randrange(rnd.choice([2, 4, 12])) for _ in range(rnd.randint(0, 45))]
        t = [rnd.randrange(6) for _ in range(rnd.randint(0, 30))]
        for _ in range(rnd.randint(0, 3)):
            a = rnd.randint(0, len(p))
            t += p[a:a + rnd.randint(0, 30)] + [99]
        got = T.tiles(np.array(p, np.uint64), np.array(t, np.uint64), 3)
        assert got == slow_tiles(p, t, 3), (p, t)
        marks = [m for k, i, j in got for m in range(i, i + k)]
        assert len(marks) == len(set(marks)) and all(p[i:i + k] == t[j:j + k] for k, i, j in got)


def words(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_pairs_match_brute_force(spark):
    rnd = random.Random(2)
    word = lambda: "w%d" % rnd.randrange(900)
    items = [(i, " ".join(word() for _ in range(rnd.randint(6, 40)))) for i in range(25)]
    items += [(50, None), (51, ""), (52, "Yes maybe no"), (53, items[0][1])]
    docs = []
    for i in range(150):
        w = [word() for _ in range(rnd.randint(0, 80))]
        if rnd.random() < 0.5:
            q = rnd.choice(items[:25])[1].split()
            cut = rnd.randrange(len(q) + 1)
            q = rnd.choice([q, q[cut:] + q[:cut], q[:cut], [x.upper() + "!" for x in q]])
            at = rnd.randint(0, len(w))
            w[at:at] = q
        docs.append((i, " ".join(w)))
    docs += [(200, None), (201, ""), (None, items[1][1]), (3, docs[3][1]), (202, "she said YES, maybe (no)"),
             (203, "x " * 30_000 + items[2][1])]
    df = spark.createDataFrame([(*d, 1, "t", "i") for d in docs], DOCS).repartition(3)
    bench = spark.createDataFrame([(*i, "s") for i in items], ITEMS)
    want = set()
    for d, text in docs:
        for i, item in items:
            p, t = words(item), words(text)
            if not p or not set(zip(*[p[k:] for k in range(min(5, len(p)))])) & set(zip(*[t[k:] for k in range(min(5, len(p)))])):
                continue
            if len(t) > 1000:
                t = t[-200:]
            got = slow_tiles(p, t, 5)
            if sum(x[0] for x in got) >= 0.5 * len(p):
                want.add((d, i, len(p), sum(x[0] for x in got)))
    got = [tuple(r) for r in T.contaminated_pairs(df, bench).select("doc_id", "item_id", "item_tokens", "covered_tokens").collect()]
    assert len(got) == len(set(got)) and set(got) == want
    bad = {d for d, *_ in want}
    left = T.decontaminate(df, bench)
    assert left.columns == df.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(d) for d, _ in docs if d not in bad)
    assert T.contaminated_pairs(df, bench.limit(0)).collect() == [] and T.contaminated_pairs(df.limit(0), bench).collect() == []


def test_repeats_take_time_in_proportion():
    one = np.full(200, 7, np.uint64)
    assert T.tiles(one, np.full(1_000_000, 7, np.uint64)) == [(200, 0, 0)]
    two = np.tile(np.array([7, 8], np.uint64), 100)
    # 7 8 7 is the longest common run: three of every four tokens
    assert sum(k for k, _, _ in T.tiles(two, np.tile(np.array([8, 7, 7], np.uint64), 300_000), 3)) == 150
    assert sum(k for k, _, _ in T.tiles(two, np.tile(np.array([7, 8, 9], np.uint64), 300_000), 2)) == 200


def test_names_of_ours_do_not_meet_the_tables(spark):
    text = "one two three four five six seven"
    rows = [(1, text, 10, 20, 30, 40, 50, 60, 70), (2, "other words", 11, 21, 31, 41, 51, 61, 71)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __key long, __slot long, __id long, __stays long, "
                                       "row_key long, slot long, known long")
    bench = spark.createDataFrame([(1, text)], "item_id long, text string")
    assert [tuple(r) for r in T.decontaminate(docs, bench).collect()] == [rows[1]]
    from loamflow.llm.partenum import one_of_each
    docs = spark.createDataFrame([*rows, (3, text, 0, 0, 0, 0, 0, 0, 0), rows[0]], docs.schema).withColumnRenamed("__key", "__n")
    assert sorted(tuple(r) for r in one_of_each(docs).collect()) == rows
    assert sorted(one_of_each(docs).columns) == sorted(docs.columns)
