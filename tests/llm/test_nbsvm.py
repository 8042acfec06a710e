import random
import zlib

import numpy as np
from loamflow.llm import nbsvm, quality, toxicity
from loamflow.llm.nbsvm import BITS

DOCS = "doc_id long, text string, lang string, source string, n_chars long, label int, score string, rank int"
LABELS = "doc_id long, quality int, toxic int, text string"


def corpus(spark, n=600, seed=1):
    rnd = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = ["".join(rnd.choice("abcdefg") for _ in range(rnd.randint(2, 7))) for _ in range(rnd.randint(5, 80))]
        good, toxic = rnd.random() < 0.7, rnd.random() < 0.3
        if not good:
            words = [w + "%%%" if rnd.random() < 0.5 else w.upper() + "!!" for w in words]
        if toxic:
            words.insert(rnd.randrange(len(words)), "moronic")
            words.insert(rnd.randrange(len(words)), "moronic")
        docs.append((i, " ".join(words), "en", "s", 1, 0, "x", 0))
        labels.append((i, int(good), int(toxic), "clash"))
    odd = [(None, "no id", "en", "s", 1, 0, "x", 0), (n, None, None, None, None, None, None, None), (n + 1, "", "en", "s", 0, 0, "x", 0),
           (n + 2, "z", "en", "s", 0, 0, "x", 0), (0, docs[0][1], "en", "s", 0, 0, "x", 0), (n + 3, "word " * 60_000, "en", "s", 0, 0, "x", 0)]
    more = [(None, 1, 1, "c"), (5, None, None, "c"), labels[6], (n + 9, 1, 1, "c")]
    return spark.createDataFrame(docs + odd, DOCS), spark.createDataFrame(labels + more, LABELS), labels


def test_held_out_accuracy_and_odd_rows(spark):
    docs, labels, truth = corpus(spark)
    for run, col, cut in ((quality.score_quality, 1, 0.7), (toxicity.score_toxicity, 2, 0.3)):
        rows = run(docs, labels).collect()
        assert len(rows) == 606 and all(0 <= r.score <= 1 and r.predicted == (r.score >= cut) for r in rows)
        by = {r.doc_id: r for r in rows}
        assert all(by[t[0]].held_out == (zlib.crc32(str(t[0]).encode()) % 4 == 2) for t in truth)
        held = [t for t in truth if by[t[0]].held_out]
        assert len(held) > 100 and np.mean([by[t[0]].predicted == t[col] for t in held]) > 0.95
        assert len({r.score for r in rows if r.doc_id == 0}) == 1
        assert by[600].score == by[601].score


def test_without_labels_and_without_documents(spark):
    docs, labels, _ = corpus(spark, 30)
    assert len({r.score for r in toxicity.score_toxicity(docs, labels.limit(0)).collect()}) == 1
    assert quality.score_quality(docs.limit(0), labels).collect() == []


def block(texts):
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    return raw, np.cumsum([0] + [len(t.encode()) for t in texts])


def test_features_depend_on_the_text_alone():
    texts = ["one two", "", "THE the the", "x", "one two", "é%% |", "a\nb  c"]
    for f in (quality.features, nbsvm.char_ngrams((2, 3))):
        keys = f(*block(texts))
        alone = [set((f(*block([t])) & np.uint32(nbsvm.N_FEATURES - 1)).tolist()) for t in texts]
        rows = keys >> np.uint32(BITS)
        assert [set((keys[rows == i] & np.uint32(nbsvm.N_FEATURES - 1)).tolist()) for i in range(len(texts))] == alone
        assert len(set(keys.tolist())) == len(keys) and alone[0] == alone[4] and not alone[1]
        keep = np.zeros(nbsvm.N_FEATURES, bool)
        keep[list(alone[0])] = True
        kept = f(*block(texts), keep)
        assert set(kept.tolist()) == {k for k in keys.tolist() if keep[k & (nbsvm.N_FEATURES - 1)]}


def test_descent_reaches_the_optimum():
    rnd = np.random.default_rng(3)
    dense = rnd.normal(size=(60, 4))
    y = np.where(dense @ [1, -2, 0.5, 0] + 0.3 * rnd.normal(size=60) > 0.2, 1.0, -1.0)
    cost = np.full(60, 0.7)
    w, b = nbsvm.dual_coordinate_descent([(np.arange(4), r) for r in dense], y, cost, 2000)
    slack = np.maximum(0, 1 - y * (dense @ w[:4] + b))
    grad = np.append(w[:4], b) - 2 * (cost * slack * y) @ np.c_[dense, np.ones(60)]
    assert np.abs(grad).max() < 1e-2


def test_ratios_keep_what_tells_the_classes_apart():
    zero, one = np.array([0, 100, 50, 1]), np.array([40, 10, 5, 0])
    r = nbsvm.log_count_ratios(zero, one, 1000, 100)
    assert r[0] > 0 and r[1] == r[2] == r[3] == 0


def test_every_feature_that_passes_the_test_is_kept():
    hits = np.arange(20_000) % 300 + 30
    side = np.arange(20_000) % 2 == 0
    r = nbsvm.log_count_ratios(np.where(side, 0, hits), np.where(side, hits, 0), 500, 500)
    assert (r[side] > 0).all() and (r[~side] < 0).all()


def test_packed_rows_come_back_whole():
    rnd = np.random.default_rng(4)
    r = rnd.normal(size=nbsvm.N_FEATURES)
    rows = [np.sort(rnd.choice(nbsvm.N_FEATURES, k, replace=False)).astype(np.uint32) for k in (0, 1, 5, 300, 200_000)]
    rows += [np.array([0]), np.array([0, 254, 255, 510, 1020, nbsvm.N_FEATURES - 1]), np.array([255])]
    x = nbsvm.Rows([nbsvm.packed(f) for f in rows], r)
    assert len(x) == len(rows) and len(x.gaps[4]) < 300_000
    assert all((f == want).all() and len(f) == len(want) and (v == r[want]).all() for want, (f, v) in zip(rows, x))
