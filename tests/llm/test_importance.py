"""Importance resampling against a plain version, and its defined cases."""

import math
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest

from loamflow.llm import importance as I

WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, n):
    words = WORDS.findall((text or "").encode().translate(bytes(I.LOWER)))
    return [b" ".join(words[i:i + g]) for g in range(1, n + 1) for i in range(len(words) - g + 1)], len(words)


def plain(docs, target, n=1, buckets=50, seed="2024", min_words=3, percent=40):
    def counts(texts):
        return Counter(zlib.crc32(f) % buckets for t in texts for f in features(t, n)[0])
    s, t = counts(x for _, x in docs), counts(target)
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets))))
            for b in range(buckets)]
    rows = []
    for i, text in docs:
        f, words = features(text, n)
        weight = sum(gain[zlib.crc32(x) % buckets] for x in f) // len(f) if f else 0
        h = int(sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + .5) / 2 ** 32))), words])
    fit = sorted((r for r in rows if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = {id(r): k for k, r in enumerate(fit[:len(fit) * percent // 100], 1)}
    return [(*r[:4], rank.get(id(r))) for r in rows]


def got(spark, docs, target, **how):
    how = {"buckets": 50, "min_words": 3, "percent": 40} | how
    d = spark.createDataFrame(docs, "doc_id long, text string")
    t = spark.createDataFrame([(x,) for x in target], "text string")
    cols = ["doc_id", "n_features", "weight", "score", "rank"]
    return [tuple(r) for r in I.resample(d, t, **how).select(*cols).collect()]


def none_last(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


DOCS = [(1, "Alpha beta\ngamma alpha"), (2, None), (3, ""), (4, "the same line\nthe same line\nother ÄÖ line"),
        (5, "the same line\n\n\nthe same line"), (6, "x"), (7, "n0 n1-n2_n3\tn4 \x01 n5"), (None, "a b c d"),
        (8, "w" * 200 + " " + "v" * 64 + " " + "u" * 65), (9, "\n\n"), (10, "Alpha beta\ngamma alpha")]


@pytest.mark.parametrize("n", [1, 2, 4])
def test_equals_the_plain_version(spark, n):
    target = ["alpha beta gamma", None, "", "line the same"]
    assert none_last(got(spark, DOCS, target, n=n)) == none_last(plain(DOCS, target, n))


def test_crossing_grams_in_pieces(monkeypatch):
    monkeypatch.setattr(I, "BLOCK_BYTES", 64)
    rng = np.random.default_rng(1)
    text = "".join(rng.choice([" ", "\n", "ab", "c" * 90, "Déf", "  "], 900))
    for n in (1, 3):
        want = Counter(zlib.crc32(f) % 97 for f in features(text, n)[0])
        have = Counter(b for _, bucket, _ in I.grams(pa.array([text]), n, 97) for b in bucket.tolist())
        assert have == want
        crossing = sum(len(b) for _, b, _ in I.grams(pa.array([text]), n, 97, crossing=True))
        inside = sum(len(features(line, n)[0]) for line in text.split("\n"))
        assert crossing == sum(want.values()) - inside


def test_empty_tables(spark):
    assert got(spark, [], ["alpha"]) == []
    assert none_last(got(spark, DOCS, [])) == none_last(plain(DOCS, []))


def test_other_columns_and_repeated_rows(spark):
    rows = [(1, "one two three four", 5, "l", "b"), (1, "one two three four", 5, "l", "b"), (2, "five six seven", 1, "", "")]
    d = spark.createDataFrame(rows, "doc_id long, text string, score int, line string, bucket string")
    out = I.resample(d, d.select("text"), percent=100, min_words=1).collect()
    assert sorted(r.rank for r in out) == [1, 2, 3]
    assert len({(r.weight, r.score) for r in out if r.doc_id == 1}) == 1


def test_a_long_text(spark):
    text = "word " * 600_000 + "\n" + "tail" * 500_000
    rows = got(spark, [(1, text), (2, "word")], ["word"], min_words=0)
    assert {r[0]: r[1] for r in rows} == {1: 600_001, 2: 1}
