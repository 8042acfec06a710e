import hashlib
import random

import numpy as np
import pyarrow as pa
from loamflow.llm import chunking as C

DOCS = "doc_id long, text string, lang string, range int, key string, guard string"


def slow_chunks(data: bytes):
    out, a = [], 0
    while a < len(data):
        end = min(a + C.MAX_SIZE, len(data))
        for i in range(a + C.MIN_SIZE - 1, end):
            h = 0
            for b in data[max(0, i - 31):i + 1]:
                h = ((h << 1) + int(C.GEAR[b])) & 0xFFFFFFFF
            bits = C.HARD_BITS if i - a < C.NORMAL_SIZE - 1 else C.EASY_BITS
            if h >> (32 - bits) == 0:
                end = i + 1
                break
        out.append((a, end))
        a = end
    return out


def text(rnd, n):
    return "".join(rnd.choice("abcdefgh éß\n") for _ in range(n))


def test_chunks_match_the_plain_loop_whatever_stands_before():
    rnd = random.Random(1)
    texts = [text(rnd, n) for n in (0, 1, 15, 16, 17, 40, 64, 65, 300, 3000, 0, 5, 1200)]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.cumsum([0] + [len(t.encode()) for t in texts])
    s, e, d = C.chunk_spans(raw, off)
    got = [[] for _ in texts]
    for a, b, i in zip(s.tolist(), e.tolist(), d.tolist()):
        got[i].append((a - int(off[i]), b - int(off[i])))
    assert got == [slow_chunks(t.encode()) for t in texts]


def test_shift_resistance():
    rnd = random.Random(2)
    t = text(rnd, 20_000)
    a, b, other = C.fingerprints(pa.array([t, "inserted " + t[:9000] + "x" + t[9000:], text(rnd, 20_000)]))
    assert C.containment(a, b) > 0.95 and C.containment(a, other) < 0.05
    assert C.containment(a, a) == 1 and C.containment(a[:0], a[:0]) == 1 and C.containment(a, a[:0]) == 0


def rows_by_hand(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    texts = [r[1] or "" for r in rows]
    for (i, _), t, nxt in zip(rows, texts, texts[1:] + texts[:1]):
        new = t[:len(t) - len(t) // 4] + nxt[:len(t) // 4]
        a, b, c = C.fingerprints(pa.array([t, new, nxt]))
        yield (i, len(t), hashlib.sha256(new.encode()).hexdigest(), C.packed(a), C.packed(b),
               C.containment(a, b), C.containment(a, c))


def test_neighbours_over_ranges_ties_nulls(spark):
    rnd = random.Random(3)
    rows = [(rnd.randrange(-50, 4000), text(rnd, rnd.choice([0, 3, 50, 400]))) for _ in range(700)]
    rows += [(7, "same")] * 3 + [(None, "no id"), (None, None), (5000, None), (4001, text(rnd, 60_000))]
    df = spark.createDataFrame([(*r, "en", 1, "k", "g") for r in rows], DOCS).repartition(5)
    order = lambda rs: sorted(rs, key=lambda r: (r[0] is not None, r[0] or 0, r))
    got = order(tuple(r) for r in C.compare_with_next(df).collect())
    key = lambda rs: sorted(str(r) for r in rs)
    assert key(got) == key(rows_by_hand(rows))


def test_one_document_and_none(spark):
    one = spark.createDataFrame([(1, "abcdefgh", "en", 1, "", "")], DOCS)
    [r] = C.compare_with_next(one).collect()
    assert r.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and r.near_next == 1.0
    assert C.compare_with_next(one.limit(0)).collect() == []
    [f] = C.fingerprint_documents(one).collect()
    assert f.fingerprint == r.fingerprint and f.n_chars == 8
