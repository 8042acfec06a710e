"""Substring deduplication against a plain version, and its defined cases."""

from hashlib import sha256

import numpy as np
import pytest

from loamflow.llm import repeats as R


def plain(docs, length):
    """docs: bytes in corpus order."""
    seen, out = set(), []
    for text in docs:
        gone = np.zeros(len(text), bool)
        for p in range(len(text) - length + 1):
            s = text[p:p + length]
            if s in seen:
                gone[p:p + length] = True
            seen.add(s)
        kept = bytes(b for b, g in zip(text, gone) if not g)
        runs = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
        out.append((len(text), int(gone.sum()), runs, sha256(kept).hexdigest()))
    return out


def got(spark, rows, length, trigger, **how):
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted(tuple(r) for r in R.remove_repeats(d, length, trigger, **how).collect())


@pytest.mark.parametrize("seed", range(4))
def test_equals_the_plain_version(spark, seed):
    rng = np.random.default_rng(seed)
    letters = [list("ab"), list("abcé"), list("ab cdefg"), ["x"]][seed]
    parts = ["".join(rng.choice(letters, rng.integers(1, 60))) for _ in range(12)]
    rows = [(int(i), "".join(rng.choice(parts, rng.integers(0, 6)))) for i in rng.permutation(40)]
    want = plain([(t or "").encode() for _, t in sorted(rows)], 20)
    assert got(spark, rows, 20, 7) == [(i, *w) for i, w in enumerate(want)]


def test_ids_null_or_repeated(spark):
    line = "a line that is long enough to count as repeated"
    rows = [(None, line), (5, line), (5, line), (5, None), (6, ""), (None, "short"), (7, line + line)]
    out = R.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 30, 8).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in out) == sorted(
        [(0, 47, 0), (5, 47, 47), (5, 47, 47), (5, 0, 0), (6, 0, 0), (0, 5, 0), (7, 94, 94)])


def test_pieces_of_a_long_text(spark, monkeypatch):
    rng = np.random.default_rng(9)
    text = bytes(rng.choice(list(b"abcdefgh"), 900))
    raw, off = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    monkeypatch.setattr(R, "BLOCK_BYTES", 128)
    row, start, n, code, _ = R.phrases(raw, off, 40, 9)
    assert start.tolist() == (np.cumsum(n) - n).tolist() and n.sum() == len(text) - 39
    at = np.arange(len(text) - 39)
    codes = R.string_codes(raw, at, 40)
    monkeypatch.undo()
    assert (codes == R.string_codes(raw, at, 40)).all()


def test_whole_copies_and_kept_text(spark):
    text = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(4000))
    rows = [(1, text[:2000]), (2, text), (3, text), (4, text[100:] + "!")]
    d = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in rows], "doc_id long, text string, row int, place int, code int")
    out = {r.doc_id: r for r in R.remove_repeats(d, with_text=True).collect()}
    want = plain([t.encode() for _, t in rows], 100)
    for (i, t), w in zip(rows, want):
        r = out[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == w
        assert sha256(r.kept).hexdigest() == w[3]
        assert sum(e - s for s, e in zip(r.starts, r.ends)) == w[1]


def test_empty_table(spark):
    assert got(spark, [], 100, 32) == []


def test_a_long_text(spark):
    text = "".join(chr(97 + c) for c in np.random.default_rng(2).integers(0, 26, 1_200_000))
    out = got(spark, [(1, text), (2, "z" + text)], 100, 32)
    assert out[0][1:4] == (1_200_000, 0, 0) and out[1][1:4] == (1_200_001, 1_200_000, 1)
