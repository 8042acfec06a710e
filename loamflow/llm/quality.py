"""Quality classifier: Naive Bayes support vectors over word and word-shape n-grams.

A word's shape keeps what markup, shouting and repetition change: letter case, digits, the
symbols it ends with, a length class, and whether it repeats the word before it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import nbsvm
from .common import LOWER, keyed_text, word_hashes, word_spans

THRESHOLD = 0.7
_UPPER, _DIGIT, _SYMBOL, _ALPHA = (np.zeros(256, bool) for _ in range(4))
_UPPER[65:91] = True
_DIGIT[48:58] = True
_ALPHA[65:91] = _ALPHA[97:123] = _ALPHA[128:] = True
_SYMBOL[33:128] = True
_SYMBOL &= ~(_ALPHA | _DIGIT)


def shapes(raw: np.ndarray, s: np.ndarray, e: np.ndarray, word: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """A small code of each word's shape."""
    def count(lut):
        run = np.zeros(len(raw) + 1, np.int32)
        np.cumsum(lut[raw], out=run[1:])
        return run[e] - run[s]
    size = (e - s).astype(np.int32)
    upper, digit, symbol, alpha = count(_UPPER), count(_DIGIT), count(_SYMBOL), count(_ALPHA)
    again = np.zeros(len(s), bool)
    again[1:] = (word[1:] == word[:-1]) & (doc[1:] == doc[:-1])
    last, first = raw[e - 1].astype(np.int32), raw[s]
    tail = np.where(_SYMBOL[last], last, 0)
    case = np.where(upper == 0, 0, np.where((upper == 1) & _UPPER[first], 1, np.where(upper == alpha, 2, 3)))
    code = np.minimum(symbol, 4) + 5 * (case + 4 * (np.minimum(digit, 2) + 3 * (
        again + 2 * ((size > 24).astype(np.int32) + 2 * ((alpha == 0) + 2 * tail)))))
    return code.astype(np.uint64) + np.uint64(1)


def features(raw: np.ndarray, off: np.ndarray, keep: np.ndarray | None = None) -> np.ndarray:
    """Words (A-Z lowered), and runs of one to three word shapes."""
    s, e, doc = word_spans(raw, off)
    word = word_hashes(LOWER[raw], s, e)
    shape = shapes(raw, s, e, word, doc) if len(s) else word
    keys = [nbsvm.hashed((word >> np.uint64(32)).astype(np.uint32), doc, keep)]
    for n in (1, 2, 3):
        m = len(s) - n + 1
        if m > 0:
            h = np.full(m, 0x9E37 + n, np.uint64)
            for j in range(n):
                h = h * np.uint64(0x100000001B3) + shape[j:j + m]
            h = h * np.uint64(0xD6E8FEB86659FD93)
            inside = doc[:m] == doc[n - 1:]
            keys.append(nbsvm.hashed((h >> np.uint64(32)).astype(np.uint32)[inside], doc[:m][inside], keep))
    return nbsvm.distinct(keys)


def score_quality(docs: DataFrame, labels: DataFrame, sample: int = nbsvm.SAMPLE_ROWS,
                  threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every whole text of ``docs`` (doc_id, text).

    Labels are learnt from rows not held out only. A null text counts as empty; an empty text
    gets the score of no features; repeated rows get equal scores; a null id is scored and is
    no training row. Without labels of both kinds all scores are equal."""
    texts = keyed_text(docs)
    model = nbsvm.fit(texts, nbsvm.training_labels(labels, "quality"), features, sample)
    return nbsvm.score(texts, model, features).select(
        "doc_id", nbsvm.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = nbsvm.SAMPLE_ROWS,
              threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores at least ``threshold``."""
    model = nbsvm.fit(keyed_text(docs), nbsvm.training_labels(labels, "quality"), features, sample)
    return nbsvm.keep_scoring(docs, model, features, threshold)
