"""Toxicity: a character n-gram linear classifier whose indicators are scaled by naive Bayes
log-count ratios, trained on labelled text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import nbsvm
from .common import keyed_text

THRESHOLD = 0.3
SIZES = (4, 5, 6, 7)


def score_toxicity(docs: DataFrame, labels: DataFrame, sample: int = nbsvm.SAMPLE_ROWS,
                   threshold: float = THRESHOLD, sizes: tuple[int, ...] = SIZES) -> DataFrame:
    """doc_id, held_out, score, predicted of every whole text of ``docs`` (doc_id, text).

    Labels are learnt from rows not held out only. A null text counts as empty; an empty text
    gets the score of no features; repeated rows get equal scores; a null id is scored and is
    no training row. Without labels of both kinds all scores are equal."""
    features = nbsvm.char_ngrams(sizes)
    texts = keyed_text(docs)
    model = nbsvm.fit(texts, nbsvm.training_labels(labels, "toxic"), features, sample)
    return nbsvm.score(texts, model, features).select(
        "doc_id", nbsvm.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
