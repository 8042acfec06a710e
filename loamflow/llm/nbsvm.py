"""Naive Bayes support vectors: n-gram indicators scaled by class log-count ratios, then a
linear hinge-loss model by dual coordinate descent, with a logistic calibration.

* Counts: all labelled training rows, in Spark (each task sums its own counts, one shuffle by
  feature adds them); the table has 2**BITS features whatever the corpus. Features whose
  counts don't tell the classes apart (log-likelihood ratio test) get the ratio 0; all others
  are kept.
* Fit: a bounded sample of labelled rows (``sample`` rows by smallest hash of the id), as
  hashed features in gaps of a byte or a few; three quarters fit the hinge-loss model, the
  rest its calibration.
* Score: one pass over every whole text with the 2**BITS weights.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, blocks, map_arrow, materialize, semi_join_text

BITS = 20
N_FEATURES = 1 << BITS
#: Rows of a block, so that (row, feature) fits 32 bits.
MAX_ROWS = 1 << (31 - BITS)
SAMPLE_ROWS = 8_000
#: Least log-likelihood ratio statistic of a feature (16: four standard deviations).
MIN_G2 = 16.0
SMOOTHING = 1.0
C = 0.05
EPOCHS = 30
#: The share of ids whose labels are learnt from: crc32(id as text) mod FOLDS is not HELD_OUT.
FOLDS, HELD_OUT = 4, 2

#: (bytes, offsets, keep) -> distinct (row << BITS | feature) of a block of texts, ascending;
#: where ``keep`` is given, of the features it marks only.
Features = Callable[[np.ndarray, np.ndarray, np.ndarray | None], np.ndarray]


def held_out(doc_id: Column) -> Column:
    """Whether a row's label is kept from training; a null id counts as the empty string."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def hashed(h: np.ndarray, rows: np.ndarray, keep: np.ndarray | None) -> np.ndarray:
    """Keys of the features of hashes ``h`` (32 bits) in rows ``rows``."""
    h = h ^ (h >> np.uint32(15))
    h = h * np.uint32(0x85EBCA6B)
    h = (h ^ (h >> np.uint32(13))) >> np.uint32(32 - BITS)
    if keep is not None:
        at = keep[h]
        h, rows = h[at], rows[at]
    return (rows.astype(np.uint32) << np.uint32(BITS)) | h


def distinct(keys: list[np.ndarray]) -> np.ndarray:
    k = np.sort(np.concatenate(keys)) if keys else np.empty(0, np.uint32)
    return k[np.append(True, k[1:] != k[:-1])] if len(k) else k


def char_ngrams(sizes: tuple[int, ...]) -> Features:
    """Byte n-grams of the text with A-Z lowered; none crosses two texts."""
    def features(raw: np.ndarray, off: np.ndarray, keep: np.ndarray | None = None) -> np.ndarray:
        low = LOWER[raw].astype(np.uint32) + np.uint32(1)
        row = np.repeat(np.arange(len(off) - 1, dtype=np.uint32), np.diff(off))
        keys = []
        for n in sizes:
            m = len(low) - n + 1
            if m <= 0:
                continue
            h = np.full(m, n, np.uint32)
            for j in range(n):
                h = h * np.uint32(0x01000193) + low[j:j + m]
            inside = row[:m] == row[n - 1:]
            keys.append(hashed(h[inside], row[:m][inside], keep))
        return distinct(keys)
    return features


def featured(features: Features):
    """(row, row's features) over Arrow batches of (…, text): yields (batch, first row, end row,
    keys) with the rows of keys counted from the first row."""
    def run(batch: pa.RecordBatch, keep: np.ndarray | None = None):
        for a, b, raw, off in blocks(batch.column("text")):
            for c in range(a, b, MAX_ROWS):
                d = min(b, c + MAX_ROWS)
                base = off[c - a]
                yield c, d, features(raw[base:off[d - a]], off[c - a:d - a + 1] - base, keep)
    return run


@dataclass
class Model:
    """Score of a text: logistic(slope * (bias + sum of its features' weights) + offset)."""
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def margins(self, keys: np.ndarray, n: int) -> np.ndarray:
        w = self.weights[keys & np.uint32(N_FEATURES - 1)]
        return self.bias + np.bincount(keys >> np.uint32(BITS), w, n)[:n]

    def scores(self, keys: np.ndarray, n: int) -> np.ndarray:
        return logistic(self.slope * self.margins(keys, n) + self.offset)


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def count_features(labelled: DataFrame, features: Features) -> tuple[np.ndarray, np.ndarray]:
    """For each feature the number of texts of label 0 and of label 1 that hold it; over all
    rows of ``labelled`` (label, text)."""
    run = featured(features)

    def count(batches):
        n = np.zeros((2, N_FEATURES), np.int64)
        for batch in batches:
            label = batch.column("label").to_numpy(zero_copy_only=False)
            for a, b, keys in run(batch):
                one = label[a:b][keys >> np.uint32(BITS)] == 1
                f = keys & np.uint32(N_FEATURES - 1)
                n[1] += np.bincount(f[one], minlength=N_FEATURES)
                n[0] += np.bincount(f[~one], minlength=N_FEATURES)
        at = np.flatnonzero(n.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[0, at]), pa.array(n[1, at])],
                                         ["feature", "zero", "one"])

    got = (map_arrow(labelled.select("label", "text"), count, "feature int, zero long, one long")
           .groupBy("feature").agg(F.sum("zero").alias("zero"), F.sum("one").alias("one")).toArrow())
    out = np.zeros((2, N_FEATURES), np.int64)
    at = got["feature"].to_numpy()
    out[0, at], out[1, at] = got["zero"].to_numpy(), got["one"].to_numpy()
    return out[0], out[1]


def log_count_ratios(zero: np.ndarray, one: np.ndarray, zeros: int, ones: int,
                     smoothing: float = SMOOTHING, min_g2: float = MIN_G2) -> np.ndarray:
    """log(p/|p|) - log(q/|q|) of the smoothed counts; 0 for features below ``min_g2``."""
    p, q = one + smoothing, zero + smoothing
    r = np.log(p / p.sum()) - np.log(q / q.sum())
    n, seen = max(zeros + ones, 1), zero + one

    def part(have, total):
        want = have * 0.0 + total
        return np.where(have > 0, have * np.log(np.maximum(have, 1e-9) / np.maximum(want, 1e-9)), 0.0)
    g2 = 2 * (part(one, seen * ones / n) + part(zero, seen * zeros / n)
              + part(ones - one, (n - seen) * ones / n) + part(zeros - zero, (n - seen) * zeros / n))
    return np.where(g2 >= min_g2, r, 0.0)


def packed(f: np.ndarray) -> bytes:
    """Ascending features as gaps: a byte 255 for each 255 of a gap, then the rest as one byte."""
    gap = np.diff(f.astype(np.int64), prepend=0)
    out = np.full(int((gap // 255 + 1).sum()), 255, np.uint8)
    out[np.cumsum(gap // 255 + 1) - 1] = gap % 255
    return out.tobytes()


def unpacked(gaps: bytes) -> np.ndarray:
    step = np.frombuffer(gaps, np.uint8)
    return np.cumsum(step, dtype=np.int64)[step != 255]


class Rows:
    """(features, values) of packed rows, unpacked when asked for; a feature's value is its ratio."""

    def __init__(self, gaps: list[bytes], r: np.ndarray):
        self.gaps, self.r = gaps, r

    def __len__(self) -> int:
        return len(self.gaps)

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        if i >= len(self.gaps):
            raise IndexError(i)
        f = unpacked(self.gaps[i])
        return f, self.r[f]


def sample_features(docs: DataFrame, known: DataFrame, features: Features, rows: int,
                    keep: np.ndarray) -> list[tuple[int, bytes]]:
    """(label, packed kept features) of the texts of the ``rows`` training ids of smallest hash."""
    run = featured(features)
    shared = docs.sparkSession.sparkContext.broadcast(keep)

    def emit(batches):
        for batch in batches:
            for a, b, keys in run(batch, shared.value):
                cut = np.searchsorted(keys >> np.uint32(BITS), np.arange(b - a + 1))
                f = keys & np.uint32(N_FEATURES - 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("label").slice(a, b - a),
                     pa.array([packed(f[cut[i]:cut[i + 1]]) for i in range(b - a)], pa.binary())], ["label", "f"])

    # ids alone are ranked; only the chosen texts are featured
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    got = map_arrow(semi_join_text(docs, chosen).select("label", "text"), emit, "label int, f binary").toArrow()
    return sorted(zip(got["label"].to_pylist(), got["f"].to_pylist()))


def dual_coordinate_descent(x: Sequence[tuple[np.ndarray, np.ndarray]], y: np.ndarray, cost: np.ndarray,
                            epochs: int = EPOCHS, seed: int = 1) -> tuple[np.ndarray, float]:
    """L2-regularised squared hinge loss: minimise |w|^2/2 + sum cost * max(0, 1 - y(wx+b))^2 over
    rows ``x`` of (features, values); the bias is the weight of a feature that is always 1."""
    w, bias = np.zeros(N_FEATURES), 0.0
    alpha, diag = np.zeros(len(y)), 0.5 / cost
    q = np.array([float(v @ v) + 1.0 for _, v in x]) + diag
    rnd = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in rnd.permutation(len(y)):
            f, v = x[i]
            g = y[i] * (float(w[f] @ v) + bias) - 1 + diag[i] * alpha[i]
            new = max(0.0, alpha[i] - g / q[i])
            step = (new - alpha[i]) * y[i]
            if step:
                worst = max(worst, abs(g))
                w[f] += step * v
                bias += step
                alpha[i] = new
        if worst < 1e-3:
            break
    return w, bias


def calibrate(margin: np.ndarray, one: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of the logistic curve through (margin, label), by Newton's method with a
    little ridge and smoothed targets, so that separable margins give finite values."""
    hi, lo = (one.sum() + 1) / (one.sum() + 2), 1 / ((~one).sum() + 2)
    t = np.where(one, hi, lo)
    x = np.stack([margin, np.ones(len(margin))], 1)
    b = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = logistic(x @ b)
        grad = x.T @ (p - t) + 1e-3 * (b - [1.0, 0.0])
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-3 * np.eye(2), grad)
        b = b - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(b[0], 1e-3)), float(b[1])


def fit(docs: DataFrame, labels: DataFrame, features: Features, sample: int = SAMPLE_ROWS, c: float = C) -> Model:
    """Train on the texts of ``docs`` (doc_id, text) with a row in ``labels`` (doc_id, label 0 or 1;
    one row an id). Without texts of both labels the model gives the smoothed share of label 1
    to every text."""
    known = materialize(labels, "training-ids")
    zero, one = count_features(semi_join_text(docs, known), features)
    n = dict(docs.select("doc_id").join(known, "doc_id").groupBy("label").count().collect())
    r = log_count_ratios(zero, one, n.get(0, 0), n.get(1, 0))
    rows = sample_features(docs, known, features, sample, r != 0)
    y = np.array([1.0 if label == 1 else -1.0 for label, _ in rows])
    share = ((y > 0).sum() + 1) / (len(y) + 2)
    prior = Model(np.zeros(N_FEATURES, np.float32), 0.0, 1.0, float(np.log(share / (1 - share))))
    if len(set(y.tolist())) < 2:
        return prior
    x = [gaps for _, gaps in rows]
    part = np.random.default_rng(0).permutation(len(y)) % 4
    train, rest = np.flatnonzero(part > 0), np.flatnonzero(part == 0)
    if len(set(y[train].tolist())) < 2:
        return prior
    cost = np.where(y > 0, c * len(y) / (2 * (y > 0).sum()), c * len(y) / (2 * (y < 0).sum()))
    w, bias = dual_coordinate_descent(Rows([x[i] for i in train], r), y[train], cost[train])
    margin = np.array([float(w[f] @ v) + bias for f, v in Rows([x[i] for i in rest], r)])
    slope, offset = calibrate(margin, y[rest] > 0)
    return Model((w * r).astype(np.float32), bias, slope, offset)


def training_labels(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, label) of the training ids: labelled 0 or 1, not held out. Rows that repeat an id
    with one label count once; an id labelled both ways is no training row."""
    return (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
            .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most"))
            .where("label = most").drop("most"))


def score(docs: DataFrame, model: Model, features: Features) -> DataFrame:
    """doc_id, score of every whole text of ``docs`` (doc_id, text)."""
    run = featured(features)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS weights

    def emit(batches):
        m = shared.value
        keep = m.weights != 0
        for batch in batches:
            got = [m.scores(keys, b - a) for a, b, keys in run(batch, keep)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.concatenate(got) if got else np.empty(0))], ["doc_id", "score"])
    return map_arrow(docs, emit, "doc_id long, score double")


def keep_scoring(docs: DataFrame, model: Model, features: Features, threshold: float) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores at least ``threshold``; no shuffle."""
    run = featured(features)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS weights

    def emit(batches):
        m = shared.value
        keep = m.weights != 0
        for batch in batches:
            got = [m.scores(keys, b - a) for a, b, keys in run(batch, keep)]
            if got:
                yield batch.filter(pa.array(np.concatenate(got) >= threshold))
    return map_arrow(docs, emit, docs.schema)
