"""Whitening of embeddings on their leading principal components, by Jacobi-Davidson.

The covariance is never formed. Its product with a few vectors is one Spark pass: each task
centres its rows and adds up ``(x - mean) ((x - mean) . u)``, and Spark sums the partial
products. On the driver lie only d-vectors: a search space that grows by corrections
``t`` with ``(I - QQ')(A - theta I)(I - QQ') t = -r``, each solved by some steps of MINRES (all
corrections of a round in step, so that one pass serves them together), with Rayleigh-Ritz
on the space. A pair whose residual has reached rounding level is locked: it gets no more
corrections and stays in the space and in the projection.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
#: MINRES steps of a correction, and rounds after which the solver gives up.
INNER_STEPS, MAX_ROUNDS = 6, 300
#: A component whose variance is below this share of the whole is rounding noise.
NOISE = 1e-12


def _rows(batch: pa.RecordBatch, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(index in the batch, x-vector) of every usable row: an embedding of ``dims`` finite
    entries, none null."""
    col = batch.column(batch.num_columns - 1)
    whole = pc.fill_null(pc.equal(pc.list_value_length(col), dims), False)
    at = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
    entries = col.filter(whole).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    c = entries.reshape(len(at), dims)  # a null entry has become NaN
    good = np.isfinite(c).all(axis=1)
    return at[good], np.floor(SCALE * c[good]).astype(np.int64) + SHIFT


def dimensions(vectors: DataFrame) -> int:
    """The commonest length of an embedding (of two, the greater): 0 if there is none."""
    row = (vectors.select(F.size("embedding").alias("dims")).where("dims > 0").groupBy("dims").count()
           .orderBy(F.desc("count"), F.desc("dims")).first())
    return row.dims if row else 0


def _summed(vectors: DataFrame, dims: int, per_batch: Callable[[np.ndarray], np.ndarray], size: int,
            kind: str = "double") -> np.ndarray:
    """Sum over all batches of x-vectors of what ``per_batch`` makes of one, ``size`` numbers:
    added up within each task, then position by position by Spark."""
    def run(batches):
        total = np.zeros(size, np.int64 if kind == "long" else np.float64)
        for batch in batches:
            _, x = _rows(batch, dims)
            if len(x):
                total += per_batch(x)
        yield pa.RecordBatch.from_arrays([pa.array([total])], ["part"])

    parts = map_arrow(vectors, run, f"part array<{kind}>")
    sums = parts.select(F.posexplode("part").alias("pos", "v")).groupBy("pos").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(size, np.int64 if kind == "long" else np.float64)
    out[sums["pos"].to_numpy()] = sums["v"].to_numpy()
    return out


def minres(apply: Callable[[np.ndarray], np.ndarray], b: np.ndarray, steps: int) -> np.ndarray:
    """``steps`` of MINRES on every column of ``b`` together: ``apply`` takes all the columns' next
    Lanczos vectors at once. A column that is solved exactly stands still."""
    x = np.zeros_like(b)
    beta = np.linalg.norm(b, axis=0)
    eta, live = beta.copy(), beta > 0
    v = np.divide(b, beta, out=np.zeros_like(b), where=live)
    old_v, w, old_w = (np.zeros_like(b) for _ in range(3))
    beta = np.zeros_like(eta)
    c, old_c, s, old_s = np.ones_like(eta), np.ones_like(eta), np.zeros_like(eta), np.zeros_like(eta)
    for _ in range(steps):
        if not live.any():
            break
        p = apply(v) - beta * old_v
        alpha = (v * p).sum(axis=0)
        p -= alpha * v
        after = np.linalg.norm(p, axis=0)
        turned = c * alpha - old_c * s * beta
        rho = np.hypot(turned, after)
        live &= rho > 0
        safe = np.where(rho > 0, rho, 1)
        new_w = np.where(live, (v - (old_s * beta) * old_w - (s * alpha + old_c * c * beta) * w) / safe, 0)
        old_c, c = c, np.where(live, turned / safe, 1)
        old_s, s = s, np.where(live, after / safe, 0)
        x += np.where(live, c * eta, 0) * new_w
        eta = np.where(live, -s * eta, 0)
        old_w, w = w, new_w
        live &= after > 1e-300
        old_v, v = v, np.divide(p, after, out=np.zeros_like(p), where=live)
        beta = after
    return x


def _orthonormal(new: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Orthonormal columns that span what ``new`` adds to ``basis``."""
    out = np.empty((len(new), 0))
    for v in new.T:
        size = np.linalg.norm(v)
        if not size:
            continue
        v = v / size
        for _ in range(3):
            for q in (basis, out):
                v = v - q @ (q.T @ v)
        left = np.linalg.norm(v)
        if left > 1e-10:
            out = np.column_stack([out, v / left])
    return out


def jacobi_davidson(apply: Callable[[np.ndarray], np.ndarray], dims: int, wanted: int,
                    steps: int = INNER_STEPS) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` greatest eigenvalues (falling) and unit eigenvectors (columns) of a
    symmetric positive semi-definite operator of size ``dims``, known by ``apply`` on a block of
    vectors only. Ends when every residual is at rounding level of the greatest eigenvalue,
    or when the search space is the whole space."""
    wanted = min(wanted, dims)
    most = max(8 * wanted, 32)
    start = np.random.default_rng(13).standard_normal((dims, min(dims, 2 * wanted)))
    basis = _orthonormal(start, np.empty((dims, 0)))
    image = apply(basis)
    for _ in range(MAX_ROUNDS):
        small = basis.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        value, u = theta[:wanted], basis @ turn[:, :wanted]
        r = image @ turn[:, :wanted] - u * value
        top = max(abs(theta[0]), np.finfo(float).tiny)
        locked = np.linalg.norm(r, axis=0) <= 32 * np.sqrt(dims) * np.finfo(float).eps * top
        if locked.all() or basis.shape[1] == dims:
            return np.maximum(value, 0), np.linalg.qr(u)[0]
        if most < dims and basis.shape[1] + int((~locked).sum()) > most:  # keep the best part of the space
            keep = turn[:, :3 * wanted]
            basis, image = basis @ keep, image @ keep
        shift = value[~locked]

        def projected(t: np.ndarray) -> np.ndarray:
            t = t - u @ (u.T @ t)
            t = apply(t) - shift * t
            return t - u @ (u.T @ t)

        new = _orthonormal(minres(projected, -r[:, ~locked], steps), basis)
        if not new.shape[1]:  # corrections that add nothing: any new directions
            fresh = np.random.default_rng(basis.shape[1]).standard_normal((dims, wanted))
            new = _orthonormal(fresh, basis)[:, :dims - basis.shape[1]]
        basis, image = np.column_stack([basis, new]), np.column_stack([image, apply(new)])
    raise ArithmeticError(f"residuals above rounding level after {MAX_ROUNDS} rounds")


def whiten(vectors: DataFrame, components: int = COMPONENTS, key: str = "vec_id",
           embedding: str = "embedding") -> DataFrame:
    """Whitened leading components of every usable embedding: ``key`` (as long), component (from
    1, by falling eigenvalue), n, deviation (decimal(38, 0), exact), whitened, explained,
    identity_error.

    Dropped are rows whose embedding is null, holds null or non-finite entries, or isn't of the
    commonest length. Null and repeated keys stay, row by row; repeated vectors count as often
    as they occur. Components without variance (fewer vectors than components, constant
    entries) are left out, so equal vectors give no rows; an empty table gives none. Other
    columns aren't read. An entry x becomes the whole number floor(1024 x) + 100000; the mean
    is exact sums over n, and rows are centred before any product."""
    vectors = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"))
    out_schema = ("vec_id long, component int, n long, deviation decimal(38,0), whitened double, "
                  "explained double, identity_error double")
    dims = dimensions(vectors)
    nothing = vectors.sparkSession.createDataFrame([], out_schema)
    if not dims:
        return nothing
    bare = vectors.select("embedding")
    sums = _summed(bare, dims, lambda x: np.append(x.sum(axis=0), len(x)), dims + 1, "long")
    n, sums = int(sums[-1]), sums[:-1]
    if not n:
        return nothing
    mean = sums / n

    def covariance(u: np.ndarray) -> np.ndarray:
        def product(x):
            y = x - mean
            return (y.T @ (y @ u)).ravel()
        return _summed(bare, dims, product, u.size).reshape(u.shape) / n

    trace = float(_summed(bare, dims, lambda x: np.square(x - mean).sum(keepdims=True).ravel(), 1)[0]) / n
    if not trace:
        return nothing
    value, vector = jacobi_davidson(covariance, dims, components)
    real = value > NOISE * trace
    value, vector = value[real], vector[:, real]
    k = len(value)
    if not k:
        return nothing
    rows = vector / np.sqrt(value)  # x - mean times these gives the whitened values

    def moments(x):
        y = (x - mean) @ rows
        return np.concatenate([y.sum(axis=0), (y.T @ y).ravel()])
    got = _summed(bare, dims, moments, k + k * k) / n
    error = float(np.abs(got[k:].reshape(k, k) - np.outer(got[:k], got[:k]) - np.eye(k)).max())
    explained = value / trace
    return map_arrow(vectors, _project(dims, n, sums, mean, rows, explained, error), out_schema)


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    d = n * x - sums
    if len(d) and int(np.abs(d).max()) ** 2 * d.shape[1] >= 1 << 62:  # beyond 64 bits: Python's integers
        return pa.array([sum(v * v for v in row) for row in d.tolist()], pa.decimal128(38, 0))
    return pa.array((d * d).sum(axis=1)).cast(pa.decimal128(38, 0))


def _project(dims, n, sums, mean, rows, explained, error):
    k = rows.shape[1]

    def run(batches):
        for batch in batches:
            at, x = _rows(batch, dims)
            m = len(at)
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(at)).take(each), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                pa.array(np.full(m * k, n), pa.int64()), _deviations(x, n, sums).take(each),
                pa.array(((x - mean) @ rows).ravel()), pa.array(np.tile(explained, m)),
                pa.array(np.full(m * k, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run
