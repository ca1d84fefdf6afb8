"""Whitening of embeddings by spectral divide and conquer.

The covariance is summed over blocks of rows in the cluster; only sums per dimension and per pair of
dimensions reach the driver. There QDWH (the dynamically weighted Halley iteration) gives the
orthogonal polar factor of the shifted covariance, hence the projector on the eigenvectors above the
shift; the space splits in two invariant subspaces, and each is split again until single components
remain. The projection is broadcast (dimensions x components doubles) and applied where the vectors are.

Vectors are whole numbers x = floor(64 c) + 1000000, so that sums are exact: rows are centred on the
whole part of the mean before they are multiplied, and the rest of the mean, less than one, enters as a
fraction. The covariance then does not depend on how rows are dealt out.
"""

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from pressmill.llm.common import keep

SCALE, OFFSET = 64, 1_000_000
LIMIT = 2.0**60  # entries of x are held to this size (embeddings are nowhere near it)
EXACT = 2**53
EPS = np.finfo(float).eps


# --- polar decomposition and divide and conquer (d x d matrices, on the driver) ---------------------------

def polar(a):
    """The orthogonal polar factor of the symmetric matrix ``a`` by QDWH: QR steps while the weights are
    large, Cholesky-type solves after. Singular directions of ``a`` come out between -1 and 1."""
    n = len(a)
    x = a / max(np.linalg.norm(a, 1), np.finfo(float).tiny)  # the 1-norm bounds the spectral norm
    try:
        low = min(max(0.9 / np.linalg.norm(np.linalg.inv(x), 1), EPS), 1.0)  # a bound on the smallest singular value
    except np.linalg.LinAlgError:
        low = EPS
    eye = np.eye(n)
    for _ in range(12):
        square = low * low
        g = np.cbrt(4.0 * (1.0 - square) / (square * square))
        root = np.sqrt(1.0 + g)
        wa = root + 0.5 * np.sqrt(max(8.0 - 4.0 * g + 8.0 * (2.0 - square) / (square * root), 0.0))
        wb = (wa - 1.0) ** 2 / 4.0
        wc = wa + wb - 1.0
        if wc > 100.0:
            q = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))[0]
            new = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        else:
            new = (wb / wc) * x + (wa - wb / wc) * np.linalg.solve(eye + wc * (x.T @ x), x.T).T
        new = (new + new.T) / 2.0
        moved, x = np.linalg.norm(new - x), new
        low = min(low * (wa + wb * square) / (1.0 + wc * square), 1.0)
        if moved <= np.cbrt(EPS) * 0.1 and 1.0 - low < 1e-12:
            break
    return x


def _split(a, seed):
    """An orthogonal [v1 v2] with v1 spanning the eigenvectors above a shift and v2 those below, and the
    dimension of v1; None if ``a`` is a multiple of the identity up to rounding."""
    n = len(a)
    middle = np.trace(a) / n  # always between the smallest and the largest eigenvalue
    spread = np.linalg.norm(a - middle * np.eye(n))
    shifts = [float(np.median(np.diag(a))), middle, *(middle + spread * f / n for f in (.01, -.01, .1, -.1, .37, -.37))]
    best = None
    for shift in shifts:
        u = polar(a - shift * np.eye(n))
        rank = int(round((np.trace(u) + n) / 2.0))
        if not 0 < rank < n or np.linalg.norm(u @ u - np.eye(n)) > 1e-8 * n:  # outside, or on an eigenvalue
            continue
        projector = (u + np.eye(n)) / 2.0
        basis = np.random.default_rng(seed).standard_normal((n, rank))
        for _ in range(2):
            basis = np.linalg.qr(projector @ basis)[0]
        whole = np.linalg.qr(basis, mode="complete")[0]
        off = np.linalg.norm(whole[:, rank:].T @ a @ whole[:, :rank])
        if best is None or off < best[0]:
            best = off, whole, rank
        if off <= 50 * EPS * n * max(spread, np.linalg.norm(a)):
            break
    return best and best[1:]


def components(v):
    """(values, vectors) of the symmetric positive semidefinite ``v``: eigenvalues falling, unit vectors as
    columns. Equal eigenvalues: any orthonormal basis of their space, the same in every run."""
    d = len(v)
    values, vectors = np.zeros(d), np.zeros((d, d))
    size = np.linalg.norm(v)
    todo, done = [(v, np.eye(d))] if d else [], 0
    while todo:
        a, basis = todo.pop()
        n = len(a)
        flat = n == 1 or np.linalg.norm(a - np.trace(a) / n * np.eye(n)) <= 4 * EPS * size
        parts = None if flat else _split(a, n)
        if parts is None:
            values[done:done + n], vectors[:, done:done + n] = np.diag(a), basis
            done += n
            continue
        whole, rank = parts
        for q in (whole[:, rank:], whole[:, :rank]):
            inner = q.T @ a @ q
            todo.append(((inner + inner.T) / 2.0, basis @ q))
    vectors = _polished(v, vectors)
    values = np.einsum("ij,ij->j", vectors, v @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


def _polished(v, x):
    """One Newton correction of the eigenvector matrix ``x`` against ``v`` (rounding of nested bases), where
    eigenvalues are far enough apart, and one step towards orthogonality."""
    r = np.eye(len(v)) - x.T @ x
    s = x.T @ v @ x
    values = np.diag(s) / (1.0 - np.diag(r)) if len(v) else np.diag(s)
    gap = values[None, :] - values[:, None]
    size = np.linalg.norm(v)
    limit = 2 * (np.linalg.norm(s - np.diag(values)) + size * (np.linalg.norm(r) + len(v) * EPS))
    far = np.abs(gap) > 1e5 * limit
    turn = np.where(far, (s + values[None, :] * r) / np.where(far, gap, 1.0), r / 2.0)
    np.fill_diagonal(turn, np.diag(r) / 2.0)
    x = x + x @ turn
    return x @ (1.5 * np.eye(len(v)) - 0.5 * (x.T @ x))


# --- vectors as whole numbers ----------------------------------------------------------------------------

def integer_vectors(rows, vec_id="vec_id", embedding="embedding"):
    """(vec_id, d, x) of the rows whose vector is not null and has only finite entries: the long vector
    as little-endian bytes and its length."""
    def run(batches):
        for batch in batches:
            column = batch.column(1)
            at = column.offsets.to_numpy().astype(np.int64)
            flat = column.values
            c = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)
            bad = np.r_[0, np.cumsum(~np.isfinite(c))]  # a null entry reads as NaN
            ok = np.flatnonzero((bad[at[1:]] == bad[at[:-1]]) & column.is_valid().to_numpy(zero_copy_only=False))
            x = np.clip(np.floor(SCALE * np.where(np.isfinite(c), c, 0.0)), -LIMIT, LIMIT).astype(np.int64) + OFFSET
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(ok)), pa.array((at[1:] - at[:-1])[ok].astype(np.int32)),
                 pa.array([x[at[i]:at[i + 1]].tobytes() for i in ok], pa.binary())], ["vec_id", "d", "x"])

    kind = rows.schema[vec_id].dataType.simpleString()
    return rows.select(F.col(vec_id), F.col(embedding).cast("array<double>")).mapInArrow(run, f"vec_id {kind}, d int, x binary")


def _matrix(column, d):
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(-1, d)


def _sums(fit, d):
    """(n, S): the number of vectors and the exact sum of every dimension."""
    def run(batches):
        n, high, low = 0, np.zeros(d, np.int64), np.zeros(d, np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), d)
            n, high, low = n + len(x), high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d)), pa.array(np.full(d, n)), pa.array(high), pa.array(low)],
                                             ["i", "n", "high", "low"])

    rows = fit.select("x").mapInArrow(run, "i long, n long, high long, low long").groupBy("i").agg(
        F.sum("n").alias("n"), F.sum(F.col("high").cast("decimal(38,0)")).alias("high"),
        F.sum(F.col("low").cast("decimal(38,0)")).alias("low")).orderBy("i").collect()
    return (rows[0]["n"], [(int(r["high"]) << 32) + int(r["low"]) for r in rows]) if rows else (0, [])


def _products(rows, d, prepare):
    """Sum over all vectors of the outer product of ``prepare(x)``: an upper triangle per task, added up by
    cell. ``prepare`` gives a double matrix; whole numbers below 2^53 add exactly, in any order."""
    upper = np.triu_indices(d)

    def run(batches):
        total = None
        for batch in batches:
            y = prepare(batch.column(0))
            total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(upper[0]), pa.array(upper[1]), pa.array(total[upper])], ["i", "j", "p"])

    cells = rows.select("x").mapInArrow(run, "i long, j long, p double").groupBy("i", "j").agg(F.sum("p").alias("p"))
    out = np.zeros((d, d))
    for r in cells.collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["p"]
    return out


def _covariance(fit, n, sums, d):
    """Covariance (divisor n) of the fit list, with the whole part of the means taken off first."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = [s - n * int(m) for s, m in zip(sums, whole)]
    p = _products(fit, d, lambda column: (_matrix(column, d) - whole).astype(float))
    if np.abs(p).max(initial=0.0) < EXACT:
        return np.array([[float(Fraction(n * int(p[i, j]) - rest[i] * rest[j], n * n)) for j in range(d)] for i in range(d)])
    r = np.array([s / n for s in rest])
    return p / n - np.outer(r, r)


class Whitening:
    """A fitted whitening: n, means as (whole, rest / n), components with positive variance, ``explained``."""

    def __init__(self, n, sums, values, vectors, trace, most):
        self.n, self.d = n, len(sums)
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s - n * int(m) for s, m in zip(sums, self.whole)], np.int64)
        used = int((values[:most] > max(values[0] if len(values) else 0.0, 0.0) * EPS * max(self.d, 1)).sum())
        self.values, self.vectors = values[:used], vectors[:, :used]
        self.explained = self.values / trace if trace > 0 else self.values
        self.identity_error = None

    def project(self, column):
        """Whitened rows: the exact n x - S, over n, on the components, over the root of the variance."""
        x = _matrix(column, self.d) - self.whole
        if np.abs(x).max(initial=0) < (EXACT // max(self.n, 1)) - 1:
            centred = (self.n * x - self.rest) / self.n
        else:
            centred = x - self.rest / self.n
        return centred @ (self.vectors / np.sqrt(self.values))

    def deviation(self, column):
        """Exact sums of (n x - S)^2; None where a long cannot hold one."""
        x = _matrix(column, self.d) - self.whole
        if (float(np.abs(x).max(initial=0)) + 1) ** 2 * float(self.n) ** 2 * self.d < 2**62:
            y = self.n * x - self.rest
            return (y * y).sum(axis=1).tolist()
        rest = self.rest.tolist()
        out = [sum((self.n * a - s) ** 2 for a, s in zip(row, rest)) for row in x.tolist()]
        return [v if v < 2**63 else None for v in out]


def fit(vectors, most=16):
    """The Whitening of the distinct vectors of ``vectors`` (columns d, x) and its first ``most`` components.

    Vectors of another length than the most frequent one (ties: the longest) are left out, and so are vectors
    without entries. None if nothing is left. Components without variance are not given.
    """
    lengths = vectors.where("d > 0").groupBy("d").count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return None
    d = lengths["d"]
    distinct = keep(vectors.where(F.col("d") == d).select("x").distinct())  # one group per vector, combined before the shuffle
    n, sums = _sums(distinct, d)
    v = _covariance(distinct, n, sums, d)
    values, parts = components(v)
    model = Whitening(n, sums, values, parts, float(np.trace(v)), most)
    shared, k = vectors.sparkSession.sparkContext.broadcast(model), len(model.values)
    if k:  # the covariance of what was whitened, with its mean: a column of ones gives the sums
        p = _products(distinct, k + 1, lambda column: np.c_[shared.value.project(column), np.ones(len(column))])
        mean = p[:k, k] / n
        model.identity_error = float(np.abs(p[:k, :k] / n - np.outer(mean, mean) - np.eye(k)).max())
    shared.unpersist()
    return model


def whitened(rows, most=16, vec_id="vec_id", embedding="embedding"):
    """One row per usable row of ``rows`` and component: vec_id, component, n, deviation, whitened, explained,
    identity_error.

    Rows whose vector is null, empty, of another length than most, or holds null or non-finite entries give
    none; repeated rows come out as often as they went in but count once in the fit. Without any
    variance (one distinct vector) and in empty tables there is no component and no row.
    """
    spark = rows.sparkSession
    vectors = keep(integer_vectors(rows, vec_id, embedding))
    model = fit(vectors, most)
    kind = rows.schema[vec_id].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None or not len(model.values):
        return spark.createDataFrame([], schema)
    shared, k = spark.sparkContext.broadcast(model), len(model.values)

    def run(batches):
        model = shared.value
        for batch in batches:
            m = batch.num_rows
            spread = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(spread)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, model.n)), pa.array(model.deviation(batch.column(1)), pa.int64()).take(pa.array(spread)),
                pa.array(model.project(batch.column(1)).ravel()), pa.array(np.tile(model.explained, m)),
                pa.array(np.full(m * k, model.identity_error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.where(F.col("d") == model.d).select("vec_id", "x").mapInArrow(run, schema)
