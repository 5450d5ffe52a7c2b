"""Whitening of embeddings from incrementally built spectra.

Four passes over the vectors, each a scan that leaves one small state a task;
states meet in a tree of groups of ``FAN`` (``common.folded``), so neither a
task nor the driver gathers what grows with the table:

1. exact integer sums, which fix the centre;
2. spectra: each task keeps the eigenpairs of its scatter matrix about the
   common centre and takes in one centred vector at a time by a rank-one
   update - eigenvalues from the secular equation, vanishing components and
   equal eigenvalues deflated. Two spectra become one by rank-one updates with
   the scaled eigenvectors of the second;
3. Rayleigh-Ritz: the scatter applied to the whole basis, centred before
   multiplying, and a small eigenproblem in the basis. A basis that spans all
   dimensions (up to ``rank`` of them) is exact at once; else its image is the
   next basis until the residual is at rounding;
4. the covariance of what the projection gives, for ``identity_error``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursewise.llm.common import folded

SCALE, SHIFT = 1024, 100_000
#: Scaled entries beyond this magnitude count as this magnitude.
MOST = 2.0 ** 52
EPS = np.finfo(float).eps


# ---- rank-one updates ------------------------------------------------------

def secular_roots(lam: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of diag(lam) + z z' and the differences lam[j] - root[i] as a matrix.

    ``lam`` rises strictly and no entry of ``z`` is zero. Root i lies between
    lam[i] and lam[i + 1] and is sought from the nearer of the two, so that
    differences to the poles keep their digits; all roots move at once, by
    rational interpolation held in brackets.
    """
    m = len(lam)
    zz = z * z
    gap = np.append(np.diff(lam), zz.sum())
    left = 1 + (zz / (lam[None, :] - (lam + gap / 2)[:, None])).sum(axis=1) >= 0
    left[-1] = True
    origin = np.where(left, lam, np.append(lam[1:], 0.0))
    poles = lam[None, :] - origin[:, None]
    low, high = np.where(left, 0.0, -gap / 2), np.where(left, gap / 2, 0.0)
    high[-1] = gap[-1] * (1 + 1e-9)  # a single root is the bound itself
    tau = (low + high) / 2
    below = np.tril(np.ones((m, m), bool))
    near = np.where(left, 0.0, -gap)  # the pole on the left, from the origin
    far = near + gap
    for _ in range(80):
        diff = poles - tau[:, None]
        part = zz / diff
        f = 1 + part.sum(axis=1)
        low, high = np.where(f < 0, tau, low), np.where(f < 0, high, tau)
        slope = part / diff
        psi = np.where(below, slope, 0).sum(axis=1)
        phi = slope.sum(axis=1) - psi
        a1, a2 = near - tau, far - tau
        c = f - a1 * psi - a2 * phi
        a = (a1 + a2) * f - a1 * a2 * (psi + phi)
        b = a1 * a2 * f
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            step[-1] = a1[-1] * f[-1] / c[-1]
        new = tau + step
        inside = (new > low) & (new < high)
        new = np.where(inside, new, (low + high) / 2)
        still = (np.abs(f) > 4 * EPS * (1 + np.abs(part).sum(axis=1))) & (np.abs(new - tau) > 2 * EPS * np.abs(tau))
        if not still.any():
            break
        tau = np.where(still, new, tau)
    return origin + tau, poles - tau[:, None]


def rank_one(lam: np.ndarray, vec: np.ndarray, y: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenpairs (rising) of vec diag(lam) vec' + y y', the largest ``rank`` of them."""
    size = np.sqrt(y @ y)
    if size == 0:
        return lam, vec
    z = vec.T @ y
    if vec.shape[1] < len(y):  # a direction the basis lacks
        rest = y - vec @ z
        more = vec.T @ rest
        z, rest = z + more, rest - vec @ more
        length = np.sqrt(rest @ rest)
        if length > 1e-12 * size:
            lam, vec, z = np.append(0.0, lam), np.column_stack([rest / length, vec]), np.append(length, z)
    tol = 8 * EPS * max(lam[-1] if len(lam) else 0.0, size * size)
    live = np.abs(z) * size > tol
    for j in np.flatnonzero(np.diff(lam) * size * size <= tol * size):  # neighbours that hardly differ: turn one away
        if live[j] and live[j + 1] and (lam[j + 1] - lam[j]) * abs(z[j] * z[j + 1]) <= tol * (z[j] ** 2 + z[j + 1] ** 2):
            r = np.hypot(z[j], z[j + 1])
            c, s = z[j + 1] / r, z[j] / r
            vec[:, [j, j + 1]] = vec[:, [j, j + 1]] @ np.array([[c, s], [-s, c]])
            z[j], z[j + 1] = 0.0, r
            live[j] = False
    a = np.flatnonzero(live)
    if len(a):
        on = lam[a]
        new, diff = secular_roots(on, z[a])
        # the z that has exactly these roots, so that the vectors come out orthogonal
        apart = on[:, None] - on[None, :]
        np.fill_diagonal(apart, 1.0)
        exact = np.sqrt(np.abs(np.prod(diff / apart, axis=0))) * np.sign(z[a])
        turn = exact[None, :] / diff
        turn /= np.sqrt((turn * turn).sum(axis=1))[:, None]
        lam, vec = lam.copy(), vec.copy()
        lam[a], vec[:, a] = new, vec[:, a] @ turn.T
        order = np.argsort(lam, kind="stable")[-rank:]
        lam, vec = lam[order], vec[:, order]
    return lam, vec


def merged(one: tuple, other: tuple, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """The spectrum of the sum of two scatter matrices, by an update for each eigenpair of the second."""
    lam, vec = one
    for value, direction in zip(other[0], other[1].T, strict=True):
        if value > 0:
            lam, vec = rank_one(lam, vec, np.sqrt(value) * direction, rank)
    return lam, vec


# ---- passes ----------------------------------------------------------------

def _scaled(column: pa.Array, d: int) -> np.ndarray:
    """The vectors of a batch as integers."""
    c = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, d)
    return np.floor(np.clip(SCALE * c, -MOST, MOST)).astype(np.int64) + SHIFT


class Centre:
    """n and the sums, as n * x - S = n * (x - q) - r with 0 <= r < n."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.q = np.array([s // n for s in sums], np.int64)
        self.r = np.array([s % n for s in sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.q) - self.r / self.n

    def deviations(self, x: np.ndarray) -> list[int]:
        """Exact sums of (n * x - S) ** 2."""
        t = x - self.q
        if max(np.abs(t).max(initial=0), self.n) >= 1 << 27:  # products may leave 64 bits
            t, r = t.astype(object), self.r.astype(object)
        else:
            r = self.r
        square, cross, rest = (t * t).sum(axis=1), (t * r).sum(axis=1), sum(int(v) ** 2 for v in self.r)
        return [self.n ** 2 * int(a) - 2 * self.n * int(b) + rest for a, b in zip(square, cross, strict=True)]


def _fit_list(df: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, int]:
    """(id, v) of the usable rows, and their dimension (0 without any)."""
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v")).where(F.col("v").isNotNull() & (F.size("v") > 0) & ~bad)
    top = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    d = top[0]["d"] if top else 0
    return rows.where(F.size("v") == d), d


def _added(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a + b


def _centre(rows: DataFrame, d: int) -> Centre:
    def start(batches):
        n, high, low = 0, np.zeros(d, np.int64), np.zeros(d, np.int64)
        for b in batches:
            x = _scaled(b.column(0), d)
            n, high, low = n + len(x), high + (x >> 26).sum(axis=0), low + (x & ((1 << 26) - 1)).sum(axis=0)
        return np.concatenate([[n], high, low]) if n else None

    total = folded(rows.select("v"), start, _added)
    return Centre(int(total[0]), [(int(h) << 26) + int(w) for h, w in zip(total[1:d + 1], total[d + 1:], strict=True)])


def _spectrum(rows: DataFrame, d: int, centre: Centre, rank: int) -> np.ndarray:
    """Orthonormal basis (columns) from the spectrum of all rows."""
    def start(batches):
        lam, vec = np.zeros(0), np.zeros((d, 0))
        for b in batches:
            for y in centre.centred(_scaled(b.column(0), d)):
                lam, vec = rank_one(lam, vec, y, rank)
        return np.vstack([lam, vec])

    def join(a, b):
        return np.vstack(merged((a[0], a[1:]), (b[0], b[1:]), rank))

    state = folded(rows.select("v"), start, join)
    return np.linalg.qr(state[1:, ::-1])[0]


def _refined(rows: DataFrame, d: int, centre: Centre, basis: np.ndarray, components: int, passes: int = 50):
    """(eigenvalues, eigenvectors as columns, trace) of the covariance, the largest ``components``."""
    for _ in range(passes):
        m = basis.shape[1]

        def start(batches, basis=basis):
            out = np.zeros((d + 1, basis.shape[1]))
            for b in batches:
                y = centre.centred(_scaled(b.column(0), d))
                out[:d] += y.T @ (y @ basis)
                out[d, 0] += (y * y).sum()
            return out

        state = folded(rows.select("v"), start, _added) / centre.n if m else np.zeros((d + 1, 1))
        image, trace = state[:d], state[d, 0]
        small = basis.T @ image if m else np.zeros((0, 0))
        value, turn = np.linalg.eigh((small + small.T) / 2)
        value, turn = value[::-1][:components], turn[:, ::-1][:, :components]
        vectors = basis @ turn
        off = np.abs(image @ turn - vectors * value).max(initial=0) if m else 0.0
        if m == d or m < components or off <= 1e-13 * (value[0] if len(value) else 1):
            break
        basis = np.linalg.qr(image)[0]
    some = value > d * EPS * max(trace, 0)  # without variance nothing can be scaled to 1
    return value[some], vectors[:, some], trace


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = 8,
           rank: int = 256) -> DataFrame:
    """(id_col, component, n, deviation, whitened, explained, identity_error) of each usable row and component.

    A vector is left out if it is null, empty, or holds a null, NaN or infinite
    entry, or if its length is not the commonest of the table (the longer, on a
    tie). All others are the fit list, repeated rows and null ids included.
    ``deviation`` is an exact decimal. Components are those with variance, the
    largest first; a table without variance (no rows, one row, equal rows) gives
    no rows. Equal eigenvalues leave the choice of vectors in their space open,
    but it is the same for all rows. Bases of up to ``rank`` directions are kept.
    Other columns of ``df`` are not looked at.
    """
    spark = df.sparkSession
    kind = df.schema[id_col].dataType
    schema = (f"{id_col} {kind.simpleString()}, component int, n long, deviation decimal(38,0), whitened double, "
              "explained double, identity_error double")
    rows, d = _fit_list(df, id_col, vec_col)
    if not d:
        return spark.createDataFrame([], schema)
    centre = _centre(rows, d)
    basis = _spectrum(rows, d, centre, max(rank, components))
    value, vectors, trace = _refined(rows, d, centre, basis, components)
    k, n = len(value), centre.n
    if not k:
        return spark.createDataFrame([], schema)
    project = vectors / np.sqrt(value)

    def second(batches):
        out = np.zeros((k + 1, k))
        for b in batches:
            w = centre.centred(_scaled(b.column(0), d)) @ project
            out[:k] += w.T @ w
            out[k] += w.sum(axis=0)
        return out

    state = folded(rows.select("v"), second, _added) / n
    error = float(np.abs(state[:k] - np.outer(state[k], state[k]) - np.eye(k)).max())
    explained = value / trace

    def run(batches):
        for b in batches:
            x = _scaled(b.column(1), d)
            w = centre.centred(x) @ project
            each = np.repeat(np.arange(len(x)), k)
            deviation = pa.array([str(v) for v in centre.deviations(x)], pa.string()).cast(pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                 pa.array(np.full(len(each), n)), deviation.take(pa.array(each)), pa.array(w.ravel()),
                 pa.array(np.tile(explained, len(x))), pa.array(np.full(len(each), error))],
                [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)


def op13_embedding_whitening(spark, sf_dir: str) -> DataFrame:
    """The whitened coordinates of every embedding."""
    out = whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return out.withColumn("deviation", F.col("deviation").cast("long"))
