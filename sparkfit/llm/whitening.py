"""Whitening of whole-number vectors, with components by contour integration.

The fit list is every distinct vector once. Its sums are exact; its covariance is
added up by all tasks from centred vectors; only sums of the size of one vector
or one d x d matrix (``MAX_DIM``) reach the driver. Components are unit
eigenvectors of that covariance:

* the inertia of V - s (signs of a pivoted symmetric factorisation) counts the
  eigenvalues above s, which cuts the wanted end of the spectrum into intervals
  of at most ``PER_INTERVAL`` eigenvalues;
* each interval is a task: the quadrature of (z - V)^-1 along a circle through
  its ends projects a block of vectors onto the interval's eigenvectors,
  Rayleigh-Ritz extracts them, and this is repeated until residuals are at
  rounding level;
* an interval is done only when it has as many eigenvalues as the inertia says,
  so none is missed, equal ones included.

Defined results. Rows whose vector is null, or has null entries, or another
length than most vectors have, are left out, as nothing can be said of them;
zero vectors and rows without an id are kept. Repeated rows count once in the
fit and are all returned. Components whose eigenvalue isn't above rounding level
(d * eps * trace) can't be whitened and aren't returned, so that there are fewer
than asked where the fit list spans fewer directions, and none for a single
distinct vector or an empty table. ``deviation`` is null where it exceeds a long.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfit.llm.common import check_bound, ship
from sparkfit.llm.vectors import common_length, matrix, summed
from sparkfit.session import drop_table, write_table

MAX_DIM = 2048              # a d x d matrix is held by the driver and by each interval's task
MOST = 2 ** 52              # entries beyond are no exact doubles
PER_INTERVAL = 8
NODES = 8                   # quadrature points on the half circle
ROUNDS = 40
_LOW = 26                   # bits of the lower part in exact sums

_OUT = "id {0}, component int, n bigint, deviation bigint, whitened double, explained double"


def above(v: np.ndarray, shift: float) -> int:
    """Number of eigenvalues of the symmetric matrix that exceed ``shift``: the
    positive pivots of a symmetric factorisation with 1x1 and 2x2 pivots, the
    largest left entry first."""
    a = v - shift * np.eye(len(v))
    share = (1 + math.sqrt(17)) / 8
    positive, k, n = 0, 0, len(a)

    def swap(p, q):
        a[[p, q]] = a[[q, p]]
        a[:, [p, q]] = a[:, [q, p]]

    while k < n:
        rest = np.abs(a[k:, k:])
        diag = np.diagonal(rest)
        p = int(diag.argmax())
        i, j = divmod(int(rest.argmax()), n - k)
        if rest[i, j] == 0:
            break
        if diag[p] >= share * rest[i, j]:
            swap(k, k + p)
            pivot = a[k, k]
            positive += bool(pivot > 0)
            col = a[k + 1:, k].copy()
            a[k + 1:, k + 1:] -= np.outer(col, col / pivot)
            k += 1
        else:                                   # a 2x2 pivot has one eigenvalue of each sign
            i, j = sorted((i, j))
            swap(k, k + i)
            swap(k + 1, k + j)
            cols = a[k + 2:, k:k + 2].copy()
            a[k + 2:, k + 2:] -= cols @ np.linalg.solve(a[k:k + 2, k:k + 2], cols.T)
            positive += 1
            k += 2
    return positive


def _clear_cut(v: np.ndarray, at: float, width: float) -> tuple[float, int]:
    """A cut near ``at`` with no eigenvalue close to it, and the count above."""
    gap = 1e-4 * width
    for step in range(64):
        s = at + (step + 1) // 2 * (-1) ** step * 3 * gap
        n = above(v, s - gap)
        if n == above(v, s + gap):
            return s, n
    return at, above(v, at)


def intervals(v: np.ndarray, wanted: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues) intervals, falling, that hold at least the
    ``wanted`` largest eigenvalues, or all that are above rounding level."""
    floor = len(v) * float(np.finfo(float).eps) * max(float(np.trace(v)), 0.0)
    high = float(np.abs(v).sum(axis=1).max()) * (1 + 1e-9) + floor
    positive = above(v, floor)
    wanted = min(wanted, positive)
    if not wanted:
        return []
    todo, done, have = [(floor, high, positive, 0)], [], 0
    while todo:                                 # the highest first
        low, top, n_low, n_top = todo.pop()
        n = n_low - n_top
        if have >= wanted or not n:
            continue
        if n <= PER_INTERVAL and (top - low) <= 0.5 * abs(top + low) or top - low <= 1e-9 * high:
            done.append((low, top, n))
            have += n
            continue
        cut, n_cut = _clear_cut(v, (low + top) / 2, top - low)
        todo += [(low, cut, n_low, n_cut), (cut, top, n_cut, n_top)]
    return done


def project(v: np.ndarray, low: float, high: float, block: np.ndarray) -> np.ndarray:
    """The block, filtered to eigenvectors of eigenvalues between low and high."""
    centre, radius = (low + high) / 2, (high - low) / 2
    points, weights = np.polynomial.legendre.leggauss(NODES)
    out = np.zeros_like(block)
    for x, w in zip(points, weights, strict=True):
        turn = radius * np.exp(1j * math.pi / 2 * (1 + x))
        shifted = (centre + turn) * np.eye(len(v)) - v
        out += w / 2 * (turn * np.linalg.solve(shifted, block.astype(complex))).real
    return out


def interval_pairs(v: np.ndarray, low: float, high: float, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The n eigenvalues between low and high and their unit eigenvectors."""
    d = len(v)
    scale = float(np.abs(v).sum(axis=1).max())
    close = 64 * np.finfo(float).eps * scale
    best = None
    for size in (2 * n + 8, 4 * n + 16, d):
        block = np.random.default_rng(12345).standard_normal((d, min(d, size)))
        for _ in range(ROUNDS):
            u, s, _ = np.linalg.svd(project(v, low, high, block), full_matrices=False)
            u = u[:, s > 1e-14 * s[0]]
            small = u.T @ v @ u
            ritz, w = np.linalg.eigh((small + small.T) / 2)
            block = u @ w
            inside = (ritz > low) & (ritz <= high)
            if inside.sum() != n:
                continue
            values, vectors = ritz[inside], block[:, inside]
            worst = np.linalg.norm(v @ vectors - vectors * values, axis=0).max()
            if best is None or worst < best[0] / 2:
                best = (worst, values, vectors)
            elif best[0] <= close * math.sqrt(d):   # as good as it gets
                return best[1], best[2]
    if best is not None and best[0] <= 1e-10 * scale:
        return best[1], best[2]
    raise ArithmeticError(f"{n} eigenvalues lie between {low} and {high}, but the iteration doesn't find them")


def components(spark, v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their eigenvectors as columns; each
    interval of the spectrum is a task."""
    parts = intervals(v, wanted)
    if not parts:
        return np.zeros(0), np.zeros((len(v), 0))
    ship(spark)
    shared = spark.sparkContext.broadcast(v)

    def solve(batches):
        for batch in batches:
            for row in batch.to_pylist():
                values, vectors = interval_pairs(shared.value, row["low"], row["high"], row["n"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values), pa.array(list(vectors.T), pa.list_(pa.float64()))], names=["e", "q"])

    rows = spark.createDataFrame(parts, "low double, high double, n int").repartition(len(parts)) \
        .mapInArrow(solve, "e double, q array<double>").collect()
    rows = sorted(rows, key=lambda r: (-r["e"], r["q"]))[:wanted]
    if above(v, rows[-1]["e"] * (1 - 1e-9)) < len(rows):
        raise ArithmeticError("more components than the inertia counts")
    return np.array([r["e"] for r in rows]), np.array([r["q"] for r in rows]).T


class Centre:
    """Count and exact sums of the fit list, and vectors less their mean."""

    def __init__(self, n: int, sums: list[int]) -> None:
        self.n, self.base, self.rest = n, [s // n for s in sums], [s % n for s in sums]

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - np.array(self.base)).astype(float) - np.array(self.rest) / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n * x - S)^2 over the entries of each row, exactly."""
        off, rest = x - np.array(self.base), np.array(self.rest)
        if self.n * (float(np.abs(off).max(initial=0)) + 1) < math.sqrt(2.0 ** 62 / x.shape[1]):
            return ((self.n * off - rest) ** 2).sum(axis=1).tolist()
        out = (self.n * off.astype(object) - rest.astype(object)) ** 2
        return [t if t < 2 ** 63 else None for t in out.sum(axis=1).tolist()]


def _centre(fit: DataFrame, d: int) -> Centre:
    def add(batches):
        sums = None
        for batch in batches:
            x = matrix(batch.column(0), d)
            got = np.array([(x >> _LOW).sum(axis=0), (x & (1 << _LOW) - 1).sum(axis=0)], dtype=object)
            sums = got if sums is None else sums + got
        if sums is None:
            return
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([int(v) for v in sums[0]], pa.int64()),
                                          pa.array([int(v) for v in sums[1]], pa.int64())], names=["i", "hi", "lo"])

    rows = fit.mapInArrow(add, "i int, hi bigint, lo bigint").groupBy("i") \
        .agg(F.sum(F.col("hi").cast("decimal(38,0)")).alias("hi"), F.sum(F.col("lo").cast("decimal(38,0)")).alias("lo")) \
        .collect()
    sums = {r["i"]: (int(r["hi"]) << _LOW) + int(r["lo"]) for r in rows}
    return Centre(fit.count(), [sums[i] for i in range(d)])


def _products(centre: Centre, d: int, after=lambda c: c):
    """Sum of the products of a task's centred vectors."""
    def add(batches):
        total = None
        for batch in batches:
            w = after(centre.centred(matrix(batch.column(0), d)))
            total = w.T @ w if total is None else total + w.T @ w
        return total
    return add


def whiten(df: DataFrame, id_col: str, x_col: str, wanted: int) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of every
    row that has a vector, for the ``wanted`` largest components.

    ``x_col`` holds vectors of whole numbers (array<bigint>, below 2^52);
    ``deviation`` is the exact sum of (n * x - S)^2, ``identity_error`` the
    largest difference between the covariance of the whitened fit list and the
    identity."""
    spark = df.sparkSession
    ship(spark)
    x = F.col(x_col)
    bad = F.exists(x, lambda v: v.isNull() | (F.abs(v) >= MOST))
    rows = df.select(F.col(id_col).alias("id"), x.alias("x")).where((F.size(x) > 0) & ~bad)
    kind = dict(rows.dtypes)["id"]
    out = _OUT.format(kind)
    d = common_length(rows, "x")
    check_bound("entries of a vector", d, MAX_DIM)
    rows = rows.where(F.size("x") == d)
    if not d:
        return spark.createDataFrame([], out + ", identity_error double")
    fit = write_table(rows.select("x").distinct(), "whitening-fit")
    centre = _centre(fit, d)
    n = centre.n
    v = summed(fit, _products(centre, d)) / n
    v = (v + v.T) / 2
    values, vectors = components(spark, v, wanted)
    k, trace = len(values), float(np.trace(v))
    if not k:
        return spark.createDataFrame([], out + ", identity_error double")
    turn = vectors / np.sqrt(values)

    def add_means(batches):
        total = None
        for batch in batches:
            got = (centre.centred(matrix(batch.column(0), d)) @ turn).sum(axis=0, keepdims=True)
            total = got if total is None else total + got
        return total

    means = summed(fit, add_means)[0] / n
    cov = summed(fit, _products(centre, d, lambda c: c @ turn - means)) / n
    error = float(np.abs(cov - np.eye(k)).max())
    drop_table(fit)
    shares = (values / trace).tolist()

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                xs = matrix(part.column(1), d)
                m = len(xs)
                if not m:
                    continue
                w = centre.centred(xs) @ turn
                who = np.repeat(np.arange(m), k)
                dev = centre.deviations(xs)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(who)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                     pa.array(np.full(m * k, n)), pa.array(dev, pa.int64()).take(pa.array(who)),
                     pa.array(w.reshape(-1)), pa.array(np.tile(shares, m))],
                    names=["id", "component", "n", "deviation", "whitened", "explained"])

    return rows.mapInArrow(run, out).withColumn("identity_error", F.lit(error))
