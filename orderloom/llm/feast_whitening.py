"""Whitening by principal components that contour integration finds.

Spark adds up counts, sums and centred products of all vectors; what comes together is one
square matrix of the vectors' width. Its largest eigenvalues are found interval by interval:
the inertia of the shifted matrix counts the eigenvalues above a number, and bisection over
such counts cuts the wanted part of the spectrum into intervals of a few eigenvalues. For each,
complex shifted systems are solved at the nodes of a quadrature along the circle through its
ends, which projects a random subspace onto the interval's eigenvectors; Rayleigh-Ritz extracts
them, and projection goes on from there until residuals are at rounding level and there
are as many as the inertia says. Spark then projects all vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import frugal

COMPONENTS = 32
SCALE = 64
SHIFT = 1_000_000
FARTHEST = float(1 << 61)  # larger entries count as this
SLICE = 12  # eigenvalues of one interval
NODES = 8  # of the quadrature, on the upper half of a circle
TURNS = 12  # projections before the subspace is doubled
GAP = 8  # bisections that find the ends of a gap
EPS = np.finfo(float).eps
COLUMNS = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


# ---- eigenvalues of a symmetric matrix


def negatives(a: np.ndarray) -> int:
    """How many eigenvalues are below 0: the inertia, by an LDL' factorization with Bunch-Kaufman pivots."""
    a = np.array(a, float)
    n, k, count = len(a), 0, 0
    alpha = (1 + np.sqrt(17)) / 8

    def swap(i: int, j: int) -> None:
        a[[i, j]] = a[[j, i]]
        a[:, [i, j]] = a[:, [j, i]]

    while k < n:
        below = np.abs(a[k + 1 :, k])
        r = k + 1 + int(below.argmax()) if len(below) else k
        most = below.max(initial=0.0)
        two = False
        if abs(a[k, k]) < alpha * most:
            other = np.abs(a[k:, r])
            other[r - k] = 0
            widest = other.max()
            if abs(a[k, k]) * widest < alpha * most * most:
                if abs(a[r, r]) >= alpha * widest:
                    swap(k, r)
                else:
                    swap(k + 1, r)
                    two = True
        if two:  # such a block has one eigenvalue of each sign
            count += 1
            rest = a[k + 2 :, k : k + 2].copy()
            a[k + 2 :, k + 2 :] -= rest @ np.linalg.solve(a[k : k + 2, k : k + 2], rest.T)
            k += 2
        else:
            pivot = a[k, k]
            count += bool(pivot < 0)
            if pivot:
                rest = a[k + 1 :, k].copy()
                a[k + 1 :, k + 1 :] -= np.outer(rest, rest / pivot)
            k += 1
    return count


def above(v: np.ndarray, x: float) -> int:
    """How many eigenvalues of v are over x."""
    return negatives(x * np.eye(len(v)) - v)


def intervals(v: np.ndarray, wanted: int, most: int = SLICE) -> list[tuple[float, float, int]]:
    """Intervals, the highest first, that hold the `wanted` largest positive eigenvalues, and how many are in each.

    More come along where the last of them is one of a cluster that no number parts.
    """
    top = float(np.abs(v).sum(1).max(initial=0.0)) * (1 + 1e-10)
    bottom = len(v) * EPS * top  # what is below is rounding
    if top <= 0:
        return []
    narrow = 1e-9 * top

    def cut(high: float, n_high: int, goal: int) -> tuple[float, int]:
        """A number with `goal` eigenvalues between it and `high`, or the fewest beyond that, amid a gap."""
        low, n_low, over = bottom, above(v, bottom), high
        while n_low - n_high > goal and over - low > narrow:
            middle = (low + over) / 2
            n = above(v, middle)
            if n - n_high >= goal:
                low, n_low = middle, n
            else:
                over = middle
        # the gap that it lies in, from below and from above
        first, last, under = low, low, 0.0
        for _ in range(GAP):
            middle, lower = (last + over) / 2, (under + first) / 2
            if above(v, middle) == n_low:
                last = middle
            else:
                over = middle
            if above(v, lower) == n_low:
                first = lower
            else:
                under = lower
        return (first + last) / 2, n_low

    out = []
    high, n_high = top, 0
    wanted = min(wanted, above(v, bottom))
    while n_high < wanted:
        low, n_low = cut(high, n_high, min(most, wanted - n_high))
        out.append((low, high, n_low - n_high))
        high, n_high = low, n_low
    return out


def project(v: np.ndarray, y: np.ndarray, low: float, high: float, nodes: int = NODES) -> np.ndarray:
    """Y's part in the eigenvectors of an interval, about: quadrature of the resolvent along a circle."""
    x, weight = np.polynomial.legendre.leggauss(nodes)
    out = np.zeros_like(y)
    for angle, w in zip(np.pi * (1 - x) / 2, weight, strict=True):
        arm = (high - low) / 2 * np.exp(1j * angle)
        shifted = ((low + high) / 2 + arm) * np.eye(len(v)) - v
        out += w / 2 * (arm * np.linalg.solve(shifted, y.astype(complex))).real
    return out


def ritz(v: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ritz values, rising, and vectors of the subspace that y spans."""
    q, _ = np.linalg.qr(y)
    h = q.T @ v @ q
    values, z = np.linalg.eigh((h + h.T) / 2)
    return values, q @ z


def feast(v: np.ndarray, low: float, high: float, count: int, seed: int = 0) -> np.ndarray:
    """The eigenvectors to eigenvalues in low..high, `count` of them by inertia."""
    size = min(len(v), 2 * count + 4)
    scale = np.linalg.norm(v, 2) if len(v) < 200 else float(np.abs(v).sum(1).max())
    while True:
        y = np.random.default_rng(seed).standard_normal((len(v), size))
        before = np.inf
        for _ in range(TURNS):
            if size < len(v):
                y = project(v, y, low, high)
            values, y = ritz(v, y)
            inside = (values > low) & (values <= high)
            x = y[:, inside]
            rest = np.linalg.norm(v @ x - x * values[inside], axis=0).max(initial=0.0)
            level = EPS * np.sqrt(len(v)) * scale
            enough = rest <= 4 * level or before / 2 <= rest <= 100 * level
            if inside.sum() == count and (enough or size == len(v)):
                return x
            before = rest if inside.sum() == count else np.inf
        if size == len(v):  # the whole space: an end fell on an eigenvalue, in rounding
            return y[:, np.argsort(np.abs(values - (low + high) / 2), kind="stable")[:count]]
        size = min(len(v), 2 * size)


def largest(v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The `wanted` largest eigenvalues, falling, and unit eigenvectors as columns; those that are rounding only are left out."""
    found = [feast(v, *part) for part in intervals(v, wanted)]
    if not found:
        return np.zeros(0), np.zeros((len(v), 0))
    values, x = ritz(v, np.concatenate(found, 1))
    values, x = values[::-1][:wanted], x[:, ::-1][:, :wanted]
    x = x * np.where(x[np.abs(x).argmax(0), np.arange(x.shape[1])] < 0, -1.0, 1.0)
    return values, x


# ---- sums over all vectors


def matrix(column: pa.Array, width: int | None = None, scale: int = SCALE, shift: int = SHIFT) -> tuple[np.ndarray, np.ndarray]:
    """Which rows take part, and their whole-number vectors; short ones are filled up as by zeros."""
    column = column.cast(pa.large_list(pa.float64()))
    sizes = pc.list_value_length(column).fill_null(0).to_numpy()
    row = np.repeat(np.arange(len(column)), sizes)
    place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    entries = column.flatten().to_numpy(zero_copy_only=False)  # a null entry becomes NaN
    bad = np.bincount(row, ~np.isfinite(entries), minlength=len(column)) > 0
    keep = column.is_valid().to_numpy(zero_copy_only=False) & ~bad
    x = np.full((len(column), int(sizes[keep].max(initial=0)) if width is None else width), shift, np.int64)
    use = keep[row]
    x[row[use], place[use]] = np.clip(np.floor(scale * entries[use]), -FARTHEST, FARTHEST).astype(np.int64) + shift
    return keep, x[keep]


def _reach(x: np.ndarray) -> int:
    return max(int(x.max(initial=0)), -int(x.min(initial=0)))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per place of the vector: rows that have it, least, most and sum; place -1 counts all rows."""
    for batch in batches:
        keep, x = matrix(batch.column("embedding"))
        lengths = pc.list_value_length(batch.column("embedding")).fill_null(0).to_numpy()[keep]
        held = (lengths[:, None] > np.arange(x.shape[1])).sum(0)
        wide = x.astype(object) if _reach(x) * max(1, len(x)) >= 1 << 62 else x
        total = [0, *(int(s) for s in wide.sum(0))] if len(x) else [0] * (x.shape[1] + 1)
        # a row too short for a place adds the shift to its sum; that is taken off here
        total = [t - SHIFT * (len(x) - int(h)) for t, h in zip(total, [len(x), *held], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(-1, x.shape[1], dtype=np.int32)),
                pa.array(np.array([len(x), *held], np.int64)),
                pa.array(np.array([SHIFT, *x.min(0, initial=SHIFT)], np.int64)),
                pa.array(np.array([SHIFT, *x.max(0, initial=SHIFT)], np.int64)),
                pa.array([Decimal(t) for t in total], pa.decimal128(38, 0)),
            ],
            ["place", "n", "low", "high", "total"],
        )


class Middle(NamedTuple):
    """n rows; per place the sum, the whole number next to the mean, and the sum's rest n * middle leaves."""

    n: int
    sums: list[int]
    middle: np.ndarray
    rest: list[int]
    reach: int  # the largest distance of an entry from its middle

    @property
    def width(self) -> int:
        return len(self.sums)


def middle(vectors: DataFrame) -> Middle:
    parts = vectors.mapInArrow(frugal(_sums), "place int, n long, low long, high long, total decimal(38,0)")
    rows = parts.groupBy("place").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("total").alias("total"))
    rows = sorted(rows.collect(), key=lambda r: r.place)  # one row per place of a vector
    n = rows[0].n if rows else 0
    sums = [int(r.total) + SHIFT * (n - r.n) for r in rows[1:]] if n else []
    mid = [(2 * s + n) // (2 * n) for s in sums]
    far = [max(r.high - m, m - r.low) for r, m in zip(rows[1:], mid, strict=True)] if n else []
    return Middle(n, sums, np.array(mid, np.int64), [s - n * m for s, m in zip(sums, mid, strict=True)], max(far, default=0))


def _cells(total: np.ndarray) -> pa.RecordBatch:
    """The upper triangle of a square matrix, a row per entry."""
    i, j = np.triu_indices(len(total))
    return pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], ["i", "j", "total"])


def _square(cells: DataFrame, width: int) -> list[list]:
    """The sum of all partial matrices."""
    out = [[0] * width for _ in range(width)]
    for r in cells.groupBy("i", "j").agg(F.sum("total").alias("total")).collect():  # width squared rows
        out[r.i][r.j] = out[r.j][r.i] = r.total
    return out


def _products(mid: Middle, whole: bool):
    """Sums of products of centred entries: whole numbers where the total is sure to fit, else doubles."""
    step = max(1, (1 << 53) // max(1, mid.reach) ** 2)  # so many rows add up exactly in doubles

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((mid.width, mid.width), np.int64 if whole else float)
        for batch in batches:
            x = matrix(batch.column("embedding"), mid.width)[1] - mid.middle
            for s in range(0, len(x), step) if whole else [0]:
                u = x[s : s + step] if whole else x
                if whole and mid.reach >= 1 << 26:
                    total += u.T @ u
                else:
                    total += (u.T.astype(float) @ u.astype(float)).astype(total.dtype)
        yield _cells(total)

    return task


def covariance(vectors: DataFrame, mid: Middle) -> np.ndarray:
    """Divisor n, each entry rounded once where sums are whole numbers."""
    whole = mid.n * mid.reach**2 < 1 << 62
    cells = vectors.mapInArrow(frugal(_products(mid, whole)), f"i int, j int, total {'long' if whole else 'double'}")
    total, n = _square(cells, mid.width), mid.n
    exact = int if whole else float
    v = [[(n * exact(total[i][j]) - exact(a * b)) / (n * n) for j, b in enumerate(mid.rest)] for i, a in enumerate(mid.rest)]
    return np.array(v, float).reshape(mid.width, mid.width)


# ---- projection


class Whitening(NamedTuple):
    """What projects a vector: the middle, and eigenvectors over the roots of their eigenvalues."""

    mid: Middle
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def differences(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact."""
        n, rest = self.mid.n, self.mid.rest
        if n * (self.mid.reach + 1) < 1 << 62:
            return n * (x - self.mid.middle) - np.array(rest, np.int64)
        return n * (x - self.mid.middle).astype(object) - np.array(rest, object)

    def project(self, d: np.ndarray) -> np.ndarray:
        return (d / float(self.mid.n)).astype(float) @ (self.vectors / np.sqrt(self.values))


def deviations(d: np.ndarray) -> pa.Array:
    """Sums of squares, exact; null where beyond 64 bits."""
    about = (d.astype(float) ** 2).sum(1)
    with np.errstate(over="ignore"):
        exact = (d * d).sum(1) if d.dtype != object else np.zeros(len(d), np.int64)  # right modulo 2**64, so right if it fits
    fits = np.ones(len(d), bool)
    for i in np.flatnonzero((about > 9.2e18) | (d.dtype == object)):
        one = sum(int(x) ** 2 for x in d[i])
        fits[i] = one < 1 << 63
        exact[i] = one if fits[i] else 0
    return pa.array(exact.astype(np.int64), mask=~fits)


def _moments(model: Whitening):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.values)
        total = np.zeros((k + 1, k + 1))  # the last row and column: sums, and the count
        for batch in batches:
            w = model.project(model.differences(matrix(batch.column("embedding"), model.mid.width)[1]))
            w = np.concatenate([w, np.ones((len(w), 1))], 1)
            total += w.T @ w
        yield _cells(total)

    return task


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """How far the covariance of the whitened vectors, taken over all of them, is from the identity."""
    k = len(model.values)
    total = np.array(_square(vectors.mapInArrow(frugal(_moments(model)), "i int, j int, total double"), k + 1), float)
    mean = total[:k, k] / model.mid.n
    return float(np.abs(total[:k, :k] / model.mid.n - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))


def fit(embeddings: DataFrame, components: int = COMPONENTS) -> tuple[Whitening, float]:
    """The whitening of all vectors of a table, and its error over them."""
    vectors = embeddings.select("embedding")
    mid = middle(vectors)
    v = covariance(vectors, mid) if mid.width else np.zeros((0, 0))
    values, x = largest(v, min(components, mid.width))
    model = Whitening(mid, values, x, float(np.trace(v)))
    return model, identity_error(vectors, model) if len(values) else 0.0


def _projector(model: Whitening, error: float):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.values)
        for batch in batches:
            keep, x = matrix(batch.column("embedding"), model.mid.width)
            d = model.differences(x)
            rows = pa.array(np.repeat(np.arange(len(x)), k))
            constant = lambda value, kind: pa.array(np.full(len(rows), value, kind))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").filter(pa.array(keep)).take(rows),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    constant(model.mid.n, np.int64),
                    deviations(d).take(rows),
                    pa.array(model.project(d).ravel()),
                    pa.array(np.tile(model.values / model.trace, len(x))),
                    constant(error, float),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return task


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row per vector and component: its place along the component in units of the component's deviation.

    Vectors that are null, or hold a null, NaN or infinite entry, take no part. Shorter vectors
    count as filled up with zeros. Rows that repeat, or lack, an id are vectors of their own.
    Components without variance are left out, so vectors that are all equal, or an empty
    table, give no rows. Other columns are left out. A deviation beyond 64 bits is null, and
    entries beyond 2**61 after scaling count as that.

    The table is read four times and never shuffled; each task gives a matrix of the width
    squared, twice. The driver holds the sum of these.
    """
    vectors = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    model, error = fit(vectors, components)
    return vectors.mapInArrow(frugal(_projector(model, error)), COLUMNS)
