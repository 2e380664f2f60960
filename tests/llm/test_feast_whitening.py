from __future__ import annotations

import math
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from orderloom.llm import feast_whitening as feast
from orderloom.llm.queries import registered


def brute(rows, k=32):
    """Ids, n, deviations, eigenvalues, trace and whole vectors, by exact arithmetic up to the covariance."""
    kept = [(i, v) for i, v in rows if v is not None and not any(x is None or not math.isfinite(x) for x in v)]
    width = max((len(v) for _, v in kept), default=0)
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] + [1_000_000] * (width - len(v)) for _, v in kept]
    n = len(x)
    sums = [sum(c) for c in zip(*x, strict=True)]
    centred = [[n * c - s for c, s in zip(v, sums, strict=True)] for v in x]
    v = [[float(Fraction(sum(c[i] * c[j] for c in centred), n**3)) for j in range(width)] for i in range(width)]
    return [i for i, _ in kept], n, [sum(c * c for c in r) for r in centred], np.array(centred, float) / max(n, 1), np.array(v).reshape(width, width)


def check(got, rows, k=32):
    ids, n, deviation, centred, v = brute(rows, k)
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    count = int((e[:k] > 1e-12 * max(e.max(initial=0), 1e-300)).sum())
    e, u = e[:count], u[:, :count]
    assert len(got) == len(ids) * count
    assert Counter((r.vec_id, r.deviation, r.n) for r in got if r.component == 1) == (Counter((i, d, n) for i, d in zip(ids, deviation, strict=True)) if count else Counter())
    by_id = defaultdict(dict)
    for r in got:
        if Counter(ids)[r.vec_id] == 1:
            by_id[r.vec_id][r.component] = r
    for a, i in enumerate(ids):
        if i not in by_id:
            continue
        assert sorted(by_id[i]) == list(range(1, count + 1))
        w = np.array([by_id[i][c].whitened for c in range(1, count + 1)])
        # eigenvectors of equal eigenvalues may turn, but lengths stay
        assert np.isclose((w**2).sum(), ((centred[a] @ u / np.sqrt(e)) ** 2).sum(), rtol=1e-6, atol=1e-9)
    for r in got:
        assert math.isclose(r.explained, e[r.component - 1] / np.trace(v), rel_tol=1e-6)
        assert 0 <= r.identity_error < 1e-6
    return by_id, ids, centred @ u / np.sqrt(e) if count else None, e


def test_given_vectors(spark, sf_dir, table):
    rows = [(r.vec_id, r.embedding) for r in table("embeddings").collect()]
    got = registered()["op11_feast"](spark, sf_dir).collect()
    by_id, ids, want, e = check(got, rows)
    assert len(e) == 32 and np.diff(e).max() < 0
    w = np.array([[by_id[i][c].whitened for c in range(1, 33)] for i in ids])
    sign = np.sign((w * want).sum(0))
    assert np.abs(w * sign - want).max() < 1e-7
    cov = w.T @ w / len(w) - np.outer(w.mean(0), w.mean(0))
    assert np.abs(cov - np.eye(32)).max() < 1e-9


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0, 0.5]), (0, [1.0, 1.0, 0.5]), (1, None), (2, [nan, 1.0, 1.0]), (3, [inf, 0.0, 0.0]), (4, [None, 1.0, 1.0]), (5, [0.0, 0.0, 0.0]),
            (6, [-1.0, 3.0, 9.25]), (6, [-1.0, 3.0, 9.25]), (20, [5.0]), (21, []), (None, [1.0, 1.0, 1.0]), (40, [1e4, -1e4, 3.0])]
    names = "1 AS component", "2 AS n", "3 AS whitened", "4 AS place", "5 AS total"
    for split in (1, 5):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", *names).repartition(split)
        check(feast.whiten(df).collect(), rows)
    assert feast.whiten(df.limit(0)).collect() == []
    assert feast.whiten(df.filter("vec_id = 21 OR vec_id = 5")).collect() == []  # all zeros: no variance
    assert feast.whiten(df.filter("vec_id = 40")).collect() == []
    assert feast.whiten(df.filter("vec_id = 21 OR vec_id = 2")).collect() == []  # no entries at all
    assert {r.component for r in feast.whiten(df, components=2).collect()} == {1, 2}


@pytest.mark.parametrize("size", [1e9, 1e17, 3e38])
def test_very_large_entries(spark, size):
    """No overflow: sums stay exact, a deviation that no long holds is null."""
    rows = [(i, [size * (i % 3 - 1), float(i % 5), 1.0]) for i in range(30)]
    got = feast.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert len(got) % 30 == 0 and len(got) >= 30
    assert all(r.identity_error < 1e-6 and math.isfinite(r.whitened) for r in got)
    x = [int(min(max(math.floor(64 * float(np.float32(v[0]))), -(2**61)), 2**61)) for _, v in rows]
    dev = {i: (30 * x[i] - sum(x)) ** 2 for i in range(30)}
    for r in got:
        if dev[r.vec_id] > 2**63:
            assert r.deviation is None


def spectra():
    rng = np.random.default_rng(5)
    q, _ = np.linalg.qr(rng.standard_normal((48, 48)))
    return {
        "falling": np.geomspace(1, 1e-3, 48),
        "flat": np.full(48, 7.0),
        "clusters": np.repeat([5.0, 3.0, 1.0], 16),
        "pairs": np.repeat(np.arange(24, 0, -1.0), 2),
        "close": 1 + 1e-7 * np.arange(48)[::-1],
        "few": np.r_[[9.0, 4.0, 1e-3], np.zeros(45)],
        "wide": np.geomspace(1e12, 1, 48),
        "none": np.zeros(48),
    }, q


@pytest.mark.parametrize("name", sorted(spectra()[0]))
def test_none_is_missed(name):
    values, q = spectra()
    v = q @ np.diag(values[name]) @ q.T
    v = (v + v.T) / 2
    e, x = feast.largest(v, 32)
    want = np.linalg.eigvalsh(v)[::-1][:32]
    want = want[want > 1e-13 * max(want.max(), 1e-300)] if name != "none" else want[:0]
    if name == "few":
        want = want[:3]
    assert len(e) == len(want)
    if len(e):
        assert np.abs(e - want).max() < 1e-13 * want[0]
        assert np.abs(x.T @ x - np.eye(len(e))).max() < 1e-13
        assert np.abs(v @ x - x * e).max() < 2e-14 * want[0]
    parts = feast.intervals(v, 32)
    assert sum(n for *_, n in parts) >= len(want)
    for low, high, n in parts:
        assert n == ((want > low) & (want <= high)).sum() or sum(p[2] for p in parts) > 32


@pytest.mark.parametrize("seed", range(40))
def test_inertia(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 30))
    a = rng.standard_normal((n, n)) * (10.0 ** rng.integers(-3, 4, n))
    a = np.round(a + a.T) if seed % 3 == 0 else a + a.T
    if seed % 4 == 0:
        a -= np.diag(np.diag(a))  # pivots of two rows only
    x = float(rng.standard_normal()) + 0.0137
    assert feast.above(a, x) == (np.linalg.eigvalsh(a) > x).sum()
    assert feast.negatives(a - x * np.eye(n)) == (np.linalg.eigvalsh(a) < x).sum()


def test_the_filter_keeps_the_interval():
    """One projection leaves eigenvectors inside as they are, and shrinks those outside."""
    values = np.array([0.1, 0.5, 1.0, 2.0, 2.2, 2.4, 4.0, 9.0])
    y = feast.project(np.diag(values), np.eye(8), 1.9, 2.5)
    kept = np.abs(np.diag(y))
    assert (np.abs(kept[3:6] - 1) < 0.2).all() and (kept[[0, 1, 2, 6, 7]] < 1e-3).all()
