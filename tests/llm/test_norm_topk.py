from __future__ import annotations

import math

import numpy as np
import pytest
from orderloom.llm import norm_topk
from orderloom.llm.queries import registered


def brute(rows, k=20, every=20, scale=64):
    vectors = [
        (i, [math.floor(scale * float(x)) for x in v])
        for i, v in rows
        if i is not None and v is not None and not any(x is None or not math.isfinite(x) for x in v)
    ]
    out = []
    for a, (q, v) in enumerate(vectors):
        if q % every == 0:
            score = sorted((-sum(x * y for x, y in zip(v, w, strict=False)), j) for b, (j, w) in enumerate(vectors) if b != a)
            out += [(q, n, j, -s) for n, (s, j) in enumerate(score[:k], 1)]
    return sorted(out)


def rows_of(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


def test_given_vectors(spark, sf_dir, table):
    rows = [(r.vec_id, r.embedding) for r in table("embeddings").collect()]
    assert rows_of(registered()["op5_norm_topk"](spark, sf_dir)) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 1.0]), (1, None), (2, [nan, 1.0]), (3, [inf, 0.0]), (4, [None, 1.0]), (5, [0.0, 0.0]), (6, [-1.0, 3.0]),
            (7, [-1.0, 3.0]), (20, [5.0]), (21, []), (None, [1.0, 1.0]), (40, [1e6, -1e6]), (-20, [0.015, -0.015])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS score", "2 AS rank", "3 AS v", "4 AS block", "5 AS row", "6 AS query")
    assert rows_of(norm_topk.top_k(df)) == brute(rows)
    assert rows_of(norm_topk.top_k(df.limit(0))) == []


@pytest.mark.parametrize("kind", ["unit", "skewed", "equal", "steep", "huge"])
def test_pruning_loses_nothing(kind):
    rng = np.random.default_rng(len(kind))
    p = rng.standard_normal((3000, 16)) * 10
    if kind == "skewed":
        p *= rng.pareto(1.0, (3000, 1)) + 0.01
    if kind == "equal":
        p[:1500] = p[0]
    if kind == "steep":
        p = rng.standard_normal((6, 16))[rng.integers(0, 6, 3000)] * 40 + rng.standard_normal((3000, 16))
    if kind == "huge":
        p *= 2e7  # sums beyond 53 bits, within 64
    p = np.floor(p).astype(np.int64)
    ident = rng.permutation(3000)
    q = rng.integers(0, 3000, 50)
    best, best_id = norm_topk.search(p[q], q, p, np.arange(3000), ident, 20)
    for r, i in enumerate(q):
        score = [-sum(int(a) * int(b) for a, b in zip(p[i], v, strict=True)) for v in p]
        want = sorted((s, int(j)) for s, j in zip(score, ident, strict=True) if j != ident[i])[:20]
        assert [(-s, j) for s, j in zip(best[r].tolist(), best_id[r].tolist(), strict=True)] == want


def test_rows_of_one_id_are_vectors_of_their_own(spark):
    rows = [(1, [1.0, 0.0]), (1, [5.0, 0.0]), (20, [1.0, 1.0]), (20, [2.0, 0.0]), (20, [2.0, 0.0]), (3, [0.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = rows_of(norm_topk.top_k(df))
    assert got == brute(rows) and len(got) == 15


def test_stripes_and_blocks_do_not_matter(spark, table, monkeypatch):
    whole = rows_of(norm_topk.top_k(table("embeddings")))
    monkeypatch.setattr(norm_topk, "STRIPE", 60)
    monkeypatch.setattr(norm_topk, "QUERIES", 3)
    assert rows_of(norm_topk.top_k(table("embeddings"))) == whole
