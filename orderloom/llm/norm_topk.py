"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are grouped by length into small buckets. For a bucket whose longest vector has
length L, a query with k-th best score t so far needs a cosine of t / (|q| L) at least:
above 1 the bucket is passed over; where it is large, the query's largest coordinate
bounds what a match can look like; else only vectors that are long enough are taken.
The products of what is left are computed exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import stored

K = 20
EVERY = 20  # ids divisible by this are queries
SCALE = 64
BUCKET = 256
STRIPE = 8192  # vectors that one task searches
QUERIES = 1024  # queries that it searches for
STEEP = 0.5  # local cosines from here on prune by coordinate
SAFE = 1e-9  # floating-point slack of a bound


def integers(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and v, whole numbers floor(scale * x), a row per vector; those with null or non-finite parts go."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = embeddings.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", finite))
    whole = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows, shorter ones filled up with zeros."""
    out = np.zeros((len(column), width), np.int64)
    for i, v in enumerate(column.to_pylist()):
        out[i, : len(v)] = v
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact a @ b.T: in doubles where every sum fits in 53 bits, in Python's integers beyond 63, cut to 64 bits."""
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if bound < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound < 2**63:
        return a @ b.T
    return np.clip(a.astype(object) @ b.astype(object).T, -(2**63), 2**63 - 1).astype(np.int64)


def search(q: np.ndarray, q_row: np.ndarray, p: np.ndarray, p_row: np.ndarray, p_id: np.ndarray, k: int):
    """The k best of p for each of q but its own row: scores and ids, ties to the smaller id; the largest id fills up."""
    n = len(q)
    best = np.full((n, k), np.iinfo(np.int64).min)
    best_id = np.full((n, k), np.iinfo(np.int64).max)
    q_len, p_len = np.sqrt((q.astype(float) ** 2).sum(1)), np.sqrt((p.astype(float) ** 2).sum(1))
    order = np.argsort(-p_len, kind="stable")
    focus = np.abs(q).argmax(1) if q.shape[1] else np.zeros(n, np.int64)
    share = np.divide(q[np.arange(n), focus] if q.shape[1] else 0.0, q_len, out=np.zeros(n), where=q_len > 0)
    for s in range(0, len(order), BUCKET):
        rows = order[s : s + BUCKET]
        longest = p_len[rows[0]]
        have = best[:, -1] > np.iinfo(np.int64).min
        bar = np.where(have, best[:, -1].astype(float), -np.inf)
        reach = q_len * longest
        local = np.where(reach > 0, bar / np.where(reach > 0, reach, 1), np.where(bar > 0, np.inf, -np.inf))
        live = np.flatnonzero(local <= 1 + SAFE)
        if not len(live):
            continue
        # length: |p| >= t / |q|
        need = np.where(q_len[live] > 0, bar[live] / np.where(q_len[live] > 0, q_len[live], 1), -np.inf)
        mask = p_len[rows][None, :] >= need[:, None] * (1 - SAFE) - SAFE
        # coordinate: a unit vector within the local cosine of q has its part along q's largest in a range
        steep = np.flatnonzero(local[live] >= STEEP)
        if len(steep) and longest > 0:
            c, f = np.minimum(local[live][steep], 1.0), share[live][steep]
            half = np.sqrt(np.maximum(0, (1 - c * c) * (1 - f * f)))
            unit = p[rows][:, focus[live][steep]].T / np.maximum(p_len[rows], 1e-300)[None, :]
            bottom = np.where(f < -c, -1.0, c * f - half)
            top = np.where(f > c, 1.0, c * f + half)
            mask[steep] &= (unit >= bottom[:, None] - 1e-7) & (unit <= top[:, None] + 1e-7)
        alive = mask.any(1)
        live, mask = live[alive], mask[alive]
        columns = np.flatnonzero(mask.any(0))
        if not len(live):
            continue
        score = products(q[live], p[rows[columns]])
        ident = np.broadcast_to(p_id[rows[columns]], score.shape)
        use = mask[:, columns] & (p_row[rows[columns]][None, :] != q_row[live][:, None])
        score = np.where(use, score, np.iinfo(np.int64).min)
        ident = np.where(use, ident, np.iinfo(np.int64).max)
        both, ids = np.concatenate([best[live], score], 1), np.concatenate([best_id[live], ident], 1)
        pick = np.lexsort((ids, ~both), axis=-1)
        best[live], best_id[live] = np.take_along_axis(both, pick[:, :k], 1), np.take_along_axis(ids, pick[:, :k], 1)
    return best, best_id


def searcher(k: int):
    def task(keys, table):
        width = max([len(v) for v in table.column("v").to_pylist()], default=0)
        asks = table.column("ask").to_numpy(zero_copy_only=False)
        v, ident, rows = matrix(table.column("v"), width), table.column("vec_id").to_numpy(), table.column("row").to_numpy()
        order = np.lexsort((rows, ident))
        q, p = order[asks[order]], order[~asks[order]]
        best, best_id = search(v[q], rows[q], v[p], rows[p], ident[p], k)
        real = best > np.iinfo(np.int64).min
        row, column = np.nonzero(real)
        return pa.table({"query": rows[q][row], "query_id": ident[q][row], "vec_id": best_id[row, column], "score": best[row, column]})

    return task


def top_k(embeddings: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k highest integer products.

    Vectors are dealt by hash into stripes of a bounded size and queries into blocks; a
    task gets one stripe and one block, so each vector travels once per block of queries
    and each query once per stripe, and equal vectors spread over all stripes. A task
    gives k rows per query. Vectors of different width compare as if filled up with zeros.
    Rows that repeat an id are vectors of their own: each asks, and each is found by the others.
    An empty table, or one without queries, gives no rows.
    """
    rows = stored(integers(embeddings, scale).withColumn("row", F.monotonically_increasing_id()), "vectors")
    asking = rows.filter(F.col("vec_id") % every == 0)
    n, n_ask = rows.count(), asking.count()
    stripes, blocks = max(1, -(-n // STRIPE)), max(1, -(-n_ask // QUERIES))
    deal = lambda m, salt: F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(m)).cast("int")
    probes = rows.withColumn("stripe", deal(stripes, 1)).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asks = asking.withColumn("block", deal(blocks, 2)).withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))))
    columns = ["stripe", "block", "row", "vec_id", "v"]
    cells = probes.select(*columns, F.lit(False).alias("ask")).unionByName(asks.select(*columns, F.lit(True).alias("ask")))
    found = cells.groupBy("stripe", "block").applyInArrow(searcher(k), "query long, query_id long, vec_id long, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
