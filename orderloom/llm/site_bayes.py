"""Quality by hierarchical empirical Bayes.

Each document's own evidence is a log-likelihood ratio from a linear classifier over
its words and characters, trained on a bounded sample of labelled rows. Its site says
what to expect before reading it: hosts are shrunk toward the corpus and paths toward
their host, by strengths estimated from how much hosts differ. The two add up on the
logit scale, for two questions: is the text good, and is it toxic.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import LOWER, frugal, hash_sample, slices, stored, utf8, with_columns

SAMPLE = 12_000  # labelled rows that train the classifier
BUCKETS = 1 << 20
SHAPE = 40  # of the features, the last: shares of character kinds
HEADS = ("good", "toxic")
ROUNDS, RATE, DECAY = 200, 0.1, 1e-5
RARE = 3  # words in fewer sample documents carry no weight
WEAKEST, STRONGEST = 2.0, 1000.0  # prior strength, in documents
GOOD, TOXIC = 0.5, 0.3  # kept from the one on, and below the other
BATCH_BYTES = 4 << 20

_SIGNS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_EDGE = _SIGNS.translate(LOWER)


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashed distinct words (whole text), and shares of characters and of signs."""
    words = {w.strip(_EDGE) for w in text.translate(LOWER).split()}
    words.discard(b"")
    hashed = np.fromiter((zlib.crc32(w) % BUCKETS for w in words), np.int32, len(words))
    raw = np.frombuffer(text, np.uint8)
    kinds = np.bincount(raw, minlength=256)
    n = max(1, len(raw))
    shape = np.zeros(SHAPE)
    shape[: len(_SIGNS)] = np.sqrt(kinds[list(_SIGNS)] / n)
    letters = kinds[65:91].sum(), kinds[97:123].sum()
    shape[32:37] = letters[0] / n, letters[1] / n, kinds[48:58].sum() / n, kinds[128:].sum() / n, kinds[10] / n
    shape[37] = np.log1p(n) / 10
    shape[38] = len(words) / max(1, len(text.split()))
    return np.unique(hashed), shape * 4


def train(found: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray) -> dict[str, np.ndarray]:
    """Logistic weights, a column per head, from the features of labelled texts, by full-batch Adam."""
    w = np.zeros((BUCKETS + SHAPE, 2))
    base = np.clip(y.mean(0), 1e-3, 1 - 1e-3) if len(y) else np.array([0.5, 0.5])
    bias = np.log(base / (1 - base))
    rate = bias.copy()
    if not len(y):
        return {"w": w, "bias": bias, "rate": rate}
    doc = np.repeat(np.arange(len(found), dtype=np.int32), [len(f) for f, _ in found])
    at = np.concatenate([f for f, _ in found])
    df = np.bincount(at, minlength=BUCKETS)
    shape = np.array([s for _, s in found])
    limit = 3 + 0.75 * np.log10(len(y))  # more documents, more words that deviate by chance
    for h in range(2):
        # words whose share of the class deviates from the base rate beyond chance
        share = np.bincount(at, y[:, h][doc], BUCKETS) - df * base[h]
        telling = np.abs(share) / np.sqrt(np.maximum(df, 1) * base[h] * (1 - base[h]))
        kept = np.flatnonzero((df >= RARE) & (telling >= limit))
        place = np.full(BUCKETS, -1)
        place[kept] = np.arange(len(kept))
        use = place[at] >= 0
        rows, columns = doc[use], place[at[use]]
        x = np.zeros(len(kept) + SHAPE + 1)
        m1, m2 = np.zeros_like(x), np.zeros_like(x)
        x[-1] = bias[h]
        for r in range(ROUNDS):
            z = np.bincount(rows, x[columns], len(y)) + shape @ x[-SHAPE - 1 : -1] + x[-1]
            err = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[:, h]
            g = np.concatenate([np.bincount(columns, err[rows], len(kept)), shape.T @ err, [err.sum()]]) / len(y)
            g[:-1] += DECAY * x[:-1]
            m1, m2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g * g
            x -= RATE * (1 - r / ROUNDS) * (m1 / (1 - 0.9 ** (r + 1))) / (np.sqrt(m2 / (1 - 0.99 ** (r + 1))) + 1e-8)
        w[kept, h], w[BUCKETS:, h], bias[h] = x[: len(kept)], x[-SHAPE - 1 : -1], x[-1]
    return {"w": w.astype(np.float32), "bias": bias, "rate": rate}


def evidence(model: dict, text: bytes) -> np.ndarray:
    """Log-likelihood ratio of both heads: the classifier's logit less that of its base rate."""
    hashed, shape = features(text)
    return model["w"][hashed].sum(0) + shape @ model["w"][BUCKETS:] + model["bias"] - model["rate"]


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict[str, np.ndarray]:
    """Train in one task on at most `sample` labelled documents, chosen by hash."""
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
    known = known.groupBy("doc_id").agg(F.max("quality").alias("good"), F.max("toxic").alias("toxic"))
    known = hash_sample(known, sample, "doc_id")
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")  # at most `sample` rows
    rows = rows.groupBy("doc_id", "good", "toxic").agg(F.max("text").alias("text"))  # however often an id repeats

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, y = [], []
        for b in batches:
            found += [features(t) for part in slices(b, "text", BATCH_BYTES) for t in utf8(part.column("text"))]
            y += zip(b.column("good").to_pylist(), b.column("toxic").to_pylist(), strict=True)
        out = io.BytesIO()
        np.savez_compressed(out, **train(found, np.array(y, float).reshape(-1, 2)))
        yield pa.RecordBatch.from_arrays([pa.array([out.getvalue()], pa.binary())], ["model"])

    row = rows.orderBy(F.xxhash64("text")).coalesce(1).mapInArrow(frugal(task), "model binary").first()
    if not row:
        return train([], np.zeros((0, 2)))
    with np.load(io.BytesIO(row["model"])) as z:
        return dict(z)


def weighed(docs: DataFrame, model: dict, host: str, path: str) -> DataFrame:
    """doc_id, host, path and the two log-likelihood ratios, from whole texts."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for b in (part for whole in batches for part in slices(whole, "text", BATCH_BYTES)):
            e = np.array([evidence(m, t) for t in utf8(b.column("text"))]).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("host"), b.column("path"), pa.array(e[:, 0]), pa.array(e[:, 1])],
                ["doc_id", "host", "path", "good_llr", "toxic_llr"],
            )

    rows = docs.select(
        "doc_id", F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"),
        F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"), "text",
    )
    schema = with_columns(rows.drop("text"), "good_llr double, toxic_llr double")
    return rows.mapInArrow(frugal(task), schema)


def logit(p: Column) -> Column:
    p = F.greatest(F.least(p, F.lit(1 - 1e-6)), F.lit(1e-6))
    return F.log(p / (1 - p))


def logistic(z: Column) -> Column:
    return 1 / (1 + F.exp(-z))


def strength(rate: Column, spread: Column, size: Column) -> Column:
    """Documents that a prior counts for, by moments: what sites differ beyond chance."""
    chance = rate * (1 - rate) / size
    beyond = F.greatest(spread - chance, F.lit(1e-9))
    k = rate * (1 - rate) / beyond - 1
    return F.greatest(F.least(F.coalesce(k, F.lit(STRONGEST)), F.lit(STRONGEST)), F.lit(WEAKEST))


def site_priors(known: DataFrame, model: dict) -> DataFrame:
    """host, path and their posterior rates, from all documents.

    A labelled document counts by its label, any other by what its own evidence says
    at the base rate. Paths shrink toward hosts, hosts toward the corpus. Three grouped
    sums, each pre-aggregated; the tables have a row per path.
    """
    for k, h in enumerate(HEADS):
        p = logistic(F.col(f"{h}_llr") + float(model["rate"][k]))
        known = known.withColumn(f"{h}_p", F.coalesce(F.col(h).cast("double"), p))
    sums = [F.sum(f"{h}_p").alias(f"{h}_p") for h in HEADS]
    paths = stored(known.groupBy("host", "path").agg(F.count("*").alias("n"), *sums), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), *[F.sum(f"{h}_p").alias(f"{h}_host") for h in HEADS])
    everything = hosts.agg(
        *[x for h in HEADS for x in (
            (F.sum(f"{h}_host") / F.sum("host_n")).alias(f"{h}_rate"),
            F.var_pop(F.col(f"{h}_host") / F.col("host_n")).alias(f"{h}_spread"),
        )],
        (F.count("*") / F.sum(1 / F.col("host_n"))).alias("size"),
    ).first()
    for h in HEADS:
        rate = F.lit(everything[f"{h}_rate"] if everything[f"{h}_rate"] is not None else 0.5)
        k = strength(rate, F.lit(everything[f"{h}_spread"]), F.lit(everything["size"]))
        hosts = hosts.withColumn(f"{h}_host", (F.col(f"{h}_host") + k * rate) / (F.col("host_n") + k)).withColumn(f"{h}_k", k)
    out = paths.join(hosts, "host")
    return out.select(
        "host", "path",
        *[((F.col(f"{h}_p") + F.col(f"{h}_k") * F.col(f"{h}_host")) / (F.col("n") + F.col(f"{h}_k"))).alias(f"{h}_prior") for h in HEADS],
    )


def judge(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang") -> DataFrame:
    """doc_id, evidence, site priors, posteriors good and toxic, and kept, per row of `docs`.

    Null or empty texts have only their characters' evidence; a missing host or path is a
    site of its own. Without labels the classifier says nothing and every document stays.
    Repeated rows count each time; a document labelled twice takes the larger label.
    """
    model = fit(docs, labels)
    found = stored(weighed(docs, model, host, path), "evidence")
    known = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("good"), F.max("toxic").alias("toxic"))
    priors = site_priors(found.join(known, "doc_id", "left"), model)
    out = found.join(priors, ["host", "path"], "left")
    for h in HEADS:
        out = out.withColumn(f"{h}_posterior", logistic(F.col(f"{h}_llr") + logit(F.col(f"{h}_prior"))))
    trained = bool(np.abs(model["w"]).max() > 0)
    kept = (F.col("good_posterior") >= GOOD) & (F.col("toxic_posterior") < TOXIC) if trained else F.lit(True)
    return out.withColumn("kept", kept)


def digest(judged: DataFrame) -> DataFrame:
    return judged.select("doc_id", "host", "path", "good_prior", "toxic_prior", "good_posterior", "toxic_posterior", "kept")


def keep_good(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang") -> DataFrame:
    """The documents that `judge` keeps, with their columns as they are.

    The texts do not travel: rows are judged where they are read, the site priors
    (a row per path) come to them.
    """
    names = docs.columns
    model = fit(docs, labels)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc_id"), "text", F.col(host).alias("h"), F.col(path).alias("p"))
    light = stored(weighed(docs, model, host, path), "evidence")
    known = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("good"), F.max("toxic").alias("toxic"))
    priors = stored(site_priors(light.join(known, "doc_id", "left"), model), "priors")
    if not np.abs(model["w"]).max() > 0:
        return docs
    again = weighed(whole, model, "h", "p").join(priors, ["host", "path"])
    for h in HEADS:
        again = again.withColumn(f"{h}_posterior", logistic(F.col(f"{h}_llr") + logit(F.col(f"{h}_prior"))))
    again = again.filter((F.col("good_posterior") >= GOOD) & (F.col("toxic_posterior") < TOXIC))
    return again.select(*[F.col(f"doc_id.`{c}`").alias(c) for c in names])
