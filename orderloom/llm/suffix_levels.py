"""Removal of byte strings that occur twice, with a logarithmic family of suffix arrays.

Two equal strings of `LENGTH` bytes choose the same anchor: the first of the smallest
hashes of their `GRAM`-byte substrings. So it is enough to index one suffix per anchor,
about one in 76. Suffixes are ordered by the hash of their first `GRAM` bytes; the key
ranges go to different tasks, and each task keeps a family of sorted arrays: every new
batch of suffixes becomes an array, is merge-scanned against all arrays there are, and
arrays of equal size merge, so that there are only logarithmically many.

All strings around an anchor lie in its context. A context that occurs twice is repeated
as a whole. Where contexts of one anchor differ, as near an edit, their strings
are compared one by one by a second family.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import binaries, mix64, slices, stored, utf8, with_columns

LENGTH = 200
GRAM = 50
CHUNK = 1 << 20  # bytes hashed at once; positions in it take 20 bits
BATCH_BYTES = 4 << 20  # of texts that a task holds as Python objects

_TABLE = np.random.default_rng(7).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
POSTING = np.dtype([("row", "<i8"), ("start", "<u4"), ("size", "<u2"), ("anchor", "<u2")])


@cache
def powers() -> tuple[np.ndarray, np.ndarray]:
    """Of the base and of its inverse modulo 2**64."""
    one = np.ones(1, np.uint64)
    up = np.cumprod(np.concatenate([one, np.full(CHUNK, _BASE, np.uint64)]))
    return up, np.cumprod(np.concatenate([one, np.full(CHUNK, pow(_BASE, -1, 2**64), np.uint64)]))


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * powers()[0][: len(data)], out=out[1:])
    return out


def hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Of the strings between start and end, wherever they stand."""
    return mix64((prefix[end] - prefix[start]) * powers()[1][start])


def window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    out, step = values, 1
    while step * 2 <= width:
        out = np.minimum(out[:-step], out[step:])
        step *= 2
    return np.minimum(out[: len(out) - (width - step)], out[width - step :]) if width > step else out


def runs(data: np.ndarray, first: np.ndarray, last: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Runs of strings with one anchor, in pieces of text [first, last) of one buffer.

    Gives the anchor's key, the context's digest, the first string's start, the context's
    size and the anchor's place in it.
    """
    none = np.zeros(0, np.int64)
    fit = last - first >= length
    if not fit.any():
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none
    prefix = prefix_hashes(data)
    n = len(data)
    at = np.arange(n - gram + 1)
    gram_hash = hashes(prefix, at, at + gram)
    low = np.uint64(CHUNK - 1)
    packed = window_minimum((gram_hash & ~low) | at.astype(np.uint64), length - gram + 1)
    anchor = (packed & low).astype(np.int64)
    edges = np.zeros(n + 1, np.int32)
    np.add.at(edges, first[fit], 1)
    np.add.at(edges, last[fit] - length + 1, -1)
    inside = np.cumsum(edges)[: len(anchor)] > 0
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1])]))
    stop = np.concatenate([new[1:], [len(anchor)]]) - 1
    start, stop = new[inside[new]], stop[inside[new]]
    a, end = anchor[start], stop + length
    digest = hashes(prefix, start, end)
    digest = mix64(digest ^ mix64((a - start).astype(np.uint64) << np.uint64(20) | (end - start).astype(np.uint64)))
    return gram_hash[a], digest, start, end - start, a - start


def pieces(texts: list[bytes], length: int) -> Iterator[tuple[bytes, list[tuple[int, int, int]]]]:
    """Buffers of at most CHUNK bytes, and in each (text, its offset there, start in the text).

    A text that doesn't fit is cut into pieces that overlap by length - 1, so that each
    string lies in exactly one of them.
    """
    held: list[bytes] = []
    where: list[tuple[int, int, int]] = []
    size = 0
    for k, text in enumerate(texts):
        step = CHUNK - length
        starts = range(0, max(1, len(text) - length + 1), step) if len(text) > CHUNK - 1 else (0,)
        for s in starts:
            part = text[s : s + step + length - 1] if len(text) > CHUNK - 1 else text
            if size + len(part) >= CHUNK:
                yield b"".join(held), where
                held, where, size = [], [], 0
            where.append((k, size, s))
            held.append(part)
            size += len(part)
    if held:
        yield b"".join(held), where


def suffixes(length: int, gram: int):
    """The task: texts to (key, digest, n, postings), one row per context and batch."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column("row").to_numpy()
            keys, digests, posts = [], [], []
            for buffer, where in pieces(utf8(batch.column("text")), length):
                doc, first, offset = np.array(where, np.int64).T
                last = np.concatenate([first[1:], [len(buffer)]])
                key, digest, start, size, anchor = runs(np.frombuffer(buffer, np.uint8), first, last, length, gram)
                piece = np.searchsorted(first, start, "right") - 1
                post = np.empty(len(key), POSTING)
                post["row"], post["start"] = row[doc[piece]], start - first[piece] + offset[piece]
                post["size"], post["anchor"] = size, anchor
                keys.append(key)
                digests.append(digest)
                posts.append(post)
            if not keys:
                continue
            key, digest, post = np.concatenate(keys), np.concatenate(digests), np.concatenate(posts)
            order = np.lexsort((digest, key))
            key, digest, post = key[order], digest[order], post[order]
            new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (digest[1:] != digest[:-1])])) if len(key) else np.zeros(0, np.int64)
            ends = np.concatenate([new, [len(key)]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[new].view(np.int64)), pa.array(digest[new].view(np.int64)), binaries(post, ends * POSTING.itemsize)],
                ["key", "digest", "postings"],
            )

    return task


class Family:
    """Sorted arrays of geometrically growing sizes; notes which values come twice."""

    def __init__(self) -> None:
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []  # rank, values, numbers
        self.twice = np.zeros(0, bool)

    def add(self, values: np.ndarray) -> None:
        """A new batch: sort it, scan it against every level, let equal levels merge."""
        base = len(self.twice)
        self.twice = np.concatenate([self.twice, np.zeros(len(values), bool)])
        order = np.argsort(values, kind="stable")
        values, number = values[order], order + base
        same = np.concatenate([[False], values[1:] == values[:-1], [False]])
        self.twice[number] |= same[1:] | same[:-1]
        for _, old, old_number in self.levels:
            low, high = np.searchsorted(old, values, "left"), np.searchsorted(old, values, "right")
            hit = low < high
            self.twice[number[hit]] = True
            cover = np.zeros(len(old) + 1, np.int64)
            np.add.at(cover, low[hit], 1)
            np.add.at(cover, high[hit], -1)
            self.twice[old_number[np.cumsum(cover[:-1]) > 0]] = True
        self.levels.append((0, values, number))
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (rank, a, x), (_, b, y) = self.levels.pop(), self.levels.pop()
            values, number = np.concatenate([b, a]), np.concatenate([y, x])
            order = np.argsort(values, kind="stable")  # merges two sorted runs
            self.levels.append((rank + 1, values[order], number[order]))


RUNS = "kind int, row long, start long, size int, anchor int, key long"
REPEATED, APART, PARTNER = 0, 1, 2


def matcher(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts of one key range to repeated runs, runs that must be looked into, and partners."""
    anchors, contexts = Family(), Family()
    keys, posts, counts = [], [], []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column("key").to_numpy().view(np.uint64)
        digest = batch.column("digest").to_numpy().view(np.uint64)
        raw = [np.frombuffer(x, POSTING) for x in batch.column("postings").to_pylist()]
        anchors.add(key)
        contexts.add(mix64(key ^ mix64(digest)))
        keys.append(np.stack([key, mix64(key ^ mix64(digest))]))
        counts.append(np.fromiter(map(len, raw), np.int64, len(raw)))
        posts.append(np.concatenate(raw))
    if not keys:
        return
    (key, context), count, post = np.concatenate(keys, 1), np.concatenate(counts), np.concatenate(posts)
    first = np.cumsum(count) - count
    full = contexts.twice | (count > 1)
    apart = anchors.twice & ~full
    mixed = np.unique(key[apart])
    # one run of each repeated context whose anchor also has others
    partner = np.flatnonzero(full & np.isin(key, mixed))
    partner = partner[np.unique(context[partner], return_index=True)[1]]
    every = np.repeat(full, count)
    for kind, which, of in (
        (REPEATED, np.unique(post[every]), None),
        (APART, post[first[apart]], key[apart]),
        (PARTNER, post[first[partner]], key[partner]),
    ):
        n = len(which)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, kind, np.int32)), pa.array(which["row"].astype(np.int64)), pa.array(which["start"].astype(np.int64)),
                pa.array(which["size"].astype(np.int32)), pa.array(which["anchor"].astype(np.int32)),
                pa.array(np.zeros(n, np.int64) if of is None else of.view(np.int64)),
            ],
            ["kind", "row", "start", "size", "anchor", "key"],
        )


def cutter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts and their runs to the bytes of each run."""
    for batch in (part for whole in batches for part in slices(whole, "text", BATCH_BYTES)):
        rows, texts, found = batch.column("row").to_pylist(), utf8(batch.column("text")), batch.column("runs").to_pylist()
        out = [(r, x, t[x["start"] : x["start"] + x["size"]]) for r, t, f in zip(rows, texts, found, strict=True) for x in f]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([x["key"] for _, x, _ in out], pa.int64()), pa.array([r for r, _, _ in out], pa.int64()),
                pa.array([x["start"] for _, x, _ in out], pa.int64()), pa.array([x["kind"] == APART for _, x, _ in out], pa.bool_()),
                pa.array([c for *_, c in out], pa.binary()),
            ],
            ["key", "row", "start", "apart", "context"],
        )


def prober(length: int):
    """Contexts of one key range, string by string: which strings occur in two of them."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = Family()
        rows, starts = [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column("key").to_numpy().view(np.uint64)
            context = batch.column("context").to_pylist()
            values = []
            for s in range(0, len(context), 1024):  # a context has under 2 * length bytes
                part = context[s : s + 1024]
                size = np.fromiter(map(len, part), np.int64, len(part))
                first = np.cumsum(size) - size
                prefix = prefix_hashes(np.frombuffer(b"".join(part), np.uint8))
                n = size - length + 1
                at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                values.append(mix64(hashes(prefix, at, at + length) ^ np.repeat(key[s : s + 1024], n)))
                ask = np.repeat(batch.column("apart").to_numpy(zero_copy_only=False)[s : s + 1024], n)
                rows.append(np.where(ask, np.repeat(batch.column("row").to_numpy()[s : s + 1024], n), -1))
                starts.append(np.where(ask, at - np.repeat(first, n) + np.repeat(batch.column("start").to_numpy()[s : s + 1024], n), -1))
            family.add(np.concatenate(values))
        if not rows:
            return
        row, start = np.concatenate(rows), np.concatenate(starts)
        hit = family.twice & (start >= 0)
        row, start = row[hit], start[hit]
        order = np.lexsort((start, row))
        row, start = row[order], start[order]
        new = np.concatenate([[True], (row[1:] != row[:-1]) | (start[1:] > start[:-1] + length)]) if len(row) else np.zeros(0, bool)
        at = np.flatnonzero(new)
        end = np.concatenate([start[at[1:] - 1], start[-1:]]) + length if len(row) else start
        yield pa.RecordBatch.from_arrays([pa.array(row[at]), pa.array(start[at]), pa.array(end)], ["row", "start", "end"])

    return task


def remover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts and intervals to the bytes that stay and the merged runs that go."""
    spans_type = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))
    for batch in (part for whole in batches for part in slices(whole, "text", BATCH_BYTES)):
        kept, spans = [], []
        texts = utf8(batch.column("text"))
        for text, found in zip(texts, batch.column("spans").to_pylist(), strict=True):
            merged: list[list[int]] = []
            for s, e in sorted((x["s"], x["e"]) for x in found or ()):
                if merged and s <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], e)
                else:
                    merged.append([s, e])
            at = [0, *(x for m in merged for x in m), len(text)]
            kept.append(b"".join(text[a:b] for a, b in zip(at[::2], at[1::2], strict=True)))
            spans.append([{"s": s, "e": e} for s, e in merged])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(spans, spans_type), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "spans", "kept"],
        )


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, spans (s, e) of removed bytes and the kept bytes, per row of `docs`.

    A byte goes if a string of `length` bytes over it starts at another place too, in
    this or another document. Null and empty texts have no bytes; texts shorter than
    `length` stay whole; a row that repeats another one goes as far as it is long enough.

    Shuffles: anchors by key, with equal contexts of a batch in one row, so a hot text
    sends one row per task and context; texts twice, to where their runs are. A key
    range is a bounded share of the anchors, and only postings of a key meet in a task.
    """
    texts = docs.select(F.xxhash64("doc_id", "text").alias("row"), "doc_id", "text")
    suffix = texts.select("row", "text").mapInArrow(suffixes(length, gram), "key long, digest long, postings binary")
    found = stored(suffix.repartition("key").mapInArrow(matcher, RUNS), "runs")
    asked = found.filter(F.col("kind") != REPEATED).groupBy("row").agg(F.collect_set(F.struct("kind", "start", "size", "anchor", "key")).alias("runs"))
    source = texts.select("row", "text").join(asked, "row")
    contexts = source.mapInArrow(cutter, "key long, row long, start long, apart boolean, context binary")
    probed = contexts.repartition("key").mapInArrow(prober(length), "row long, start long, end long")
    whole = found.filter(F.col("kind") == REPEATED).select("row", "start", (F.col("start") + F.col("size")).alias("end"))
    spans = whole.unionByName(probed).groupBy("row").agg(F.collect_list(F.struct(F.col("start").alias("s"), F.col("end").alias("e"))).alias("spans"))
    rows = texts.join(spans, "row", "left").select("doc_id", "text", "spans")
    schema = with_columns(docs.select("doc_id"), "n_bytes long, spans array<struct<s:long,e:long>>, kept binary")
    return rows.mapInArrow(remover, schema)


def digest(cleaned: DataFrame) -> DataFrame:
    """The per-document report."""
    return cleaned.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
