"""Repeats in a row, found by string synchronising sets.

A run is a stretch of words with a smallest period q that no neighbour extends, of three
periods at least. At scale t = 1, 2, 4, ... a position is chosen if the smallest hash of
t words among it and the t after it is its own or the last one's, leaving aside words of
highly periodic regions: those in runs of period t/3 or less, which smaller scales have
found. The choice looks at 2t words only, so equal stretches choose alike, and a run of
period q holds a chosen position i for which i + q is chosen too, in an equal context of
2t words, as soon as 2q >= 3t - 1. So scale t answers for periods from 1.5t - 0.5 to
3t - 0.5: pairs of equal contexts at such a distance propose a period, and the words
themselves decide how far it reaches. Contexts are compared by 64-bit hashes, which only
propose; what is given out is compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import frugal, mix64, slices, with_columns

LEAST = 24  # words of a run that is given out
BATCH_BYTES = 4 << 20
CELLS = 1 << 21  # words compared at once
NEAR = 4  # up to this scale distances are tried one by one, beyond it contexts are sorted
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)
_ODD = np.uint64(0x9E3779B97F4A7C15)

COLUMNS = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _reach(t: np.ndarray, at: np.ndarray, q: np.ndarray, step: int) -> np.ndarray:
    """From `at` on in steps of +1 or -1, the first place whose word differs from that q later."""
    at = at.copy()
    live, width = np.arange(len(at)), 8
    while len(live):
        still = []
        rows = max(1, CELLS // width)
        for some in (live[s : s + rows] for s in range(0, len(live), rows)):
            x = at[some][:, None] + step * np.arange(width)
            # separators at both ends differ from all, so a place outside comes after a difference
            differ = t[np.clip(x, 0, len(t) - 1)] != t[np.clip(x + q[some][:, None], 0, len(t) - 1)]
            hit = differ.any(1)
            at[some] += step * np.where(hit, differ.argmax(1), width)
            still.append(some[~hit])
        live, width = np.concatenate(still), min(2 * width, 1 << 14)
    return at


def _chosen(h: np.ndarray, periodic: np.ndarray, t: int) -> np.ndarray:
    """The synchronising set at scale t, as a mask."""
    v = np.where(periodic, _TOP, h)
    least, width = v, 1
    while width < t:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    n = len(v) - t
    least = np.minimum(least[:n], v[t:])
    mask = np.zeros(len(v), bool)
    mask[:n] = (least != _TOP) & ((least == v[:n]) | (least == v[t:]))
    return mask


def _pairs(mask: np.ndarray, context: np.ndarray, low: int, high: int, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Chosen positions, and the distances from low to high at which their context comes again."""
    at, distance = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if t <= NEAR:
        for q in range(low, min(high, len(context) - 1) + 1):
            found = np.flatnonzero(mask[:-q] & (context[:-q] == context[q:]))
            at.append(found)
            distance.append(np.full(len(found), q))
    else:
        place = np.flatnonzero(mask)
        order = np.argsort(context[place], kind="stable")
        place, key = place[order], context[place][order]
        # a context has a period above t/3, so within 3t it comes again eight times at most
        first = np.flatnonzero(key[:-1] == key[1:])
        for j in range(1, len(place)):
            first = first[first < len(place) - j]
            first = first[key[first] == key[first + j]]
            gap = place[first + j] - place[first]
            first, gap = first[gap <= high], gap[gap <= high]
            if not len(first):
                break
            at.append(place[first[gap >= low]])
            distance.append(gap[gap >= low])
    return np.concatenate(at), np.concatenate(distance)


def cubic_runs(words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Rows (text, start, length, period) of all runs of three periods or more, in order.

    `words` holds the numbers of the words of all texts one after the other, 0 or more.
    """
    counts = np.asarray(counts, np.int64)
    names = np.arange(len(counts))
    sizes = counts
    ends = np.cumsum(sizes + 1)
    begins = ends - sizes  # where each text begins; a separator of its own stands before each, one after all
    t = np.full(int(ends[-1]) + 1 if len(ends) else 1, -1, np.int64)
    inside = np.ones(len(t), bool)
    inside[begins - 1] = inside[-1] = False
    t[inside] = words
    t[~inside] = -1 - np.arange(int((~inside).sum()))
    h = mix64(t.astype(np.uint64) * _ODD + _ODD)
    found = np.zeros((0, 4), np.int64)
    scale = 1
    while True:
        low, high = max(1, (3 * scale) // 2), (6 * scale - 1) // 2  # 1.5t - 0.5 rounded up, below 3t - 0.5
        keep = sizes >= 3 * low
        if not keep.all():
            # texts too short for this scale go, each with the separator before it
            cells = np.repeat(keep, sizes + 1)
            cells = np.append(cells, True)
            t, h = t[cells], h[cells]
            names, sizes = names[keep], sizes[keep]
            begins = np.cumsum(sizes + 1) - sizes
        if not len(sizes):
            break
        periodic = np.zeros(len(t) + 1, np.int32)
        if len(found):
            where = np.searchsorted(names, found[:, 0])
            known = (where < len(names)) & (names[np.minimum(where, len(names) - 1)] == found[:, 0])
            known &= (3 * found[:, 3] <= scale) & (found[:, 2] >= scale)
            start = begins[where[known]] + found[known, 1]
            np.add.at(periodic, start, 1)
            np.add.at(periodic, start + found[known, 2] - scale + 1, -1)
        mask = _chosen(h, np.cumsum(periodic[:-1]) > 0, scale)
        context = h.copy()
        context[: len(h) - scale] = mix64(h[: len(h) - scale] * _ODD + (h[scale:] ^ (h[scale:] >> np.uint64(29))))
        at, q = _pairs(mask, context, low, high, scale)
        if len(at):
            order = np.lexsort((at, q))
            at, q = at[order], q[order]
            # contexts that meet belong to one stretch
            apart = np.ones(len(at), bool)
            apart[1:] = (q[1:] != q[:-1]) | (at[1:] > at[:-1] + 2 * scale)
            at, q = at[apart], q[apart]
            start, end = _reach(t, at - 1, q, -1) + 1, _reach(t, at, q, 1) + q
            long = end - start >= 3 * q
            start, end, q = start[long], end[long], q[long]
            text = np.searchsorted(begins, start, side="right") - 1
            found = np.concatenate([found, np.stack([names[text], start - begins[text], end - start, q], 1)])
            # a stretch has one smallest period: its multiples reach as far
            found = found[np.lexsort((found[:, 3], found[:, 2], found[:, 1], found[:, 0]))]
            first = np.ones(len(found), bool)
            first[1:] = (found[1:, :3] != found[:-1, :3]).any(1)
            found = found[first]
        h, scale = context, 2 * scale
    return found[np.lexsort((found[:, 3], found[:, 1], found[:, 0]))]


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts one after the other, and how many each text has."""
    split = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
    flat, parent = split.flatten(), pc.list_parent_indices(split)
    real = pc.greater(pc.binary_length(flat), 0)
    counts = np.bincount(parent.filter(real).to_numpy(), minlength=len(texts)).astype(np.int64)
    return flat.filter(real), counts


def _task(least: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                flat, counts = words_of(part.column("text"))
                coded = flat.dictionary_encode().indices.to_numpy().astype(np.int64)
                runs = cubic_runs(coded, counts)
                runs = runs[runs[:, 2] >= least]
                begins = np.cumsum(counts) - counts
                cover = np.zeros(len(flat) + 1, np.int32)
                np.add.at(cover, begins[runs[:, 0]] + runs[:, 1] + runs[:, 3], 1)
                np.add.at(cover, begins[runs[:, 0]] + runs[:, 1] + runs[:, 2], -1)
                kept = np.cumsum(cover[:-1]) == 0
                before = np.concatenate([[0], np.cumsum(kept)])
                limits = before[np.append(begins, len(flat))]
                words = pa.ListArray.from_arrays(pa.array(limits, pa.int32()), flat.filter(pa.array(kept)))
                each = np.searchsorted(runs[:, 0], np.arange(len(counts) + 1))
                fields = [pa.array(np.ascontiguousarray(runs[:, k])) for k in (1, 2, 3)]
                lists = pa.ListArray.from_arrays(
                    pa.array(each, pa.int32()), pa.StructArray.from_arrays(fields, ["start", "length", "period"])
                )
                arrays = [*part.columns, pa.array(counts), lists, pc.binary_join(words, pa.scalar(" ", pa.large_string())).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, [*part.schema.names, "n_words", "runs", "collapsed"])

    return rows


def collapse(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_words, the runs of each text by start, then period, and the text without their repeats.

    A run counts if it has `least` words and three periods. Of a run its first period stays;
    `collapsed` is what stays of the whole text, joined by single blanks, so a text without runs
    keeps all its words. A null, empty or blank text has no words, no runs and an empty
    `collapsed`. Rows with the same or no id are judged one by one; other columns are left out,
    whatever their names. No shuffle: a task holds a few megabytes of texts, or one whole text.
    """
    rows = docs.select("doc_id", "text")
    schema = with_columns(rows.select("doc_id", F.col("text").cast("string").alias("text")), COLUMNS)
    return rows.mapInArrow(frugal(_task(least)), schema).drop("text")


def with_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and text, a tenth of the texts turned periodic from some word on, as the query wants it.

    With h the CRC-32 of the id in decimal digits and g = floor(h / 10), a text of n words with
    h % 10 = 0 repeats p = 1 + floor((n - a) / (3 + g % 8)) words from word a = g % n to its end.
    Blank and null texts, and rows without id, stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    chosen = (h % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    g = F.floor(h / 10)

    def repeated(w: Column) -> Column:
        n = F.size(w)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
        return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(w, place(i).cast("int")))

    # an array of one array: its words are split once, not once a word
    text = F.concat_ws(" ", F.flatten(F.transform(F.array(words), repeated)))
    return docs.select("doc_id", F.when(chosen, text).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """One row per document: the number of runs, the one of the highest exponent, and checksums."""
    rank = lambda r: F.struct(
        (r["length"] / r["period"]).alias("exponent"), (-r["start"]).alias("s"), (-r["period"]).alias("p"), r["length"].alias("length")
    )
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    best = F.array_max(F.transform("runs", rank))
    lines = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select("doc_id", "runs", "collapsed", best.alias("best"), lines.alias("lines")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.expr("(1000 * best.length) div (-best.p)").alias("exponent_milli"),
        F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
