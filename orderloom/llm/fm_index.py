"""Benchmark decontamination with an FM-index per shard of the documents.

A task indexes the words of a few megabytes of documents: suffix array by prefix
doubling, the column of preceding words in a wavelet matrix, every `SAMPLE`-th suffix
position. All windows of the test items are searched backward together, each step two
ranks; hits are located by walking to a sampled position and merged into spans.

Words that no item holds cannot lie in a match, so only runs of the items' words that
are long enough for the shortest window enter the index; each run ends in a separator.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import frugal, slices, utf8, with_columns

WINDOW = 10
SAMPLE = 16
SHARD_BYTES = 8 << 20
BLOCK_BYTES = 4 << 20  # of test items that are sent to the tasks at once
LOCATE = 1 << 20  # occurrences walked at once

# Lower case, and a blank for every ASCII character that is neither digit nor letter.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text: bytes) -> list[bytes]:
    """Lower-cased words, as UTF-8."""
    return text.translate(WORD_BYTES).split()


class WaveletMatrix:
    """Ranks of small integers over a sequence, in packed bits."""

    def __init__(self, values: np.ndarray, symbols: int) -> None:
        self.n, self.bits = len(values), max(1, int(symbols - 1).bit_length())
        self.levels = []
        v = values.astype(np.int64)
        for b in reversed(range(self.bits)):
            ones = (v >> b) & 1
            packed = np.zeros((self.n // 64 + 1) * 8, np.uint8)
            packed[: (self.n + 7) // 8] = np.packbits(ones.astype(np.uint8), bitorder="little")
            block = packed.view("<u8")
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(block).astype(np.int64))])
            self.levels.append((b, block, before, self.n - int(ones.sum())))
            v = np.concatenate([v[ones == 0], v[ones == 1]])

    def _ones(self, level, i: np.ndarray) -> np.ndarray:
        _, block, before, _ = level
        at = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return before[at] + np.bitwise_count(block[at] & mask).astype(np.int64)

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often symbol[k] is among the first i[k] values."""
        start, end = np.zeros_like(i), i.copy()
        for level in self.levels:
            one = (symbol >> level[0]) & 1 == 1
            s, e = self._ones(level, start), self._ones(level, end)
            start = np.where(one, s + level[3], start - s)
            end = np.where(one, e + level[3], end - e)
        return end - start

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The value at i[k], and how often it is among the values before."""
        symbol, start, end = np.zeros_like(i), np.zeros_like(i), i.copy()
        for level in self.levels:
            one = (level[1][end >> 6] >> (end & 63).astype(np.uint64)) & np.uint64(1) == 1
            symbol = symbol << 1 | one
            s, e = self._ones(level, start), self._ones(level, end)
            start = np.where(one, s + level[3], start - s)
            end = np.where(one, e + level[3], end - e)
        return symbol, end - start


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Suffix order by prefix doubling; the zeros of `seq` differ, in order of position."""
    n, zero, step = len(seq), seq == 0, 1
    key = np.where(zero, np.cumsum(zero) - 1, seq + int(zero.sum()))
    while True:
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        if new[-1] == n - 1:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = new
        after = np.zeros(n, np.int64)
        after[: max(0, n - step)] = rank[step:] + 1
        key = rank * (n + 1) + after
        step *= 2


class FMIndex:
    """Counts and places of phrases in a sequence of symbols; 0 is the separator, last."""

    def __init__(self, seq: np.ndarray, symbols: int, run_starts: np.ndarray, sample: int = SAMPLE) -> None:
        self.n = len(seq)
        order = suffix_array(seq)
        self.matrix = WaveletMatrix(seq[order - 1], symbols)
        self.less = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=symbols))])
        keep = np.zeros(self.n, bool)
        keep[::sample] = True
        keep[run_starts] = True  # a walk never crosses a separator
        at = keep[order]
        self.sampled = WaveletMatrix(at.astype(np.int64), 2)
        self.places = order[at]
        self.is_sampled = at

    def search(self, phrases: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of phrases that are right-aligned rows of symbols."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        live = np.arange(len(phrases))
        for step in range(phrases.shape[1]):
            live = live[(sizes[live] > step) & (low[live] < high[live])]
            if not len(live):
                break
            symbol = phrases[live, phrases.shape[1] - 1 - step]
            low[live] = self.less[symbol] + self.matrix.rank(symbol, low[live])
            high[live] = self.less[symbol] + self.matrix.rank(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Sequence positions of suffixes, by walking back to a sampled one."""
        rows, out = rows.copy(), np.zeros(len(rows), np.int64)
        steps = np.zeros(len(rows), np.int64)
        live = np.arange(len(rows))
        while len(live):
            here = rows[live]
            done = self.is_sampled[here]
            hit = live[done]
            out[hit] = self.places[self.sampled.rank(np.ones(len(hit), np.int64), rows[hit])] + steps[hit]
            live = live[~done]
            symbol, before = self.matrix.access(rows[live])
            rows[live] = self.less[symbol] + before
            steps[live] += 1
        return out


class Phrases:
    """The windows of test items as rows of word numbers, and which items hold each."""

    def __init__(self, items: list[tuple[str | None, str]], window: int) -> None:
        self.number: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[int]] = {}
        names = sorted({i for i, _ in items if i is not None})
        place = {i: k for k, i in enumerate(names)}
        for item, text in items:
            ids = [self.number.setdefault(w, len(self.number) + 1) for w in words(text.encode())]
            for s in range(max(1, len(ids) - window + 1) if ids else 0):
                holders = found.setdefault(tuple(ids[s : s + window]), set())
                if item is not None:
                    holders.add(place[item])
        self.names = names
        self.sizes = np.array([len(p) for p in found], np.int64)
        self.rows = np.zeros((len(found), window), np.int64)
        for k, p in enumerate(found):
            self.rows[k, window - len(p) :] = p
        self.item = np.array([i for s in found.values() for i in s], np.int64)
        self.item_ends = np.concatenate([[0], np.cumsum([len(s) for s in found.values()])]).astype(np.int64)


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each of several ranges, one after the other."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(int(ends[-1]) if len(ends) else 0)


def find(texts: list[bytes], phrases: Phrases, sample: int = SAMPLE):
    """Per text: words, words in a hit (start, end) as merged runs, items that hit."""
    number = phrases.number
    ids, ends = [], [0]
    for t in texts:
        ids += [number.get(w, 0) for w in words(t)]
        ids.append(0)  # a document ends in a separator
        ends.append(len(ids))
    ids, ends = np.array(ids, np.int64), np.array(ends, np.int64)
    n_words = np.diff(ends) - 1
    cover = np.zeros(len(ids) + 1, np.int64)
    pairs: list[np.ndarray] = []
    if len(phrases.sizes):
        known = np.concatenate([[False], ids != 0, [False]])
        edge = np.flatnonzero(known[1:] != known[:-1])
        first, last = edge[::2], edge[1::2]
        long = last - first >= phrases.sizes.min()
        first, last = first[long], last[long]
        if len(first):
            length = last - first + 1  # with the separator that follows
            seq = ids[_ranges(first, length)]
            starts = np.cumsum(length) - length
            index = FMIndex(seq, len(number) + 1, starts, sample)
            low, high = index.search(phrases.rows, phrases.sizes)
            hit = np.flatnonzero(low < high)
            counts = (high - low)[hit]
            which, rows = np.repeat(hit, counts), _ranges(low[hit], counts)
            for s in range(0, len(rows), LOCATE):
                at, w = index.locate(rows[s : s + LOCATE]), which[s : s + LOCATE]
                run = np.searchsorted(starts, at, "right") - 1
                word = first[run] + at - starts[run]
                np.add.at(cover, word, 1)
                np.add.at(cover, word + phrases.sizes[w], -1)
                doc = np.searchsorted(ends, word, "right") - 1
                seen = np.unique(doc * len(phrases.sizes) + w)
                d, w = seen // len(phrases.sizes), seen % len(phrases.sizes)
                n = phrases.item_ends[w + 1] - phrases.item_ends[w]
                item = phrases.item[_ranges(phrases.item_ends[w], n)]
                pairs.append(np.unique(np.repeat(d, n) * len(phrases.names) + item))
    on = np.concatenate([[False], np.cumsum(cover[:-1]) > 0, [False]])
    edge = np.flatnonzero(on[1:] != on[:-1])
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        d = int(np.searchsorted(ends, a, "right")) - 1
        spans[d].append((a - int(ends[d]), b - int(ends[d])))
    items: list[list[str]] = [[] for _ in texts]
    if pairs:
        for p in np.unique(np.concatenate(pairs)).tolist():
            items[p // len(phrases.names)].append(phrases.names[p % len(phrases.names)])
    return n_words.tolist(), spans, items


def merged(a: list, b: list) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted([*map(tuple, a), *b]):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


def searcher(broadcast, sample: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = broadcast.value
        for batch in batches:
            for part in slices(batch, "text", SHARD_BYTES):
                n, spans, items = find(utf8(part.column("text")), phrases, sample)
                had = part.column("spans").to_pylist()
                spans = [merged([(x["s"], x["e"]) for x in a or ()], b) for a, b in zip(had, spans, strict=True)]
                items = [sorted({*(a or ()), *b}) for a, b in zip(part.column("items").to_pylist(), items, strict=True)]
                new = {
                    "n_words": pa.array(n, pa.int64()),
                    "spans": pa.array([[{"s": s, "e": e} for s, e in x] for x in spans], SPANS),
                    "items": pa.array(items, pa.list_(pa.string())),
                }
                yield pa.RecordBatch.from_arrays(
                    [new.get(f, part.column(f)) for f in part.schema.names], part.schema.names
                )

    return task


SPANS = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))


def locate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, sample: int = SAMPLE) -> DataFrame:
    """doc_id, text, n_words, spans of hit words (start, end) and items, per document.

    A window is `window` consecutive words of an item, or a shorter item as a whole.
    Items are measured first and go to the tasks in blocks of a bounded size, one pass
    over the documents per block; hits of all blocks merge. No shuffle. Null texts have no words;
    the windows of an item without id hit, but it is not listed; repeated rows each get their own
    result. No documents give no rows, no items no hits.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.coalesce("text", F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-max(1, total) // BLOCK_BYTES)
    out = docs.select(
        "doc_id", "text", F.lit(0).cast("long").alias("n_words"),
        F.lit(None).cast("array<struct<s:int,e:int>>").alias("spans"), F.lit(None).cast("array<string>").alias("items"),
    )
    for k in range(blocks):
        block = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k) if blocks > 1 else items
        phrases = Phrases([(r["item"], r["text"]) for r in block.collect()], window)
        out = out.mapInArrow(frugal(searcher(spark.sparkContext.broadcast(phrases), sample)), out.schema)
    return out


def digest(located: DataFrame) -> DataFrame:
    """The per-document report."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["e"] - x["s"])
    return located.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


def without_hits(text: str, spans: list[tuple[int, int]]) -> str:
    """A text without the words of its spans and what stands between them."""
    at = [m.span() for m in WORD.finditer(text.translate(_ASCII_LOWER))]
    out, last = [], 0
    for s, e in spans:
        out.append(text[last : at[s][0]])
        last = at[e - 1][1]
    return "".join([*out, text[last:]])


_ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Documents without the passages they share with the items; columns as given.

    A text that is cut has a new `n_chars`; one of which no word is left goes. A text
    without a hit, null included, stays as it is.
    """
    names = docs.columns
    found = locate(docs.withColumn("doc_id", F.struct(*[F.col(f"`{c}`") for c in names if c != "text"])), benchmark, window)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column("text").to_pylist(), batch.column("spans").to_pylist()
            new = [without_hits(t, [(x["s"], x["e"]) for x in s]) if s else t for t, s in zip(texts, spans, strict=True)]
            gone = [bool(s) and not WORD.search(t) for t, s in zip(new, spans, strict=True)]
            out = pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(new, pa.string()), pa.array([bool(s) for s in spans])], ["doc_id", "text", "cut"]
            )
            yield out.filter(pa.array([not g for g in gone], pa.bool_()))

    schema = with_columns(found.select("doc_id", "text"), "cut boolean")
    rest = found.select("doc_id", "text", "spans").mapInArrow(frugal(cut), schema)
    value = lambda c: F.col("text") if c == "text" else F.when(F.col("cut"), F.length("text").cast("long")).otherwise(F.col("doc_id.n_chars")) if c == "n_chars" else F.col(f"doc_id.`{c}`")
    return rest.select(*[value(c).alias(c) for c in names])
