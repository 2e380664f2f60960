"""Packing token sequences by swap-based local search.

Documents longer than a window are cut, the rest stay whole. Pieces meet in groups of many
windows; a group is packed largest piece first into the fullest bin with room, and improved
from there: the emptiest underfull bin gives a piece to another bin, or exchanges one or two of
its pieces for a smaller one, or one for two smaller ones. Each step moves tokens to a bin that
is no emptier, so the squared fill rises, until the giving bin is empty and goes, or no step is
left for it. Bins that came out nearly full are closed; what lies in the others meets what other
groups left over, and is packed again.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from heapq import heappop, heappush
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderloom.llm.common import binaries, byte_of, frugal, slices, stored, with_columns

WINDOW = 2048
GROUP = 1024  # windows that one group fills
TURNS = 6  # that pieces of underfull bins are dealt anew, at most
CLOSED = 0.999  # a bin this full is not packed again
PAIRED = 24  # sizes of a bin that are tried two by two
PATIENCE = 4  # rounds of search that empty no bin
END = 0
BATCH_BYTES = 3 << 20
PIECES = "doc_id long, piece int, start long, length long, ids binary"


class Encoder:
    """Token ids of whole texts, as `Tokenizer.from_file(path)` gives them without special tokens added.

    The file of a plain byte-level BPE, whose merges stand in the order of their ids, says
    the same as a rank of each token, and the faster merging of `tiktoken` runs over these
    ranks. Any other file, and a text that it refuses, goes to `tokenizers` itself.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.fast = self._ranked(json.loads(Path(path).read_text()))
        self.added = self.fast.special_tokens_set if self.fast else set()

    @staticmethod
    def _ranked(file: dict) -> tiktoken.Encoding | None:
        model, split = file["model"], file["pre_tokenizer"] or {}
        added = file["added_tokens"]
        plain = (
            model["type"] == "BPE"
            and not file["normalizer"]
            and split.get("type") == "ByteLevel"
            and split.get("use_regex")
            and not split.get("add_prefix_space")
            and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
            and not any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
        )
        if not plain:
            return None
        byte = byte_of()
        special = {t["content"]: t["id"] for t in added}
        ranks = {bytes(byte[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        order = [model["vocab"][a + b] for a, b in pairs]
        if order != sorted(order):
            return None
        return tiktoken.Encoding(
            "ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special
        )

    def ids(self, text: str) -> np.ndarray:
        if self.fast:
            try:
                return self.fast.encode_to_numpy(text, allowed_special=self.added, disallowed_special=())
            except ValueError:  # its splitter gives up on some very long words
                pass
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def cutter(path: str, capacity: int, end: int):
    """The task: encode each text, cut the long ones, give out pieces."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).ids
        last = np.array([end], np.uint32)
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                ids = [np.concatenate([encode(t) if t else last[:0], last]) for t in part.column("text").to_pylist()]
                total = np.array([len(x) for x in ids], np.int64)
                count = -(-total // capacity)
                row = np.repeat(np.arange(len(ids)), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                first = total - (count - 1) * capacity  # the first piece takes what is no whole window
                start = np.where(piece > 0, first[row] + (piece - 1) * capacity, 0)
                length = np.where(piece > 0, capacity, first[row])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(row)),
                        pa.array(piece.astype(np.int32)),
                        pa.array(start),
                        pa.array(length),
                        binaries(np.concatenate(ids).astype("<u4"), 4 * np.concatenate([[0], np.cumsum(length)])),
                    ],
                    ["doc_id", "piece", "start", "length", "ids"],
                )

    return rows


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = WINDOW, end: int = END) -> DataFrame:
    """doc_id, piece, start, length and ids: each document's ids and the end id, cut where longer than a window.

    The first piece of a long document is what does not fill a window, the others are whole
    windows. A null or empty text is the end id alone; rows that repeat, or lack, an id are
    documents of their own; an empty table gives no rows; other columns are left out.
    """
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(frugal(cutter(path, capacity, end)), PIECES)


def fewest(sizes: np.ndarray, capacity: int) -> int:
    """A lower bound of the number of bins: large pieces share with none, or with small ones only."""
    count = np.bincount(sizes, minlength=capacity + 1)[: capacity + 1]
    number, weight = np.cumsum(count), np.cumsum(count * np.arange(capacity + 1))
    half = capacity // 2
    k = np.arange(half + 1)
    alone = number[-1] - number[capacity - k]
    large = number[capacity - k] - number[half]
    left = capacity * large - (weight[capacity - k] - weight[half])
    below = np.where(k > 0, weight[np.maximum(k - 1, 0)], 0)
    return int((alone + large + np.maximum(0, -(-(weight[half] - below - left) // capacity))).max())


def best_fit(sizes: list[int], capacity: int) -> list[Counter]:
    """Bins of sizes, from the largest piece down, each into the fullest bin with room."""
    bins: list[Counter] = []
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # a bit per room that some bin has
    for size in sorted(sizes, reverse=True):
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            at = with_room[room].pop()
            if not with_room[room]:
                rooms ^= 1 << room
        else:
            room, at = capacity, len(bins)
            bins.append(Counter())
        bins[at][size] += 1
        with_room[room - size].append(at)
        rooms |= 1 << (room - size)
    return bins


class Search:
    """Underfull bins, and the steps that bring tokens from a giver to bins that are no emptier."""

    def __init__(self, bins: list[Counter], capacity: int) -> None:
        self.capacity = capacity
        self.bins = bins
        self.room = [capacity - sum(s * n for s, n in b.items()) for b in bins]
        self.version = [0] * len(bins)

    @staticmethod
    def parts(b: Counter) -> tuple[list[int], list[int]]:
        """The sizes of a bin, and the sums of two of its pieces, of `PAIRED` sizes at most."""
        one = sorted(b)
        some = one if len(one) <= PAIRED else one[:: -(-len(one) // PAIRED)]
        two = {x + y for i, x in enumerate(some) for y in some[i + 1 :]}
        return one, sorted(two.union(2 * s for s in some if b[s] > 1))

    def gather(self, takers: list[int]) -> None:
        """Who holds which sizes and sums, the most room first; `top` has that room, -1 for none."""
        self.takers = set(takers)
        self.held = [[[] for _ in range(2 * self.capacity + 1)] for _ in range(2)]
        self.top = np.full((2, 2 * self.capacity + 1), -1, np.int64)
        for b in takers:
            self.enter(b)

    def enter(self, b: int) -> None:
        if self.room[b]:
            for held, top, sums in zip(self.held, self.top, self.parts(self.bins[b]), strict=True):
                for s in sums:
                    heappush(held[s], (-self.room[b], b, self.version[b]))
                    top[s] = max(top[s], self.room[b])

    def leave(self, b: int) -> None:
        self.version[b] += 1
        for held, top, sums in zip(self.held, self.top, self.parts(self.bins[b]), strict=True):
            for s in sums:
                while held[s] and held[s][0][2] != self.version[held[s][0][1]]:
                    heappop(held[s])
                top[s] = -held[s][0][0] if held[s] else -1

    def step(self, giver: int) -> tuple[int, list[int], list[int]] | None:
        """The taker, what it gets and what it gives back, of the step that moves the most tokens."""
        one, two = self.parts(self.bins[giver])
        rooms = [(self.room[b], b) for b in self.takers if self.room[b]]
        best = None  # tokens moved, sum given, pieces given, pieces given back
        widest = max(rooms, default=(0, 0))[0]
        fit = bisect_right(one, widest)
        if fit:
            best = (one[fit - 1], one[fit - 1], 1, 0)
        for given, sums, back in ((1, one, 1), (2, two, 1), (1, one, 2)):
            for s in reversed(sums):
                if best and s <= best[0]:
                    break
                least = max(1, s - widest)
                x = np.flatnonzero(self.top[back - 1, least:s] >= s - np.arange(least, s))
                if len(x) and (not best or s - least - x[0] > best[0]):
                    best = (s - least - int(x[0]), s, given, back)
        if not best:
            return None
        moved, s, given, back = best
        out = [s] if given == 1 else self.split(giver, s)
        if not back:
            return min(r for r in rooms if r[0] >= s)[1], out, []
        # of the bins that hold what is given back, the one that this fills best
        able = [(-r, b) for r, b, v in self.held[back - 1][s - moved] if v == self.version[b] and -r >= moved]
        taker = min(able)[1]
        return taker, out, [s - moved] if back == 1 else self.split(taker, s - moved)

    def split(self, b: int, total: int) -> list[int]:
        sizes = self.bins[b]
        return next([x, total - x] for x in sorted(sizes) if sizes[total - x] > (x == total - x))

    def exchange(self, giver: int, taker: int, given: list[int], back: list[int]) -> None:
        self.leave(taker)
        for b, away, new in ((giver, given, back), (taker, back, given)):
            self.bins[b] = (self.bins[b] - Counter(away)) + Counter(new)
            self.room[b] += sum(away) - sum(new)
        self.enter(taker)


def empty_bins(bins: list[Counter], capacity: int, target: int, patience: int = PATIENCE) -> list[Counter]:
    """Steps between underfull bins until `target` bins are left, or nothing is gained any more.

    In a round each bin gives in turn, the emptiest first. One that has given all it could takes
    nothing for the rest of the round, so takers are no emptier than the giver. The end is a
    round without a step, or `patience` rounds after the last that emptied a bin.
    """
    search = Search(bins, capacity)
    count, idle, moving = len(bins), 0, True
    while count > target and moving and idle < patience:
        before, moving = count, False
        order = sorted((b for b in range(len(bins)) if 0 < search.room[b] < capacity), key=lambda b: (-search.room[b], b))
        search.gather(order)
        for giver in order:
            search.leave(giver)
            search.takers.discard(giver)
            while 0 < search.room[giver] < capacity and (found := search.step(giver)):
                search.exchange(giver, *found)
                moving = True
            count -= search.room[giver] == capacity
            if count <= target:
                break
        idle = 0 if count < before else idle + 1
    return [b for b in search.bins if b]


def pack(sizes: np.ndarray, capacity: int = WINDOW) -> np.ndarray:
    """The bin of each piece, numbered from 0."""
    sizes = np.asarray(sizes, np.int64)
    if not len(sizes):
        return sizes
    bins = best_fit(sizes.tolist(), capacity)
    bins = empty_bins(bins, capacity, fewest(sizes, capacity))
    # pieces of one size are alike: deal them to the bins that hold the size
    holds = sorted((s, b) for b, some in enumerate(bins) for s in some.elements())
    out = np.empty(len(sizes), np.int64)
    out[np.argsort(sizes, kind="stable")] = [b for _, b in holds]
    return out


def packer(turn: int, capacity: int, closed: float):
    """The task: one group's pieces get their sequences and places."""

    def task(key, table):
        table = table.sort_by("_row")
        length = table.column("length").to_numpy()
        sequence = pack(length, capacity)
        order = np.argsort(sequence, kind="stable")
        ends = np.cumsum(length[order])
        first = np.searchsorted(sequence[order], sequence[order])
        offset = np.empty(len(length), np.int64)
        offset[order] = ends - length[order] - (ends - length[order])[first]
        full = np.bincount(sequence, length) >= closed * capacity
        number = (turn << 56) + (key[0].as_py() << 24) + sequence
        return (
            table.drop_columns(["_group"])
            .append_column("sequence_id", pa.array(number))
            .append_column("offset", pa.array(offset))
            .append_column("_closed", pa.array(full[sequence]))
        )

    return task


def packed(rows: DataFrame, capacity: int = WINDOW, group: int = GROUP, closed: float = CLOSED) -> DataFrame:
    """Any rows with a `length` of 1 to `capacity`, and the sequence_id and offset of each.

    Rows are dealt into groups by the hash of a number of their own, so that each group sees
    the same mix of lengths and rows that repeat do not meet in one; a group holds about
    `group` windows of tokens, whatever is in it. Bins filled to `closed` are final. The rest is
    dealt and packed again, until one group holds it all, or a turn leaves over nine tenths of
    its tokens in underfull bins, where new neighbours would not help, or after `TURNS`. A turn is
    stored before the next. No rows give no rows. Other columns stay, but for those that are named
    like the new ones, or `_row`, `_group` or `_closed`.
    """
    rows = rows.drop("sequence_id", "offset", "_row", "_group", "_closed")
    numbered = rows.withColumn("_row", F.monotonically_increasing_id())
    todo, done, turn = stored(numbered, "pieces"), [], 0
    tokens = todo.agg(F.sum("length")).first()[0] or 0
    while True:
        groups = max(1, -(-tokens // (capacity * group)))
        dealt = todo.withColumn("_group", F.pmod(F.xxhash64("_row", F.lit(turn)), F.lit(groups)))
        schema = with_columns(todo, "sequence_id long, offset long, _closed boolean")
        result = stored(dealt.groupBy("_group").applyInArrow(packer(turn, capacity, closed), schema), "sequences", narrow=True)
        rest = result.filter(~F.col("_closed"))
        left = rest.agg(F.sum("length")).first()[0] or 0
        if groups == 1 or left == 0 or 10 * left > 9 * tokens or turn + 1 == TURNS:
            done.append(result)
            break
        done.append(result.filter("_closed"))
        todo, tokens, turn = rest.select(*todo.columns), left, turn + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("_row", "_closed")


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = WINDOW, group: int = GROUP) -> DataFrame:
    """Every piece of every document with its ids, its sequence and its place there."""
    return packed(pieces(docs, tokenizer, capacity), capacity, group)
