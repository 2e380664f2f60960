"""Packing token sequences with Karmarkar-Karp multiway differencing.

Whole windows are cut off the front of a document; its rest, cut into pieces, is
packed with other rests. A group of pieces starts as many partial partitions, each
one piece and otherwise empty windows. The two partitions with the largest imbalance
merge, the fullest windows of one with the emptiest of the other, until one is left:
near-equal windows. Where the fullest exceeds the capacity the group takes one window
more and differences again.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderloom.llm.common import binaries, byte_of, frugal, slices

WINDOW = 2048
PIECE = 512  # rests are cut to this, so that windows come out near equal
GROUP = 64  # windows that one group fills
END = 1
WORDS_KEPT = 400_000  # encodings that a worker keeps; beyond, it starts anew
JOINED = 2000  # words that go to the tokenizer at once
BATCH_BYTES = 3 << 20
LAST = b"\xff"
# Fixed value: the pattern of word groups that the vocabulary file names.
FILE_GROUPS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# ASCII and the accented Latin letters whose lower case is one letter of the same range, and their groups.
PLAIN = re.compile("[!-~À-ÖØ-öø-įĲ-ž]+")
GROUPS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ž]+|[0-9]|[^a-z0-9ß-öø-ž]+")

SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)


class Encoder:
    """Token ids of texts, a word at a time.

    The tokenizer normalises and splits within white space only, so the ids of a text
    are those of its words one after the other. Each word is encoded once per worker. Words of
    ASCII and accented Latin letters fall into groups by one pattern, and the merges of a
    group run over ranks; any other word, and one that holds an added token, goes to the
    tokenizer itself.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        file = json.loads(Path(path).read_text())
        self.added = re.compile("|".join(re.escape(t["content"]) for t in file["added_tokens"]) or "(?!)").search
        self.merges = self._ranked(file)
        self.words = Table()

    @staticmethod
    def _ranked(file: dict) -> tiktoken.Encoding | None:
        """Merges as ranks of byte strings; a word's last symbol carries the byte 255, which no text holds.

        Only where the file names the very groups of `GROUPS` and lists merges in the order of their ids.
        """
        model, added = file["model"], {t["content"] for t in file["added_tokens"]}
        patterns = [p["pattern"].get("Regex") for p in (file["pre_tokenizer"] or {}).get("pretokenizers", []) if "pattern" in p]
        steps = [n["type"] for n in (file["normalizer"] or {}).get("normalizers", [])]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        order = [model["vocab"][a + b] for a, b in pairs]
        if patterns != [FILE_GROUPS] or steps != ["NFC", "Replace", "Lowercase"] or order != sorted(order):
            return None
        byte, end = byte_of(), model["end_of_word_suffix"]
        ranks = {}
        for token, i in model["vocab"].items():
            if token not in added:
                last = token.endswith(end)
                ranks[bytes(byte[c] for c in (token.removesuffix(end) if last else token)) + LAST * last] = i
        return tiktoken.Encoding("ranked", pat_str=".+", mergeable_ranks=ranks, special_tokens={})

    def learn(self, words: list[str]) -> None:
        """Encode words that are not known yet, and keep them."""
        ids: list[list[int] | None] = [None] * len(words)
        merge = self.merges._core_bpe.encode_single_piece if self.merges else None
        rest = []
        for k, word in enumerate(words):
            if merge and PLAIN.fullmatch(word) and not self.added(word):
                groups = GROUPS.findall(word.lower())
                ids[k] = merge(groups[0].encode() + LAST)
                for g in groups[1:]:
                    ids[k] += merge(g.encode() + LAST)
            else:
                rest.append(k)
        for s in range(0, len(rest), JOINED):
            some = rest[s : s + JOINED]
            for k, e in zip(some, self.tokenizer.encode_batch_fast([words[k] for k in some], add_special_tokens=False), strict=True):
                ids[k] = e.ids
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        self.words.add(words, sizes, np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum())))

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text and the end id; null is the empty text."""
        split = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.words.place) > WORDS_KEPT:
            self.words = Table()
        place = self.words.place
        self.learn([w for w in words if w not in place])
        at = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
        sizes, flat = self.words.gather(at[coded.indices.to_numpy()])
        counts = np.asarray(pc.list_value_length(split))
        bounds = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
        end = np.array([END], np.uint32)
        return [np.concatenate([flat[a:b], end]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


class Table:
    """Strings and their ids, end to end."""

    def __init__(self) -> None:
        self.place: dict[str, int] = {}
        self.first, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def add(self, new: list[str], sizes: np.ndarray, flat: np.ndarray) -> None:
        base = len(self.place)
        self.place.update(zip(new, range(base, base + len(new)), strict=True))
        self.first = np.concatenate([self.first, len(self.flat) + np.cumsum(sizes) - sizes])
        self.size = np.concatenate([self.size, sizes])
        self.flat = np.concatenate([self.flat, flat])

    def gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sizes of several entries, and their ids one after the other."""
        sizes = self.size[at]
        ends = np.cumsum(sizes)
        return sizes, self.flat[np.repeat(self.first[at] - (ends - sizes), sizes) + np.arange(int(sizes.sum()))]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def difference(sizes: list[int], windows: int) -> list[list[int]]:
    """Positions of `sizes` in `windows` sets of near-equal sum, by differencing."""
    n = len(sizes)
    sums: list[np.ndarray] = []
    heap = []
    for i, size in enumerate(sizes):
        first = np.zeros(windows, np.int64)
        first[0] = size
        sums.append(first)
        heap.append((-size if windows > 1 else 0, i))
    heapq.heapify(heap)
    merges = []
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        both = sums[a] + sums[b][::-1]  # both fall, so the fullest meets the emptiest
        order = np.argsort(-both, kind="stable")
        sums[a] = sums[b] = both[:0]
        sums.append(both[order])
        merges.append((a, b, order))
        heapq.heappush(heap, (int(sums[-1][-1] - sums[-1][0]), n + len(merges) - 1))
    # from the last merge down: which window of the whole each window of a part became
    window = [np.arange(windows)] * (n + len(merges))
    for k in range(len(merges) - 1, -1, -1):
        a, b, order = merges[k]
        own = np.empty(windows, np.int64)
        own[order] = window[n + k]
        window[a], window[b] = own, own[::-1]
    out: list[list[int]] = [[] for _ in range(windows)]
    for i in range(n):
        out[window[i][0]].append(i)
    return out


def pack(sizes: list[int], capacity: int = WINDOW) -> list[list[int]]:
    """Windows of at most `capacity`; their number rises while the fullest exceeds it."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        sets = [s for s in difference(sizes, windows) if s]
        if max(sum(sizes[i] for i in s) for s in sets) <= capacity:
            return sets
        windows += 1


def packer(path: str, capacity: int, piece: int, group: int):
    """The task: encode, cut, pack group by group, give out rows."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        task = TaskContext.get()
        sequence = (task.partitionId() if task else 0) << 40
        waiting: list[tuple] = []  # doc_id, start, ids, doc_tokens
        held = 0

        def flush(done: list[tuple], take: int) -> pa.RecordBatch:
            nonlocal sequence
            out = []
            for x in done:
                out.append((*x, sequence, 0))
                sequence += 1
            if take:
                for window in pack([len(x[2]) for x in waiting[:take]], capacity):
                    offset = 0
                    for i in sorted(window):
                        out.append((*waiting[i], sequence, offset))
                        offset += len(waiting[i][2])
                    sequence += 1
                del waiting[:take]
            size = np.array([len(x[2]) for x in out], np.int64)
            ids = np.concatenate([x[2] for x in out]).astype("<u4") if out else np.zeros(0, "<u4")
            long = lambda k: pa.array([x[k] for x in out], pa.int64())
            return pa.RecordBatch.from_arrays(
                [long(0), long(1), pa.array(size), binaries(ids, 4 * np.concatenate([[0], np.cumsum(size)])), long(3), long(4), long(5)],
                ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                done = []
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), encode(part.column("text")), strict=True):
                    whole = len(ids) // capacity * capacity
                    done += [(doc_id, s, ids[s : s + capacity], len(ids)) for s in range(0, whole, capacity)]
                    for s in range(whole, len(ids), piece):
                        waiting.append((doc_id, s, ids[s : s + piece], len(ids)))
                        held += len(waiting[-1][2])
                    if held >= group * capacity:
                        # the last few pieces may wait: end just below a whole number of windows
                        sums = np.cumsum([len(x[2]) for x in waiting])
                        choice = np.flatnonzero(sums >= (group - 4) * capacity)
                        take = int(choice[np.argmin((-sums[choice]) % capacity)]) + 1
                        held -= int(sums[take - 1])
                        yield flush(done, take)
                        done = []
                if done:
                    yield flush(done, 0)
        if waiting:
            yield flush([], len(waiting))

    return rows


def pack_documents(
    docs: DataFrame, tokenizer: str | None = None, capacity: int = WINDOW, piece: int = PIECE, group: int = GROUP
) -> DataFrame:
    """One row per piece: where it is in its document and in its sequence, and its ids.

    No shuffle: each task packs what it reads, in groups of about `group` windows, so
    memory is bounded and at most one window of a task is far from full. A lost task is
    run again over the same rows in the same order and gives the same sequence numbers:
    the task's number in the high bits, a count in the low ones. A null or empty text is
    the end id alone. Every id lies in one piece.
    """
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        frugal(packer(path, capacity, piece, group)), SCHEMA
    )
