"""Scoring with Brown's class-based bigrams.

Exchange clustering gives the most frequent words classes: every word moves to the class
that raises the likelihood of the class bigrams most, until none moves or for `SWEEPS` rounds.
All other words have a class by their form. A text's probability is that of its class sequence times that
of each word in its class, both with smoothing, the words' counts from the whole corpus.

Counts travel as one row per word and batch with the batch's documents packed into it;
the key range of a word's counts is summed in one task, which gives each document the
part of its sums that these words contribute.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import LOWER, binaries, slices, stored, utf8

CLUSTERED = 4000  # words that exchange clustering assigns; others go by form
CLASSES = 64
SWEEPS = 12
FOLDS, HELD_OUT = 7, 2
ROWS = 60_000  # documents of one batch number; positions take 16 bits
SMOOTH = 0.1  # of class transitions, added to each count

_DIGIT = re.compile(rb"[0-9]")
_SIGN = re.compile(rb"[!-/:-@\[-`{-~]")
_OTHER = re.compile(rb"[\x80-\xFF]")
FORMS = 16
PART_BYTES = 8 << 20  # of text whose pairs are counted at once
KEPT = 500_000  # words whose symbol a task remembers; beyond, it starts anew
END = 0  # class of the end, and of what stands before the first word; then words, then forms

PACKED = np.dtype([("at", "<u2"), ("n", "<u2")])


def words(text: bytes) -> list[bytes]:
    """Lower-cased words between ASCII white space."""
    return text.translate(LOWER).split()


def form(word: bytes) -> int:
    """A word's class by its form: digits, final punctuation, other letters, length."""
    head = word[:40]
    return 8 * bool(_DIGIT.search(head)) + 4 * bool(_SIGN.match(word[-1:])) + 2 * bool(_OTHER.search(head)) + (len(word) > 7)


class Symbols(dict):
    """Numbers of words: the clustered ones from 1, and those of the forms after them."""

    def __init__(self, place: dict[bytes, int]) -> None:
        super().__init__(place)
        self.place, self.base = place, 1 + len(place)

    def __missing__(self, word: bytes) -> int:
        if len(self) > KEPT:
            self.clear()
            self.update(self.place)
        self[word] = found = self.base + form(word)
        return found

    def of(self, text: bytes) -> list[int]:
        """A text as symbols, the end before and after it."""
        return [END, *[self[w] for w in words(text)], END]


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(0)) % FOLDS == HELD_OUT


def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Batches with numbers that are the same whenever the task is run again."""
    task = TaskContext.get()
    number = (task.partitionId() if task else 0) << 24
    for batch in batches:
        for s in range(0, batch.num_rows, ROWS):
            yield number, batch.slice(s, ROWS)
            number += 1


def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per word and batch: its count in training texts, and where it stands how often."""
    for number, batch in numbered(batches):
        code: dict[bytes, int] = {}
        flat: list[int] = []
        sizes = []
        for text in utf8(batch.column("text")):
            found = words(text)
            flat += [code.setdefault(w, len(code)) for w in found]
            sizes.append(len(found))
        if not code:
            continue
        doc = np.repeat(np.arange(len(sizes)), sizes)
        pair, n = np.unique(np.array(flat, np.int64) * len(sizes) + doc, return_counts=True)
        more = n // 65535  # a count beyond 16 bits takes several entries
        pair, n = np.repeat(pair, more + 1), np.repeat(n, more + 1)
        last = np.concatenate([pair[1:] != pair[:-1], [True]])
        n = np.where(last, n % 65535, 65535)
        word, at = pair // len(sizes), pair % len(sizes)
        train = ~batch.column("held_out").to_numpy(zero_copy_only=False)
        count = np.bincount(word, n * train[at], len(code)).astype(np.int64)
        packed = np.empty(len(pair), PACKED)
        packed["at"], packed["n"] = at, n
        ends = np.searchsorted(word, np.arange(len(code) + 1)) * PACKED.itemsize
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(code), pa.binary()), pa.array(np.full(len(code), number)), pa.array(count), binaries(packed, ends)],
            ["word", "batch", "n", "postings"],
        )


def word_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A key range of words to (word, n), and per batch what they add to each document.

    What they add is the sum of log10(n + 1) over the document's tokens and the number of
    tokens with n > 0, both as arrays over the batch's documents.
    """
    parts = [b for b in batches if b.num_rows]
    if not parts:
        return
    table = pa.Table.from_batches(parts).combine_chunks()
    coded = table.column("word").combine_chunks().dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False)
    n = np.bincount(code, table.column("n").to_numpy(), len(coded.dictionary)).astype(np.int64)
    size = len(n)
    yield pa.RecordBatch.from_arrays(
        [coded.dictionary, pa.array(n), pa.nulls(size, pa.int64()), pa.nulls(size, pa.binary())], ["word", "n", "batch", "sums"]
    )
    gain, known = np.log10(n + 1.0)[code], (n > 0)[code]
    number = table.column("batch").to_numpy()
    posts = table.column("postings").to_pylist()
    order = np.argsort(number, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(number[order])) + 1):
        entry = [np.frombuffer(posts[r], PACKED) for r in rows]
        counts = np.fromiter(map(len, entry), np.int64, len(entry))
        all_ = np.concatenate(entry)
        at, times = all_["at"].astype(np.int64), all_["n"].astype(np.float64)
        out = np.stack([np.bincount(at, times * np.repeat(gain[rows], counts)), np.bincount(at, times * np.repeat(known[rows], counts))], 1)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64()), pa.array([int(number[rows[0]])], pa.int64()), pa.array([out.tobytes()], pa.binary())],
            ["word", "n", "batch", "sums"],
        )


def bigrams(broadcast):
    """The task: counts of neighbouring symbols in training texts, a row per first symbol."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols = Symbols(broadcast.value)
        size = symbols.base + FORMS
        pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for part in (p for batch in batches for p in slices(batch, "text", PART_BYTES)):
            texts = [symbols.of(text) for text in utf8(part.column("text"))]
            flat = np.fromiter(chain.from_iterable(texts), np.int64, sum(map(len, texts)))
            new = flat[:-1] * size + flat[1:]
            # from one text's end to the next one's beginning is no pair; in an empty text it is
            new = new[new != END * size + END]
            empty = np.full(sum(len(s) == 2 for s in texts), END * size + END)
            new, n = np.unique(np.concatenate([new, empty]), return_counts=True)
            both, place = np.unique(np.concatenate([pairs, new]), return_inverse=True)
            pairs, counts = both, np.bincount(place, np.concatenate([counts, n]), len(both)).astype(np.int64)
        first, ends = np.unique(pairs // size, return_index=True)
        parts = np.split(np.stack([pairs % size, counts], 1), ends[1:]) if len(first) else []
        yield pa.RecordBatch.from_arrays([pa.array(first), pa.array([x.tobytes() for x in parts], pa.binary())], ["first", "counts"])

    return task


def summed(size: int):
    """Rows of one first symbol to one row."""

    def task(keys, table):
        total = np.zeros(size, np.int64)
        for raw in table.column("counts").to_pylist():
            pair = np.frombuffer(raw, np.int64).reshape(-1, 2)
            total[pair[:, 0]] += pair[:, 1]
        second = np.flatnonzero(total)
        raw = np.stack([second, total[second]], 1).astype(np.int64).tobytes()
        return pa.table({"first": pa.array([keys[0].as_py()], pa.int64()), "counts": pa.array([raw], pa.binary())})

    return task


def xlogx(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)


def exchange(counts: np.ndarray, clustered: int, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of every symbol; symbols 1..clustered move, the end and the forms have their own.

    Maximises the sum of N(g,h) log N(g,h) less the sums of N log N of both margins, the
    likelihood of a class bigram model, by moving one word at a time.
    """
    size = len(counts)
    fixed = size - 1 - clustered
    k = max(1, min(classes, clustered))
    # classes: 0 the end, then those of the words, then the forms
    of = np.concatenate([[0], 1 + np.arange(clustered) % k, 1 + k + np.arange(fixed)]).astype(np.int64)
    total = 1 + k + fixed
    to = np.zeros((size, total))  # symbol to class
    by = np.zeros((total, size))  # class to symbol
    np.add.at(to.T, of, counts.T.astype(float))
    np.add.at(by, of, counts.astype(float))
    grid = np.zeros((total, total))
    np.add.at(grid, of, to)
    left, right = counts.sum(1).astype(float), counts.sum(0).astype(float)
    for _ in range(sweeps):
        moved = 0
        for w in range(1, clustered + 1):
            a = of[w]
            out, into, own = to[w], by[:, w], float(counts[w, w])
            # take w out of its class
            grid[a] -= out
            grid[:, a] -= into
            grid[a, a] += own
            out, into = out.copy(), into.copy()
            out[a] -= own
            into[a] -= own
            row, column = grid.sum(1) + into, grid.sum(0) + out  # w's neighbours keep their margins
            # what each class gains by w: its row and column change, and the cell with itself
            gain_row = (xlogx(grid + out) - xlogx(grid)).sum(1)
            gain_column = (xlogx(grid + into[:, None]) - xlogx(grid)).sum(0)
            d = np.diagonal(grid)
            corner = xlogx(d + out + into + own) - xlogx(d + out) - xlogx(d + into) + xlogx(d)
            margin = xlogx(row + left[w]) - xlogx(row) + xlogx(column + right[w]) - xlogx(column)
            gain = (gain_row + gain_column + corner - margin)[1 : 1 + k]
            b = 1 + int(gain.argmax())
            if gain[b - 1] <= gain[a - 1] + 1e-9:
                b = int(a)
            out[b] += own
            into[b] += own
            grid[b] += out
            grid[:, b] += into
            grid[b, b] -= own
            if b != a:
                moved += 1
                of[w] = b
                to[:, a] -= counts[:, w]
                to[:, b] += counts[:, w]
                by[a] -= counts[w]
                by[b] += counts[w]
        if not moved:
            break
    return of


def class_sums(broadcast):
    """The task: per document its tokens, its class transitions' log10, and its classes' log10 totals."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, of, step, weight = broadcast.value
        symbols = Symbols(place)
        for number, batch in numbered(batches):
            tokens, steps, totals = [], [], []
            for text in utf8(batch.column("text")):
                c = of[symbols.of(text)]
                tokens.append(len(c) - 1)
                steps.append(float(step[c[:-1], c[1:]].sum()))
                totals.append(float(weight[c[1:]].sum()))
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, number)), pa.array(np.arange(n)), batch.column("doc_id"), batch.column("held_out"),
                    pa.array(tokens, pa.int64()), pa.array(steps, pa.float64()), pa.array(totals, pa.float64()),
                ],
                ["batch", "at", "doc_id", "held_out", "n_tokens", "steps", "totals"],
            )

    return task


def joiner(keys, rows, sums):
    """Documents of one batch and the sums of all key ranges."""
    n = rows.num_rows
    total = np.zeros((max(n, 1), 2))
    for raw in sums.column("sums").to_pylist():
        part = np.frombuffer(raw, np.float64).reshape(-1, 2)
        total[: len(part)] += part
    at = rows.column("at").to_numpy() if n else np.zeros(0, np.int64)
    out = rows.select(["doc_id", "held_out", "n_tokens", "steps", "totals"])
    return out.append_column("logs", pa.array(total[at, 0])).append_column("known", pa.array(total[at, 1].astype(np.int64)))


def score(docs: DataFrame, clustered: int = CLUSTERED, classes: int = CLASSES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every text.

    Texts whose id falls in the held-out fold are scored, not learned from. A null or empty
    text is an end alone. The table is read three times and must give the same batches of
    rows each time, as files do. What the driver holds is bounded by `clustered`: the words that
    are clustered and the counts of their neighbours, at most (clustered + 17) ** 2 numbers.
    P(text) is the product over tokens of P(class | class before) P(token | class): class
    transitions with `SMOOTH` added to each count, words as (n + 1) / (N(class) + V(class) + 1)
    with the class's tokens and distinct words; the end is alone in its class. An empty table gives none.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", held_out().alias("held_out"))
    found = stored(
        rows.mapInArrow(postings, "word binary, batch long, n long, postings binary")
        .repartition("word").mapInArrow(word_sums, "word binary, n long, batch long, sums binary"),
        "word-sums",
    )
    vocabulary = found.filter("batch IS NULL AND n > 0").select("word", "n")
    top = vocabulary.orderBy(F.desc("n"), "word").limit(clustered).collect()
    place = {bytes(r["word"]): 1 + i for i, r in enumerate(top)}
    size = 1 + len(place) + FORMS

    held = spark.sparkContext.broadcast(place)
    pairs = rows.filter("NOT held_out").select("text").mapInArrow(bigrams(held), "first long, counts binary")
    counts = np.zeros((size, size), np.int64)
    for r in pairs.groupBy("first").applyInArrow(summed(size), "first long, counts binary").collect():
        pair = np.frombuffer(r["counts"], np.int64).reshape(-1, 2)
        counts[r["first"], pair[:, 0]] = pair[:, 1]
    of = exchange(counts, len(place), classes)

    # tokens and distinct words of each class; forms count all their words
    n_classes = int(of.max()) + 1
    tokens = np.bincount(of, counts.sum(0), n_classes)
    rest = vocabulary.join(F.broadcast(spark.createDataFrame([(w,) for w in place], "word binary")), "word", "left_anti")  # at most `clustered` words
    distinct = np.bincount(of[: 1 + len(place)], minlength=n_classes).astype(float)
    for r in rest.groupBy(form_of("word").alias("form")).count().collect():
        distinct[of[1 + len(place) + r["form"]]] += r["count"]
    step = np.zeros((n_classes, n_classes))
    np.add.at(step, (of[:, None], of[None, :]), counts)
    step = np.log10((step + SMOOTH) / (step.sum(1, keepdims=True) + SMOOTH * n_classes))
    # a document's words add log10(n + 1); their classes take the totals away; the end is certain in its class
    weight = np.log10(tokens + distinct + 1)
    weight[END] = 0.0

    model = spark.sparkContext.broadcast((place, of, step, weight))
    schema = "batch long, at long, doc_id {}, held_out boolean, n_tokens long, steps double, totals double"
    kind = docs.schema["doc_id"].dataType.simpleString()
    per_doc = rows.mapInArrow(class_sums(model), schema.format(kind))
    sums = found.filter("batch IS NOT NULL").select("batch", "sums")
    out = per_doc.groupBy("batch").cogroup(sums.groupBy("batch")).applyInArrow(
        joiner, f"doc_id {kind}, held_out boolean, n_tokens long, steps double, totals double, logs double, known long"
    )
    # the end's count is the number of training documents
    ends = int(counts[:, END].sum())
    known = vocabulary.agg(F.count("*").alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    n, v = known["n"] + ends, known["v"] + (ends > 0)
    end = float(np.log10(ends + 1))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.lit(int(ends > 0))).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("logs") + F.lit(end) - F.col("n_tokens") * F.log10(F.lit(float(n + v + 1)))).alias("base_score"),
        (F.col("steps") + F.col("logs") - F.col("totals")).alias("score"),
    )


def form_of(column: str):
    """`form` as a column."""
    word = F.col(column)
    text = F.decode(word, "ISO-8859-1")
    head = F.substring(text, 1, 40)
    last = F.substring(text, -1, 1)
    return (
        8 * head.rlike("[0-9]").cast("int") + 4 * last.rlike(r"[!-/:-@\[-`{-~]").cast("int")
        + 2 * head.rlike("[\\x80-\\xFF]").cast("int") + (F.octet_length(word) > 7).cast("int")
    )
