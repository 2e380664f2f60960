"""Near-duplicates with SetSketch registers.

A register holds the minimum of independent exponential variables, one per shingle,
truncated to an exponentially spaced scale: the larger the set, the larger its value,
and the registers of a union are the maxima of those of its parts. Equal registers grow
with similarity, so bands of them find candidates; the counts of larger, equal and
smaller registers give the joint likelihood of the similarity, which spares hopeless
candidates; what is left is verified on the full sets.

Documents with equal sets are one class. Every class of a bucket is first compared with
the bucket's smallest; classes that this leaves apart are then compared with all others
of their bucket, in blocks, so that no link of a bucket is missed and no bucket is
expanded into all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import LOWER, frugal, mix64, slices, stored, utf8

WORDS = 5
PERCENT = 75
BANDS, ROWS = 40, 4
REGISTERS = BANDS * ROWS
BASE = 1.02
TOP = 2200  # registers lie in 0..TOP
HOPELESS = 0.57  # estimates have a standard error of 0.034 at 0.75: more than five of them
BLOCK = 1024  # classes of a bucket, or texts of a component, that one task compares at once
FEW = 4  # partners that are verified as pairs; more are verified together
CACHE = 100_000
BATCH_BYTES = 4 << 20

_RNG = np.random.default_rng(20)
_ODD = _RNG.integers(1, 2**63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MORE = _RNG.integers(1, 2**63, REGISTERS, dtype=np.uint64)
_K = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


class Hashes(dict):
    """Hashes of words, kept for the words a task meets often; beyond `CACHE` it starts anew."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


_hashes = Hashes()


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted 64-bit values of the distinct shingles; a shorter text is one as a whole."""
    h = word_hashes(text.translate(LOWER).split())
    if not len(h):
        return h
    k = min(words, len(h))
    out = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        out = (out ^ h[i : len(h) - k + 1 + i]) * _K
        out ^= out >> np.uint64(29)
    return np.unique(mix64(out))


def scale(minima: np.ndarray) -> np.ndarray:
    """Registers of 64-bit minima: the truncated logarithm of the exponential variable."""
    x = -np.log1p(-(minima.astype(np.float64) + 1) / 2.0**64)
    return np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, TOP).astype(np.int16)


def sketch(values: np.ndarray, chunk: int = 256) -> np.ndarray:
    """Registers of a set; mergeable by maximum."""
    low = np.full(REGISTERS, 2**64 - 1, np.uint64)
    for s in range(0, len(values), chunk):
        part = values[s : s + chunk, None] * _ODD
        part ^= part >> np.uint64(32)
        low = np.minimum(low, (part * _MORE_ODD).min(0))
    return scale(low)


_MORE_ODD = _MORE * np.uint64(2) + np.uint64(1)


def bands(registers: np.ndarray) -> np.ndarray:
    """One 64-bit value per band."""
    r = registers.astype(np.uint64).reshape(BANDS, ROWS)
    out = mix64(np.arange(1, BANDS + 1, dtype=np.uint64) * _K)
    for i in range(ROWS):
        out = mix64(out ^ (r[:, i] + np.uint64(1)) * _K)
    return out


_GRID = np.linspace(0.0, 1.0, 61)[:-1]


def estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Similarity of pairs of sketches (rows), by the likelihood of larger, equal and smaller registers.

    With u and v the shares of both sets that lie in one only, a register of the first is
    larger with probability p(u - v * similarity terms) of the base; the grid point of the
    largest likelihood is taken.
    """
    larger, smaller = (a > b).sum(-1)[..., None], (a < b).sum(-1)[..., None]
    total = (size_a + size_b).astype(np.float64)
    u, v = (size_a / total)[..., None], (size_b / total)[..., None]
    top = np.minimum(u / v, v / u)
    j = _GRID * top  # no pair can be more alike than its sizes allow
    p = lambda x: -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)
    more, less = p(np.maximum(u - v * j, 1e-12)), p(np.maximum(v - u * j, 1e-12))
    same = np.maximum(1 - more - less, 1e-12)
    like = larger * np.log(np.maximum(more, 1e-12)) + smaller * np.log(np.maximum(less, 1e-12)) + (REGISTERS - larger - smaller) * np.log(same)
    best = like.argmax(-1)[..., None]
    return np.take_along_axis(np.broadcast_to(j, like.shape), best, -1)[..., 0]


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """The full sets: 100 * intersection >= percent * union."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


# ---- tasks -----------------------------------------------------------------------


def sketcher(words: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text", BATCH_BYTES)):
            n, keys, regs, band = [], [], [], []
            for t in utf8(batch.column("text")):
                s = shingles(t, words)
                n.append(len(s))
                if not len(s):
                    keys.append(None)
                    regs.append(None)
                    band.append(None)
                    continue
                # equal sets, and only they, have equal size and sums
                keys.append(np.array([s.sum(dtype=np.uint64), mix64(s ^ _K).sum(dtype=np.uint64), len(s)], np.uint64).tobytes())
                r = sketch(s)
                regs.append(r.tobytes())
                band.append(bands(r).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(regs, pa.binary()), pa.array(band, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "set_key", "registers", "bands"],
            )

    return task


def verifier(words: int, percent: int):
    """Rows (a, b, text_a, text_b) to the linked pairs; rows of one `a` come together."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, set_a = None, None
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            keep = []
            left, right = batch.column("text_a"), batch.column("text_b")
            for k, x in enumerate(a):
                if x != last:
                    last, set_a = x, shingles(utf8(left.slice(k, 1))[0], words)
                keep.append(linked(set_a, shingles(utf8(right.slice(k, 1))[0], words), percent))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return task


def comparer(hopeless: float, few: int):
    """Blocks of a bucket to what is left to verify between different components.

    A group has the members of one block and, marked `apart`, the bucket's members
    outside its largest component, which are compared with the block. A member with few
    promising partners in a component gives pairs (a, b); one with many gives itself and
    the component, marked `crowd`.
    """

    def task(keys, table):
        pairs: set[tuple[int, int]] = set()
        crowds: set[tuple[int, int]] = set()
        away = table.column("apart").to_numpy(zero_copy_only=False)
        reg = np.frombuffer(b"".join(table.column("registers").to_pylist()), np.int16).reshape(-1, REGISTERS)
        size, part, ident = (table.column(c).to_numpy() for c in ("n_shingles", "component", "id"))
        block = np.flatnonzero(~away)
        for i in np.flatnonzero(away).tolist():
            other = block[part[block] != part[i]]
            other = other[np.minimum(size[other], size[i]) >= hopeless * np.maximum(size[other], size[i])]
            # far too few equal registers for the similarity asked for: no need to estimate
            other = other[(reg[other] == reg[i]).sum(1) >= (hopeless - 0.15) * REGISTERS]
            if not len(other):
                continue
            e = estimate(np.broadcast_to(reg[i], (len(other), REGISTERS)), reg[other], np.full(len(other), size[i]), size[other])
            other = other[e >= hopeless]
            found, counts = np.unique(part[other], return_counts=True)
            crowds |= {(int(ident[i]), int(c)) for c in found[counts > few]}
            some = other[np.isin(part[other], found[counts <= few])]
            pairs |= {(int(min(ident[i], x)), int(max(ident[i], x))) for x in ident[some]}
        rows = [(*x, False) for x in sorted(pairs)] + [(*x, True) for x in sorted(crowds)]
        return pa.table(
            {
                "a": pa.array([x[0] for x in rows], pa.int64()),
                "b": pa.array([x[1] for x in rows], pa.int64()),
                "crowd": pa.array([x[2] for x in rows], pa.bool_()),
            }
        )

    return task


def crowd_verifier(words: int, percent: int):
    """A block of a component and texts that may link to it: each text's first link there.

    The block's shingles are inverted, so a text's intersections with all members are
    counted at once, exactly.
    """

    def task(keys, table):
        ident, away = table.column("id").to_pylist(), table.column("apart").to_pylist()
        sets = [shingles(t, words) for t in utf8(table.column("text").combine_chunks())]
        block = sorted((i for i, x in enumerate(away) if not x), key=ident.__getitem__)
        size = np.array([len(sets[i]) for i in block], np.int64)
        flat = np.concatenate([np.zeros(0, np.uint64), *[sets[i] for i in block]])
        order = np.argsort(flat, kind="stable")
        flat, member = flat[order], np.repeat(np.arange(len(block)), size)[order]
        links = []
        for i in (i for i, x in enumerate(away) if x):
            low, high = np.searchsorted(flat, sets[i], "left"), np.searchsorted(flat, sets[i], "right")
            n = high - low
            at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            both = np.bincount(member[at], minlength=len(block))
            hit = np.flatnonzero(100 * both >= percent * (size + len(sets[i]) - both))
            if len(hit) and ident[block[hit[0]]] != ident[i]:
                links.append((ident[i], ident[block[hit[0]]]))
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return task


def estimator(hopeless: float):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reg = [np.frombuffer(b"".join(batch.column(c).to_pylist()), np.int16).reshape(-1, REGISTERS) for c in ("reg_a", "reg_b")]
            size = [np.asarray(batch.column(c)) for c in ("n_a", "n_b")]
            keep = np.zeros(batch.num_rows, bool)
            for s in range(0, batch.num_rows, 1024):
                x = slice(s, s + 1024)
                keep[x] = estimate(reg[0][x], reg[1][x], size[0][x], size[1][x]) >= hopeless
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return task


# ---- the operator ----------------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """id and component (its smallest id) of every id in links (a, b).

    Large-star and small-star steps by turns: each halves the depth, and none gathers a
    component in one task; the edges of each round are stored.
    """
    edges = stored(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "edges", narrow=True)
    while True:
        # large star: larger neighbours link to the smallest of the neighbourhood
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("m").alias("a"), "b").filter("a < b").distinct()
        # small star: smaller neighbours and the node itself link to the smallest
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b").select(F.col("m").alias("lo"), F.explode(F.array("a", "b")).alias("hi"))
        new = stored(small.filter("lo < hi").select(F.col("lo").alias("a"), F.col("hi").alias("b")).distinct(), "edges", narrow=True)
        same = new.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        was = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        edges = new
        if same == was:
            break
    return edges.select(F.col("b").alias("id"), F.col("a").alias("component")).unionByName(
        edges.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct()
    )


def confirm(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are linked; `texts` has id and text."""
    one = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.join(two, "b").join(one, "a").select("a", "b", "text_a", "text_b")
    return rows.mapInArrow(frugal(verifier(words, percent)), "a long, b long")


def classes(docs: DataFrame, words: int) -> tuple[DataFrame, DataFrame]:
    """Per document its set's key; per distinct set its smallest id, sketch and bands."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, n_shingles long, set_key binary, registers binary, bands array<long>"
    found = stored(rows.mapInArrow(frugal(sketcher(words)), schema), "sketches")
    own = found.filter("set_key IS NOT NULL AND doc_id IS NOT NULL")
    first = own.groupBy("set_key").agg(F.min("doc_id").alias("id"))
    kept = own.join(first.withColumnRenamed("id", "doc_id"), ["set_key", "doc_id"]).select(
        F.col("doc_id").alias("id"), "set_key", "n_shingles", "registers", "bands"
    )
    return found, stored(kept.dropDuplicates(["id", "set_key"]), "classes")


def link_classes(sets: DataFrame, docs: DataFrame, words: int, percent: int, hopeless: float) -> DataFrame:
    """Links (a, b) between classes that connect all of their components."""
    rows = sets.select("id", F.explode("bands").alias("band"))
    full = rows.groupBy("band").agg(F.count("*").alias("n"), F.min("id").alias("center")).filter("n > 1")
    members = stored(rows.join(full, "band"), "buckets")

    regs = sets.select("id", "n_shingles", "registers")
    side = lambda x: regs.select(F.col("id").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("registers").alias(f"reg_{x}"))
    stars = members.filter("id <> center").select(F.col("center").alias("a"), F.col("id").alias("b")).distinct()
    stars = stars.join(side("b"), "b").join(side("a"), "a").mapInArrow(estimator(hopeless), "a long, b long")

    used = members.select("id").distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(used, "id", "left_semi")
    texts = stored(texts.groupBy("id").agg(F.max("text").alias("text")), "texts")
    links = stored(confirm(stars, texts, words, percent), "links", narrow=True)

    part = stored(components(links), "components", narrow=True)
    member = members.join(part, "id", "left").withColumn("component", F.coalesce("component", "id"))
    # a bucket in one component has nothing left to find
    sizes = stored(member.groupBy("band", "component").agg(F.count("*").alias("size")), "bucket-parts", narrow=True)
    split = sizes.groupBy("band").agg(F.count("*").alias("parts"), F.max(F.struct("size", "component")).alias("main")).filter("parts > 1")
    left = member.join(split.select("band", F.col("main.component").alias("main")), "band").join(regs, "id")
    left = left.withColumn("apart", F.col("component") != F.col("main"))
    blocks = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    each = left.withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int"))
    # every member once, in its block; those outside the main component also go to each block
    again = left.filter("apart").withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    columns = ["band", "block", "id", "n_shingles", "component", "registers"]
    grouped = each.select(*columns, F.lit(False).alias("apart")).unionByName(again.select(*columns, F.lit(True).alias("apart")))
    more = grouped.groupBy("band", "block").applyInArrow(comparer(hopeless, FEW), "a long, b long, crowd boolean")
    more = stored(more.distinct(), "candidates", narrow=True)
    pairs = confirm(more.filter("NOT crowd").select("a", "b"), texts, words, percent)
    crowds = more.filter("crowd").select(F.col("a").alias("id"), F.col("b").alias("crowd"))
    return links.unionByName(stored(pairs, "links", narrow=True)).unionByName(stored(confirm_crowds(crowds, part, texts, words, percent), "links", narrow=True))


def confirm_crowds(crowds: DataFrame, part: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) between single texts and large components: (id, crowd) gives what to try.

    Components are cut into blocks; a member's text goes to its block, a single text to
    every block of its component.
    """
    member = part.join(crowds.select(F.col("crowd").alias("component")).distinct(), "component")
    blocks = member.groupBy("component").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"))
    member = member.join(blocks, "component").select(
        "component", F.pmod(F.xxhash64("id"), "blocks").cast("int").alias("block"), "id", F.lit(False).alias("apart")
    )
    single = crowds.join(blocks, F.col("crowd") == F.col("component")).select(
        "component", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "id", F.lit(True).alias("apart")
    )
    rows = member.unionByName(single).join(texts, "id")
    return rows.groupBy("component", "block").applyInArrow(crowd_verifier(words, percent), "a long, b long")


def near_duplicates(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, hopeless: float = HOPELESS
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, one row per row of `docs`.

    Links of at least `percent` hundredths of similarity are found with a probability of
    1 - 3e-7 each at the threshold and more above it; none that fails on the full sets is
    taken. Null and empty texts have no shingles and are linked with nothing. Rows that
    repeat an id share its component. Copies are one class and never meet in pairs.
    """
    found, sets = classes(docs, words)
    links = link_classes(sets, docs, words, percent, hopeless)
    part = components(links)
    root = sets.join(part, "id", "left").select("set_key", "id", F.coalesce("component", "id").alias("component"))
    out = found.select("doc_id", "n_shingles", "set_key").join(root.drop("id"), "set_key", "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents that `near_duplicates` keeps; columns as given. Of rows that repeat id and text one stays."""
    names = docs.columns
    kept = near_duplicates(docs).filter("kept").groupBy(F.col("doc_id").alias("kept_id")).agg(F.count("*").alias("rows"))
    kept = stored(kept, "kept", narrow=True)
    pick = lambda ids: docs.join(ids, F.col("doc_id").cast("long").eqNullSafe(F.col("kept_id")), "left_semi")
    several = kept.filter("rows > 1")
    out = pick(kept)
    if several.take(1):  # only then do texts travel a second time
        out = pick(kept.filter("rows = 1")).unionByName(pick(several).dropDuplicates(["doc_id", "text"]))
    return out.select(*[F.col(f"`{c}`") for c in names])
