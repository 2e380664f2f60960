from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from orderloom.llm import swap_packing as packing
from orderloom.llm.queries import registered
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def cut(ids, window=2048):
    first = len(ids) - (-(-len(ids) // window) - 1) * window
    return [ids[:first], *(ids[s : s + window] for s in range(first, len(ids), window))]


def check_windows(rows, capacity=2048):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_given_documents(spark, sf_dir, table, tokenizer):
    want = []
    for r in table("documents").collect():
        at = 0
        for k, ids in enumerate(cut(ids_of(tokenizer, r.text))):
            want.append((r.doc_id, k, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            at += len(ids)
    got = registered()["op12_swap_search"](spark, sf_dir).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    sizes = np.array([x[3] for x in want])
    assert check_windows(got) <= min(packing.fewest(sizes, 2048) + 1, len(packing.best_fit(sizes.tolist(), 2048)))


def test_odd_rows(docs_of, odd_texts, tokenizer):
    odd = ["<|endoftext|> x<|endoftext|>y", "é ́x Å\x1c\x1f\x85 　 Σ ς \U0001f600", "don't we'll I'D 123abc,,,  ...\n\n\n x", " " * 9000 + "x" + "\n" * 50]
    rows = [*odd_texts, *((9, t) for t in odd), *((10, "again and again") for _ in range(300))]
    for split in (1, 4):
        got = packing.pack_documents(docs_of(rows, split), group=2).collect()
        found = Counter((r.doc_id, r.piece, r.start, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got)
        want = Counter()
        for i, t in rows:
            at = 0
            for k, ids in enumerate(cut(ids_of(tokenizer, t))):
                want[i, k, at, tuple(ids)] += 1
                at += len(ids)
        assert found == want
        assert all(r.length == len(r.ids) // 4 for r in got)
        check_windows(got)
    assert packing.pack_documents(docs_of(rows).limit(0)).collect() == []


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60))
def test_ids_are_those_of_the_library(text):
    text = text.encode("utf-8", "ignore").decode()
    e = packing.encoder(PATH)
    assert e.fast
    for t in (text, f"a {text} b", text + "<|endoftext|>" + text):
        assert e.ids(t).tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids


def test_every_character(tokenizer):
    """Both libraries split words by Unicode classes of their own: they agree on all characters."""
    e = packing.encoder(PATH)
    for first in range(0, 0x110000, 512):
        text = "".join(f"a{chr(c)} {chr(c)}1" for c in range(first, first + 512) if not 0xD800 <= c <= 0xDFFF)
        assert e.ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_other_vocabularies_go_to_their_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    e = packing.Encoder(path)
    assert e.fast is None
    assert e.ids("Some Words").tolist() == Tokenizer.from_file(path).encode("Some Words", add_special_tokens=False).ids


def best(sizes, capacity):
    """The fewest bins, by trying all places of each piece."""
    least = len(sizes)

    def place(i, room):
        nonlocal least
        if len(room) >= least:
            return
        if i == len(sizes):
            least = len(room)
            return
        for b in range(len(room)):
            if room[b] >= sizes[i]:
                room[b] -= sizes[i]
                place(i + 1, room)
                room[b] += sizes[i]
        place(i + 1, [*room, capacity - sizes[i]])

    place(0, [])
    return least


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_small_sets(sizes):
    bins = packing.pack(np.array(sizes), 20)
    assert np.bincount(bins, sizes).max() <= 20
    assert packing.fewest(np.array(sizes), 20) <= best(sorted(sizes, reverse=True), 20) <= bins.max() + 1
    assert bins.max() + 1 <= len(packing.best_fit(sizes, 20))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 100), min_size=1, max_size=120), st.integers(100, 300))
def test_nothing_is_lost(sizes, capacity):
    bins = packing.pack(np.array(sizes), capacity)
    assert len(bins) == len(sizes) and bins.min() == 0
    assert np.bincount(bins, sizes).max() <= capacity
    assert sorted(set(bins.tolist())) == list(range(bins.max() + 1))


def test_each_kind_of_step_empties_a_bin():
    kinds = {
        "move": [[10], [90], [85, 5]],
        "one for one": [[10], [60, 30], [70, 22]],
        "two for one": [[6, 5], [60, 30], [95]],
        "one for two": [[12], [50, 25, 24], [88, 10]],
    }
    for name, bins in kinds.items():
        search = packing.Search([Counter(b) for b in bins], 100)
        search.gather([1, 2])
        before = [100 - r for r in search.room]
        taker, given, back = search.step(0)
        search.exchange(0, taker, given, back)
        after = [100 - r for r in search.room]
        assert sum(after) == sum(before) and max(after) <= 100, name
        assert sum(x * x for x in after) > sum(x * x for x in before), name
        assert Counter(s for b in search.bins for s in b.elements()) == Counter(s for b in bins for s in b), name


@pytest.mark.parametrize(("low", "high", "share"), [(200, 900, 0.999), (400, 700, 0.98), (500, 1100, 0.99)])
def test_search_beats_best_fit(low, high, share):
    sizes = np.random.default_rng(1).integers(low, high, 3000)
    start = packing.best_fit(sizes.tolist(), 2048)
    assert packing.pack(sizes).max() + 1 <= share * len(start)


def test_the_squared_fill_rises():
    sizes = np.random.default_rng(2).integers(300, 800, 500)
    bins = packing.best_fit(sizes.tolist(), 2048)
    squares = lambda some: sum(sum(b.elements()) ** 2 for b in some)
    before = squares(bins)
    assert squares(packing.empty_bins(bins, 2048, 0)) > before


def test_one_length_that_shares_with_none(spark):
    """No bin can be closed: one turn, and every piece has a window of its own."""
    got = packing.packed(spark.range(3000).selectExpr("id AS doc_id", "1500L AS length", "id AS offset"), group=100).collect()
    assert check_windows(got) == len(got) == 3000
    assert got[0].asDict().keys() == {"doc_id", "length", "sequence_id", "offset"}


def test_groups_leave_little_open(spark):
    """Many small groups fill nearly as well as one."""
    rows = spark.range(20_000).selectExpr("id AS doc_id", "1 + pmod(xxhash64(id), 1200) AS length")
    total = rows.agg({"length": "sum"}).first()[0]
    got = packing.packed(rows, group=64).collect()
    assert len(got) == 20_000
    assert check_windows(got) <= 1.002 * total / 2048
    again = packing.packed(rows, group=64).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
