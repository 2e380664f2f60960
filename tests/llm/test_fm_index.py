from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from orderloom.llm import fm_index
from orderloom.llm.queries import registered


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(rows, items, window=10):
    windows = {}
    for i, t in items:
        w = words(t)
        for s in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[s : s + window]), set()).update([] if i is None else [str(i)])
    sizes = sorted({len(w) for w in windows})
    out = []
    for i, t in rows:
        w = words(t)
        hit, found = set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in windows:
                    hit.update(range(s, s + n))
                    found |= windows[tuple(w[s : s + n])]
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def report(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()), key=str)


def items_of(spark, items):
    return spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS item", "2 AS spans")


@pytest.mark.parametrize("sample", [1, 3, 16])
def test_index_counts_and_locates(sample):
    rng = np.random.default_rng(sample)
    runs = [rng.integers(1, 5, int(n)) for n in rng.integers(1, 60, 40)]
    seq = np.concatenate([np.append(r, 0) for r in runs])
    starts = np.cumsum([0] + [len(r) + 1 for r in runs[:-1]])
    index = fm_index.FMIndex(seq, 5, starts, sample)
    for n in (1, 2, 3, 5, 9):
        for s in range(0, len(seq) - n, 7):
            phrase = seq[s : s + n]
            if 0 in phrase:
                continue
            low, high = index.search(phrase[None, :], np.array([n]))
            want = [p for p in range(len(seq) - n + 1) if (seq[p : p + n] == phrase).all()]
            assert sorted(index.locate(np.arange(low[0], high[0])).tolist()) == want


def test_wavelet_ranks():
    rng = np.random.default_rng(0)
    v = rng.integers(0, 37, 1000)
    m = fm_index.WaveletMatrix(v, 37)
    at = np.arange(1001)
    for s in range(37):
        assert (m.rank(np.full(1001, s), at) == np.concatenate([[0], np.cumsum(v == s)])).all()
    symbol, before = m.access(np.arange(1000))
    assert (symbol == v).all()
    assert all(before[i] == (v[:i] == v[i]).sum() for i in range(0, 1000, 13))


def test_given_documents(spark, sf_dir, table):
    rows = [(r.doc_id, r.text) for r in table("documents").collect()]
    items = [(r.item_id, r.text) for r in table("benchmark").collect()]
    assert report(registered()["op8_fm_index"](spark, sf_dir)) == brute(rows, items)


ITEMS = [
    (1, "one two three four five six seven eight nine ten eleven"), (2, "One TWO three: four five six seven eight nine ten!"),
    (10, "short item"), (9, "Ünï çödé wörd"), (3, None), (4, ""), (5, "..."), (6, "a a a a a a a a a a a a"), (6, "b b b"),
]


def test_odd_rows(spark, docs_of, odd_texts):
    rows = [
        *odd_texts,
        (11, "x one two three four five six seven eight nine ten eleven y"),
        (12, "one two three four five six seven eight nine, then"),
        (13, "a SHORT... item a short item short"), (13, "a short item"),
        (14, "ünï çödé wörd ÜNÏ"), (15, "a " * 40), (16, "one two three four five six seven eight nine ten " * 3),
    ]
    docs, items = docs_of(rows), items_of(spark, ITEMS)
    assert report(fm_index.digest(fm_index.locate(docs, items))) == brute(rows, ITEMS)
    assert report(fm_index.digest(fm_index.locate(docs.limit(0), items))) == []
    assert report(fm_index.digest(fm_index.locate(docs, items.limit(0)))) == brute(rows, [])


def test_blocks_of_items_merge(spark, docs_of, monkeypatch):
    rows = [(1, "one two three four five six seven eight nine ten eleven short item"), (2, "b b b b"), (3, "none")]
    monkeypatch.setattr(fm_index, "BLOCK_BYTES", 20)
    assert report(fm_index.digest(fm_index.locate(docs_of(rows), items_of(spark, ITEMS)))) == brute(rows, ITEMS)


def test_cleaning(spark, docs_of):
    rows = [(1, "Keep this. One two three four five six seven eight nine TEN! And this."), (2, "untouched Text"), (3, "short item"), (4, None)]
    docs = docs_of(rows)
    got = fm_index.clean(docs, items_of(spark, ITEMS))
    assert got.columns == docs.columns
    assert {r.doc_id: (r.text, r.n_chars) for r in got.collect()} == {1: ("Keep this. ! And this.", 22), 2: ("untouched Text", 14), 4: (None, 0)}


def test_an_item_without_id_hits_but_is_not_listed(spark, docs_of):
    items = [(None, "one two three four"), (7, "five six seven"), (None, None), (8, None)]
    rows = [(1, "zero one two three four five"), (2, "five six seven"), (3, "one two three four, five six seven"), (4, "none")]
    got = report(fm_index.digest(fm_index.locate(docs_of(rows), items_of(spark, items))))
    assert got == brute(rows, items)
    assert [(r[2], r[3]) for r in got] == [(4, 0), (3, 1), (7, 1), (0, 0)]
    only = [(None, "one two three four")]
    assert report(fm_index.digest(fm_index.locate(docs_of(rows), items_of(spark, only)))) == brute(rows, only)
