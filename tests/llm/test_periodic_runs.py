from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from orderloom.llm import periodic_runs as runs
from orderloom.llm.queries import registered

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words_of(text):
    return WORD.findall((text or "").encode())


def all_runs(w):
    """Every run of three periods or more, by trying every period: (start, length, period)."""
    n, out = len(w), {}
    for q in range(1, n // 3 + 1):
        # all stretches in which words q apart are equal
        same = np.array([w[x] == w[x + q] for x in range(n - q)] + [False], bool)
        edges = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).astype(int)))
        for b, e in zip(edges[::2], edges[1::2], strict=True):
            if e - b + q >= 3 * q:
                out.setdefault((int(b), int(e - b + q)), q)
    return sorted((s, n, q) for (s, n), q in out.items())


def spoilt(doc_id, text):
    w = words_of(text)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def digest(w):
    found = [r for r in all_runs(w) if r[1] >= 24]
    drop = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (
        len(found),
        *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
        sha("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()),
        sha(b" ".join(x for i, x in enumerate(w) if i not in drop)),
    )


def key(rows):
    return sorted(rows, key=repr)


def test_given_documents(spark, sf_dir, table):
    """The whole table, against trying all periods of the shorter texts and round trips of all."""
    rows = [(r.doc_id, r.text) for r in table("documents").collect()]
    got = {r.doc_id: tuple(r)[1:] for r in registered()["op13_synchronised_runs"](spark, sf_dir).collect()}
    assert len(got) == len(rows)
    texts = [(i, w) for i, w in ((i, spoilt(i, t)) for i, t in rows) if len(w) <= 1500]
    assert len(texts) > 0.8 * len(rows)
    assert sum(got[i][0] > 0 for i, _ in texts) > 10
    for i, w in texts:
        assert got[i] == digest(w), i


def test_odd_rows(docs_of, odd_texts):
    loops = [(20, "a " * 500), (21, "x y\x1c z\x0b" * 30), (22, " ".join(["one two three"] * 8)), (22, " ".join(["one two three"] * 8)), (23, "b " * 23), (24, "b " * 24)]
    rows = [*odd_texts, *loops]
    for split in (1, 4):
        texts = runs.with_repeats(docs_of(rows, split))
        got = runs.digest(runs.collapse(texts)).collect()
        want = [(i, *digest(spoilt(i, t))) for i, t in rows if len(words_of(t)) < 5000]
        kept = [tuple(r) for r in got if r.doc_id != 4]
        assert key(kept) == key(want)
        assert len(got) == len(rows)
    assert runs.digest(runs.collapse(docs_of(rows).limit(0))).collect() == []


def test_what_is_given_out(docs_of):
    (row,) = runs.collapse(docs_of([(1, "head " + "a b c " * 9 + "tail")])).collect()
    assert row.asDict(recursive=True) == {
        "doc_id": 1, "n_words": 29, "runs": [{"start": 1, "length": 27, "period": 3}], "collapsed": "head a b c tail",
    }
    (row,) = runs.collapse(docs_of([(1, "head " + "a b c " * 9 + "tail")]), least=28).collect()
    assert row.runs == [] and row.collapsed.split() == ["head", *"a b c".split() * 9, "tail"]


def nested(seed):
    """Words with periods within periods, cut anywhere: what hashes and small periods trip over."""
    rng = np.random.default_rng(seed)
    w = rng.integers(0, 2, rng.integers(1, 4))
    for _ in range(rng.integers(1, 4)):
        w = np.concatenate([np.tile(w, rng.integers(1, 7)), rng.integers(0, 2, rng.integers(0, 4))])
    w = np.concatenate([rng.integers(0, 2, rng.integers(0, 5)), w, rng.integers(0, 2, rng.integers(0, 5))])
    return w[:600]


@pytest.mark.parametrize("seed", range(60))
def test_nested_periods(seed):
    texts = [nested(seed * 5 + k) for k in range(5)]
    got = runs.cubic_runs(np.concatenate(texts), [len(w) for w in texts]).tolist()
    assert got == [[k, *r] for k, w in enumerate(texts) for r in all_runs(w.tolist())]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=70), min_size=1, max_size=4))
def test_small_alphabets(texts):
    got = runs.cubic_runs(np.array([x for w in texts for x in w], np.int64), [len(w) for w in texts]).tolist()
    assert got == [[k, *r] for k, w in enumerate(texts) for r in all_runs(w)]


def test_every_period_and_a_long_text():
    rng = np.random.default_rng(3)
    for q in [*range(1, 80), 127, 128, 129, 1000]:
        w = np.concatenate([[7], np.tile(rng.permutation(q) + 10, 4)[: 3 * q + q // 2], [8, 9]])
        (row,) = [r for r in runs.cubic_runs(w, [len(w)]).tolist() if r[3] == q]
        assert row == [0, 1, 3 * q + q // 2, q]
    long = np.concatenate([np.tile(np.arange(997), 300), np.zeros(100_000, np.int64), np.arange(50_000)])
    assert runs.cubic_runs(long, [len(long)]).tolist() == [[0, 0, 299_101, 997], [0, 299_100, 100_001, 1]]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=8, max_size=200), st.sampled_from([1, 2, 4, 8]))
def test_the_set_is_consistent_and_dense(letters, t):
    """Equal contexts choose alike, and t places in a row are passed over in periodic regions only."""
    w = np.array(letters, np.int64)
    h = np.array([zlib.crc32(bytes(letters[i : i + t])) for i in range(len(w))], np.uint64)

    def periodic(i, size):
        s = letters[i : i + size]
        return any(all(s[x] == s[x + q] for x in range(size - q)) for q in range(1, t // 3 + 1))

    skip = np.array([len(w) - i >= t and periodic(i, t) for i in range(len(w))])
    n = len(w) - 2 * t + 1
    if n <= 0:
        return
    mask = runs._chosen(h, skip, t)[:n]
    for i in range(n):
        for j in range(i):
            if letters[i : i + 2 * t] == letters[j : j + 2 * t]:
                assert mask[i] == mask[j]
    for i in range(n - t + 1):
        if not mask[i : i + t].any():
            assert periodic(i, 3 * t - 1)
