from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
from orderloom.llm import suffix_levels
from orderloom.llm.queries import registered


def brute(rows, length=200):
    texts = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(b[s : s + length] for _, b in texts for s in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        on = np.zeros(len(b) + 1, bool)
        for s in range(len(b) - length + 1):
            if count[b[s : s + length]] > 1:
                on[s : s + length] = True
        kept = bytes(c for c, x in zip(b, on, strict=False) if not x)
        starts = int((on[1:] & ~on[:-1]).sum() + on[:1].sum())
        out.append((i, len(b), int(on.sum()), starts, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def report(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)


def cleaned(docs):
    return report(suffix_levels.digest(suffix_levels.without_repeats(docs)))


def test_given_documents(spark, sf_dir, table):
    rows = [(r.doc_id, r.text) for r in table("documents").collect()]
    assert report(registered()["op7_suffix_levels"](spark, sf_dir)) == brute(rows)


def text(seed: int, n: int) -> str:
    return "".join(np.random.default_rng(seed).choice(list("abcdefgh éß"), n))


def test_planted_repeats(docs_of):
    a, b, c = text(1, 500), text(2, 900), text(3, 700)
    rows = [
        (1, a + b + c),  # holds a and c
        (2, text(4, 300) + a + text(5, 300)),
        (3, c[:190] + text(6, 40)),  # too short
        (4, c[100:330] + text(7, 300) + c[400:650]),
        (5, b[:450] + "X" + b[451:]),  # an edit in the middle
        (6, text(8, 260) * 3),  # repeats itself
        (7, "z" * 450),  # every string of itself
        (8, "ab" * 130),
        (9, text(9, 199)), (9, text(9, 199)),
        (10, text(10, 200)), (10, text(10, 200)),
    ]
    assert cleaned(docs_of(rows)) == brute(rows)


def test_many_near_copies(docs_of):
    """Each copy with its own edits: contexts of one anchor differ in many ways."""
    base, rng, rows = text(20, 1500), np.random.default_rng(3), []
    for i in range(60):
        t = list(base)
        for p in rng.integers(0, len(t), int(rng.integers(0, 9))):
            t[p] = "#"
        rows.append((i, "".join(t[int(rng.integers(0, 50)) :])))
    assert cleaned(docs_of(rows, 5)) == brute(rows)


def test_odd_rows(docs_of, odd_texts):
    rows = [x for x in odd_texts if x[0] != 4]
    assert cleaned(docs_of(rows)) == brute(rows)
    assert cleaned(docs_of(rows).limit(0)) == []


def test_very_long_texts(docs_of, monkeypatch):
    """Texts that don't fit one buffer are cut without losing a string."""
    monkeypatch.setattr(suffix_levels, "CHUNK", 1 << 12)
    suffix_levels.powers.cache_clear()
    part = text(30, 2000)
    rows = [(1, text(31, 9000) + part + text(32, 7001)), (2, part), (3, text(33, 4096)), (4, text(34, 4095)), (5, text(31, 9000)[3000:8000])]
    found = list(suffix_levels.pieces([t.encode() for _, t in rows], 200))
    assert all(len(b) < 1 << 12 for b, _ in found)
    strings = Counter()
    for buffer, where in found:
        ends = [w[1] for w in where[1:]] + [len(buffer)]
        for (k, first, start), last in zip(where, ends, strict=True):
            for s in range(first, last - 199):
                strings[k, start + s - first] += 1
    assert strings == Counter((k, s) for k, (_, t) in enumerate(rows) for s in range(len(t.encode()) - 199))
    suffix_levels.powers.cache_clear()


def test_long_text_through_the_operator(docs_of):
    part = text(40, 3000)
    long = "".join(f"{i} " for i in range(250_000))
    rows = [(1, long + part), (2, part[5:]), (3, long[1_048_000:1_049_500])]
    got = {r[0]: r for r in cleaned(docs_of(rows))}
    assert got[2][2] == got[2][1] and got[3][2] == got[3][1]
    assert got[1][2] == len(part[5:].encode()) + 1500


@pytest.mark.parametrize("batches", [1, 2, 7, 16])
def test_the_family_finds_what_sorting_finds(batches):
    rng = np.random.default_rng(batches)
    values = rng.integers(0, 4000, 5000).astype(np.uint64)
    family = suffix_levels.Family()
    for part in np.array_split(values, batches):
        family.add(part)
    count = Counter(values.tolist())
    assert family.twice.tolist() == [count[v] > 1 for v in values.tolist()]
    ranks = [r for r, *_ in family.levels]
    assert ranks == sorted(set(ranks), reverse=True) and len(ranks) == bin(batches).count("1")
    assert all((np.diff(v.astype(np.int64)) >= 0).all() for _, v, _ in family.levels)
