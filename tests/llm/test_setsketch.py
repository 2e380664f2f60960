from __future__ import annotations

import numpy as np
import pytest
from orderloom.llm import setsketch
from orderloom.llm.queries import registered


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in low.translate({c: " " for c in (9, 10, 11, 12, 13)}).split(" ") if w]


def brute(rows):
    sets, ids = [], [i for i, _ in rows]
    for _, t in rows:
        w = words(t)
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = {}
    for k, s in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(k)
    for k, s in enumerate(sets):
        for j in {j for g in s for j in holders[g] if j < k}:
            both = len(s & sets[j])
            if 100 * both >= 75 * (len(s) + len(sets[j]) - both):
                root[find(k)] = find(j)
    least = {}
    for k in range(len(rows)):
        least[find(k)] = min(least.get(find(k), ids[k]), ids[k])
    return sorted((i, len(sets[k]), least[find(k)], i == least[find(k)]) for k, (i, _) in enumerate(rows))


def report(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect())


def test_given_documents(spark, sf_dir, table):
    rows = [(r.doc_id, r.text) for r in table("documents").collect()]
    assert report(registered()["op10_setsketch"](spark, sf_dir)) == brute(rows)


def edited(words, rng, n):
    out = list(words)
    for p in rng.integers(0, len(out), n):
        out[p] = f"edit{rng.integers(1 << 30)}"
    return " ".join(out)


def test_near_copies_of_many_degrees(docs_of, monkeypatch):
    """Chains, a crowd of copies with own edits, and pairs on both sides of the threshold."""
    monkeypatch.setattr(setsketch, "BLOCK", 16)
    monkeypatch.setattr(setsketch, "FEW", 1)
    rng = np.random.default_rng(8)
    base = [f"w{i}" for i in range(160)]
    rows = [(i, edited(base, rng, int(rng.integers(0, 7)))) for i in range(90)]
    for k in range(12):
        own = [f"v{k}x{i}" for i in range(100)]
        rows += [(1000 + 10 * k + j, edited(own, rng, j)) for j in range(5)]
    # a chain whose ends are unlike
    shift = [f"s{i}" for i in range(200)]
    rows += [(3000 + j, " ".join(shift[8 * j : 8 * j + 100])) for j in range(10)]
    rows = [rows[i] for i in rng.permutation(len(rows))]
    assert report(setsketch.near_duplicates(docs_of(rows))) == brute(rows)


def test_the_threshold_is_met_exactly(docs_of):
    """100 * 6 >= 75 * 8 links; 5 of 7 does not."""
    a = [f"a{i}" for i in range(11)]
    b = [f"b{i}" for i in range(10)]
    rows = [(1, " ".join(a)), (2, " ".join(["x", *a[1:10], "y"][1:10] + ["z"])), (3, " ".join(b)), (4, " ".join([*b[:9], "y"]))]
    assert report(setsketch.near_duplicates(docs_of(rows))) == brute(rows)


def test_odd_rows(docs_of, odd_texts):
    rows = [*[x for x in odd_texts if x[0] is not None], (20, "Same TEXT here, twice"), (21, "A"), (22, "one two three four"), (23, "ONE two three four")]
    docs = docs_of(rows)
    assert report(setsketch.near_duplicates(docs)) == brute(rows)
    assert setsketch.near_duplicates(docs.limit(0)).collect() == []
    kept = setsketch.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, _, _, k in brute(rows) if k]


def test_repeated_rows_and_missing_ids(docs_of):
    rows = [(1, "some words that repeat here and there"), (1, "some words that repeat here and there"), (2, "some words that repeat here and there"), (None, "alone without an id at all"), (None, None)]
    docs = docs_of(rows)
    got = setsketch.near_duplicates(docs).collect()
    assert len(got) == 5 and {r.component_id for r in got if r.doc_id} == {1}
    assert sorted(str(r.doc_id) for r in setsketch.one_of_each(docs).collect()) == ["1", "None", "None"]


def test_registers_merge_by_maximum():
    rng = np.random.default_rng(0)
    a, b = (np.unique(rng.integers(0, 2**63, 700).astype(np.uint64)) for _ in range(2))
    both = np.union1d(a, b)
    assert (np.maximum(setsketch.sketch(a), setsketch.sketch(b)) == setsketch.sketch(both)).all()


@pytest.mark.parametrize("share", [0.3, 0.6, 0.75, 0.9])
def test_estimates_are_near_the_truth(share):
    rng = np.random.default_rng(int(share * 100))
    error = []
    for _ in range(30):
        n = 400
        common = rng.integers(0, 2**63, int(n * 2 * share / (1 + share))).astype(np.uint64)
        a, b = (np.unique(np.concatenate([common, rng.integers(0, 2**63, n - len(common)).astype(np.uint64)])) for _ in range(2))
        ra, rb = setsketch.sketch(a)[None], setsketch.sketch(b)[None]
        error.append(setsketch.estimate(ra, rb, np.array([len(a)]), np.array([len(b)]))[0] - share)
    assert abs(np.mean(error)) < 0.03 and np.std(error) < 0.06


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 200), (300, 200), (7, 7)], "a long, b long")
    got = {r.id: r.component for r in setsketch.components(links).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys((100, 200, 300), 100)}
    assert setsketch.components(links.limit(0)).collect() == []
