from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from orderloom.llm import class_lm
from orderloom.llm.queries import registered


def brute(rows):
    """Contract columns by plain counting."""
    tokens = {k: class_lm.words((t or "").encode()) for k, (_, t) in enumerate(rows)}
    out_of = {k: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for k, (i, _) in enumerate(rows)}
    count, ends = Counter(), 0
    for k, w in tokens.items():
        if not out_of[k]:
            count.update(w)
            ends += 1
    n, v = sum(count.values()) + ends, len(count) + (ends > 0)
    out = []
    for k, (i, _) in enumerate(rows):
        base = sum(math.log10((c + 1) / (n + v + 1)) for c in [*[count[w] for w in tokens[k]], ends])
        known = sum(count[w] > 0 for w in tokens[k]) + (ends > 0)
        out.append((i, out_of[k], len(tokens[k]) + 1, known, n, round(base, 6)))
    return sorted(out, key=str)


def contract(df):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in df.collect()), key=str)


def brute_score(rows, clustered, classes):
    """The model's probabilities one token at a time, from its counts; only the clustering is taken as it is."""
    texts = [class_lm.words((t or "").encode()) for _, t in rows]
    train = [w for w, (i, _) in zip(texts, rows, strict=True) if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    n = Counter(x for w in train for x in w)
    place = {w: 1 + k for k, w in enumerate(sorted(n, key=lambda w: (-n[w], w))[:clustered])}
    symbol = lambda w: place.get(w, 1 + len(place) + class_lm.form(w))
    size = 1 + len(place) + class_lm.FORMS
    counts = np.zeros((size, size), np.int64)
    for w in train:
        line = [0, *map(symbol, w), 0]
        for a, b in zip(line[:-1], line[1:], strict=True):
            counts[a, b] += 1
    of = class_lm.exchange(counts, len(place), classes)
    k = int(of.max()) + 1
    steps, tokens, kinds = Counter(), Counter(), Counter(of[symbol(w)] for w in n)
    for w in train:
        line = [of[x] for x in (0, *map(symbol, w), 0)]
        steps.update(zip(line[:-1], line[1:], strict=True))
        tokens.update(line[1:])
    before = Counter()
    for (a, _), c in steps.items():
        before[a] += c
    out = []
    for (i, _), w in zip(rows, texts, strict=True):
        total, last = 0.0, 0
        for x in [*w, None]:
            c = of[0 if x is None else symbol(x)]
            total += math.log10((steps[last, c] + class_lm.SMOOTH) / (before[last] + class_lm.SMOOTH * k))
            if x is not None:
                total += math.log10((n[x] + 1) / (tokens[c] + kinds[c] + 1))
            last = c
        out.append((i, total))
    return sorted(out, key=str)


@pytest.mark.parametrize(("clustered", "classes"), [(1, 1), (5, 2), (40, 6), (10_000, 8)])
def test_score_is_that_of_the_model(docs_of, clustered, classes):
    rng = np.random.default_rng(clustered)
    names = [f"w{i}" for i in range(30)] + ["The", "end.", "é", "longerword", "9", "x,"]
    rows = [(i, " ".join(rng.choice(names, rng.integers(0, 40)))) for i in range(60)] + [(60, None), (61, ""), (62, "unseen words only"), (None, "w1 w2")]
    docs = docs_of(rows).persist()
    got = sorted(((r.doc_id, r.score) for r in class_lm.score(docs, clustered, classes).collect()), key=str)
    want = brute_score(rows, clustered, classes)
    assert [i for i, _ in got] == [i for i, _ in want]
    assert np.allclose([s for _, s in got], [s for _, s in want], rtol=0, atol=1e-6)


def test_odd_rows(docs_of, odd_texts):
    rows = [*odd_texts, (9, "The the THE a"), (9, "The the THE a"), (10, "a " * 70_000)]
    docs = docs_of(rows).persist()  # read three times: the same batches each time
    got = class_lm.score(docs)
    assert contract(got) == brute(rows)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got.collect())
    assert class_lm.score(docs_of(rows).limit(0).persist()).collect() == []


def test_given_documents(spark, sf_dir, table):
    got = registered()["op3_class_lm"](spark, sf_dir)
    rows = [(r.doc_id, r.text) for r in table("documents").collect()]
    assert contract(got) == brute(rows)


def test_held_out_texts_are_likelier_than_by_words_alone(spark, sf_dir):
    got = registered()["op3_class_lm"](spark, sf_dir).filter("held_out").selectExpr("sum(score)", "sum(base_score)").first()
    assert got[0] > got[1]


def test_probabilities_sum_to_one():
    """Over classes after any class; over the words of a class at most one."""
    counts = np.random.default_rng(1).integers(0, 9, (27, 27))
    of = class_lm.exchange(counts, 10, 4)
    k = of.max() + 1
    step = np.zeros((k, k))
    np.add.at(step, (of[:, None], of[None, :]), counts)
    p = (step + class_lm.SMOOTH) / (step.sum(1, keepdims=True) + class_lm.SMOOTH * k)
    assert p.sum(1) == pytest.approx(np.ones(k))


def likelihood(counts, of):
    k = of.max() + 1
    grid = np.zeros((k, k))
    np.add.at(grid, (of[:, None], of[None, :]), counts.astype(float))
    return class_lm.xlogx(grid).sum() - class_lm.xlogx(grid.sum(0)).sum() - class_lm.xlogx(grid.sum(1)).sum()


def test_exchange_leaves_no_better_single_move():
    rng = np.random.default_rng(4)
    counts = rng.poisson(1.0, (1 + 12 + 2, 15)) * rng.integers(1, 5, (15, 1))
    of = class_lm.exchange(counts, 12, 4, sweeps=50)
    best = likelihood(counts, of)
    start = np.concatenate([[0], 1 + np.arange(12) % 4, 5 + np.arange(2)])
    assert best >= likelihood(counts, start) - 1e-6
    for w in range(1, 13):
        for c in range(1, 5):
            other = of.copy()
            other[w] = c
            assert likelihood(counts, other) <= best + 1e-6


def test_exchange_finds_words_that_stand_alike():
    rng = np.random.default_rng(0)
    a, b = list(range(1, 6)), list(range(6, 11))
    counts = np.zeros((11, 11), int)
    for _ in range(3000):
        counts[rng.choice(a), rng.choice(b)] += 1
        counts[rng.choice(b), rng.choice(a)] += 1
    of = class_lm.exchange(counts, 10, 2)
    assert len(set(of[a])) == len(set(of[b])) == 1 and of[1] != of[6]


@pytest.mark.parametrize("word", [b"a", b"word,", b"caf\xc3\xa9", b"x9", b"longerword", b"9.", b"a" * 50 + b"7", b"\xff!"])
def test_forms_are_the_same_in_both_languages(spark, word):
    df = spark.createDataFrame([(bytearray(word),)], "w binary")
    assert df.select(class_lm.form_of("w")).first()[0] == class_lm.form(word)
