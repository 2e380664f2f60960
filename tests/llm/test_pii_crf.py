from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from orderloom.llm import pii_crf
from orderloom.llm.queries import registered

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text: str) -> list[tuple[str, int, int]]:
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card":
                total = 0
                for i, c in enumerate(reversed(digits)):
                    d = int(c) * (1 + i % 2)
                    total += d - 9 if d > 9 else d
                if not 14 <= len(digits) <= 19 or total % 10:
                    continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return sorted(out, key=lambda x: (x[1], list(PLAIN).index(x[0])))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1.@+-_ ()05é2\n", max_size=60))
def test_base_spans_are_the_plain_patterns(text):
    assert pii_crf.base_spans(text) == brute(text)


def test_base_spans_of_long_runs_take_linear_time():
    for text in ("1" * 200_000, "a." * 200_000, "1." * 100_000, "a" * 300_000 + "@", "+1 " * 100_000):
        pii_crf.base_spans(text)


@pytest.fixture(scope="module")
def weights(spark, sf_dir):
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    return pii_crf.train(pii_crf.labelled([t for t in texts if pii_crf.TRIGGER.search(t)] + texts[:100]))


def test_gradients():
    w = pii_crf.initial(3)
    x = np.random.default_rng(0).integers(1, 90, (2, 7))
    y = np.array([[0, 1, 2, 2, 0, 3, 4], [0, 0, 5, 6, 0, 0, 0]]).T

    def loss(w):
        scores, *_ = pii_crf.emissions(w, x)
        total = pii_crf.posteriors(scores, w["step"])[2].sum()
        t, b = np.indices(y.shape)
        return float(total - scores[t, b, y].sum() - w["step"][y[:-1], y[1:]].sum())

    w = {k: v.astype(np.float64) for k, v in w.items()}
    scores, h, tf, tb = pii_crf.emissions(w, x, keep=True)
    place, pairs, _ = pii_crf.posteriors(scores, w["step"])
    grad = {k: np.zeros_like(v) for k, v in w.items()}
    t, b = np.indices(y.shape)
    place[t, b, y] -= 1
    dh = place @ w["out"].T
    pii_crf.lstm_back(w, "f", x.T, tf, dh[:, :, : pii_crf.HIDDEN], grad)
    pii_crf.lstm_back(w, "b", x.T[::-1], tb, dh[::-1, :, pii_crf.HIDDEN :], grad)
    for k, at in (("hf", (3, 5)), ("xb", (2, 20)), ("embed", (int(x[0, 0]), 1)), ("cf", (40,))):
        up, down = {**w, k: w[k].copy()}, {**w, k: w[k].copy()}
        up[k][at] += 1e-2
        down[k][at] -= 1e-2
        assert (loss(up) - loss(down)) / 2e-2 == pytest.approx(float(grad[k][at]), rel=0.05, abs=2e-3)


def test_held_out_accuracy(weights):
    """New written forms in new text: most base forms found, next to nothing else."""
    texts = [f"plain words go here {i} times and more words follow" for i in range(60)]
    windows = pii_crf.labelled(texts, seed=99)
    found = pii_crf.decode(weights, [t for t, _ in windows])
    labels = [{(k, s, e) for k, s, e in spans if e < pii_crf.LENGTH} for _, spans in windows]
    right = sum(len(a & set(b)) for a, b in zip(labels, found, strict=True))
    assert right >= 0.5 * sum(map(len, labels))
    wrong = sum(len(set(b) - a) for a, b in zip(labels, found, strict=True))
    assert wrong <= 0.1 * right


def test_forms_that_patterns_miss(weights):
    text = "please call (212) 555-0188 before noon"
    assert pii_crf.base_spans(text) == []
    assert pii_crf.decode(weights, [text]) == [[("phone", 12, 26)]]


def put_in(texts, form, seed):
    """A written form in the middle of each text, and where it is."""
    rng, out = np.random.default_rng(seed), []
    for t in texts:
        at = t.find(" ", int(rng.integers(20, max(21, len(t) - 20))))
        at = len(t) if at < 0 else at
        v = form(lambda n: "".join(map(str, rng.integers(0, 10, n))), lambda n: str(rng.integers(1, 10)) + "".join(map(str, rng.integers(0, 10, n - 1))))
        out.append((f"{t[:at]} {v} {t[at + 1 :]}", at + 1, at + 1 + len(v)))
    return out


# Written forms that no pattern finds; the last four are not the generator's.
FORMS = {
    "dashes": ("phone", lambda d, n: f"{n(3)}-{n(3)}-{d(4)}"),
    "dots": ("phone", lambda d, n: f"{n(3)}.{n(3)}.{d(4)}"),
    "spaces": ("phone", lambda d, n: f"{n(3)} {n(3)} {d(4)}"),
    "national": ("phone", lambda d, n: f"0{n(2)} {n(7)}"),
    "two zeros": ("phone", lambda d, n: f"00{n(2)} {n(2)} {n(7)}"),
    "at and dot": ("email", lambda d, n: f"jane.{d(2)} at mail{d(1)} dot com"),
    "in brackets": ("email", lambda d, n: f"sam_lee [at] host{d(1)} [dot] org"),
    "three groups": ("phone", lambda d, n: f"0{n(3)} {n(3)} {n(4)}"),
    "zero in a bracket": ("phone", lambda d, n: f"(0{n(2)}) {n(7)}"),
    "long national": ("phone", lambda d, n: f"0{n(4)} {n(6)}"),
    "a name of two": ("email", lambda d, n: f"ann.marie.{d(1)}(at)some-host.net"),
}
NONE = {
    "date": lambda d, n: f"19{d(2)}-0{n(1)}-1{d(1)}",
    "book": lambda d, n: f"978-{d(1)}-{d(2)}-{d(6)}-{d(1)}",
    "span": lambda d, n: f"19{d(2)}-20{d(2)} 1{d(1)}:{n(2)}",
    "price": lambda d, n: f"{n(1)},{d(3)},{d(3)}.{d(2)}",
    "part number": lambda d, n: f"QX-{d(4)}-{d(4)}-{d(4)}",
    "day first": lambda d, n: f"1{d(1)}.0{n(1)}.20{d(2)} 1{d(1)}:{n(2)}",
}


@pytest.fixture(scope="module")
def prose(table_of_documents):
    texts = [t for t in table_of_documents if t and 200 < len(t) < 3000 and not pii_crf.TRIGGER.search(t)]
    return (texts * 60)[:60]


@pytest.fixture(scope="module")
def table_of_documents(spark, sf_dir):
    return [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()]


@pytest.mark.parametrize("name", sorted(FORMS))
def test_recall_by_form(weights, prose, name):
    kind, form = FORMS[name]
    whole = put_in(prose, form, len(name))
    found = pii_crf.decode(weights, [t for t, _, _ in whole])
    right = sum(any(k == kind and s <= a and e >= b for k, s, e in f) for f, (_, a, b) in zip(found, whole, strict=True))
    assert right >= 0.6 * len(whole), right / len(whole)


@pytest.mark.parametrize("name", sorted(NONE))
def test_what_looks_like_one_stays(weights, prose, name):
    whole = put_in(prose, NONE[name], len(name))
    found = pii_crf.decode(weights, [t for t, _, _ in whole])
    wrong = sum(any(s < b and e > a for _, s, e in f) for f, (_, a, b) in zip(found, whole, strict=True))
    assert wrong <= 0.1 * len(whole), wrong / len(whole)


def test_prose_without_forms_is_left_alone(weights, table_of_documents):
    texts = [t for t in table_of_documents if t]
    base = [pii_crf.base_spans(t) for t in texts]
    added = [x for b, m in zip(base, pii_crf.decode(weights, texts), strict=True) for x in pii_crf.all_spans(b, m) if x not in b]
    assert len(added) <= 0.02 * len(texts)


def test_training_reads_the_whole_of_a_long_text(spark, docs_of, monkeypatch):
    """Parts of a long text come from all over it."""
    seen = []
    long = " ".join(f"at{i}at 7" for i in range(30_000))
    docs = docs_of([(1, long), (2, "short 5")])
    monkeypatch.setattr(pii_crf, "hash_sample", lambda df, *_: seen.extend(df.collect()) or df)
    pii_crf.fit(docs, steps=1)
    parts = {r.doc_id: r.text for r in seen}
    assert parts[2] == "short 5"
    pieces = parts[1].split("\n")
    assert len(pieces) == pii_crf.SECTIONS and all(len(x) == pii_crf.SECTION and x in long for x in pieces)
    places = [long.index(x) / len(long) for x in pieces]
    assert min(places) < 0.3 and max(places) > 0.7 and len(set(places)) == len(places)


def test_only_windows_with_a_trigger_can_give_spans(weights):
    """Leaving out windows without one changes nothing: such a span is never valid."""
    text = "words and words " * 40 + "mail joe.22@host3.example.com now " + "and words " * 60
    every = range(0, len(text) - pii_crf.LENGTH + pii_crf.STRIDE, pii_crf.STRIDE)
    own = pii_crf.window_starts
    few = pii_crf.decode(weights, [text])
    pii_crf.window_starts = lambda t: list(every)
    try:
        assert pii_crf.decode(weights, [text]) == few
    finally:
        pii_crf.window_starts = own


def test_odd_rows(docs_of, odd_texts, weights):
    rows = [*odd_texts, (9, "4111 1111 1111 1111"), (9, "4111 1111 1111 1111")]
    got = pii_crf.digest(pii_crf.find(docs_of(rows), weights)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[1].base_sha256 == hashlib.sha256(b"").hexdigest() and by[1].spans == ""
    assert by[9].n_card == 1 and by[9].base_sha256 == hashlib.sha256(b"card:0:19").hexdigest()
    assert pii_crf.find(docs_of(rows).limit(0)).collect() == []


def test_masking(docs_of, weights):
    docs = docs_of([(1, "to a.b@c.de or +1 (212) 555-0100."), (2, None), (3, "plain")])
    got = pii_crf.masked(docs, weights)
    assert got.columns == docs.columns
    assert {r.doc_id: (r.text, r.n_chars) for r in got.collect()} == {1: ("to [email] or [phone].", 22), 2: (None, 0), 3: ("plain", 5)}


def test_given_documents(spark, sf_dir, table):
    got = {r.doc_id: r for r in registered()["op2_pii"](spark, sf_dir).collect()}
    for r in table("documents").collect():
        want = brute(r.text)
        line = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        x = got[r.doc_id]
        assert x.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert [x.n_email, x.n_ip, x.n_card, x.n_phone] == [sum(k == kind for k, *_ in want) for kind in pii_crf.KINDS]
        assert set(line.split(",")) - {""} <= set(x.spans.split(","))
