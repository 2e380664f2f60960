"""Personal data: fixed patterns, and what a character BiLSTM-CRF adds to them.

The patterns give the base spans. A bidirectional LSTM over characters with CRF
transitions, trained here in numpy on labelled spans, reads overlapping windows;
each window is decoded by itself, and the spans of all windows of a text are
reconciled: fragments of one span join, the most certain of conflicting ones stays.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import frugal, hash_sample, slices, with_columns

KINDS = ("email", "ip", "card", "phone")
TAGS = 1 + 2 * len(KINDS)  # O, then B and I of each kind
LENGTH, STRIDE = 96, 48
HIDDEN, EMBED = 16, 12
SAMPLE_DOCS = 400  # documents whose text and base spans train the model
STEPS, BATCH, RATE = 800, 48, 0.012
WINDOWS = 6000  # with written forms put in, at least
SECTIONS, SECTION = 20, 1000  # parts of a longer text that train the model, and their characters
OWN = 5  # windows around a text's own triggers that train it
BATCH_BYTES = 4 << 20  # of texts that are searched at once
SURE = 0.65  # least mean posterior of a span's tags
TRIGGER = re.compile(r"[0-9@]|[\[(]at[\])]| at \S+ dot ")

# ---- base patterns ---------------------------------------------------------------

_LOCAL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def is_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def is_card(text: str) -> bool:
    digits = "".join(_DIGITS.findall(text))
    return 14 <= len(digits) <= 19 and luhn(digits)


def is_phone(text: str) -> bool:
    return 10 <= len(_DIGITS.findall(text)) <= 15


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches in linear time: each at sign ends one run of local characters."""
    out, last = [], 0
    for m in _LOCAL.finditer(text):
        start, at = max(m.start(), last), m.end()
        if start < at - 1 and (d := _DOMAIN.match(text, at)):
            last = d.end()
            out.append((start, last))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost non-overlapping matches of each kind that pass its test, by start and kind."""
    out = [("email", s, e) for s, e in emails(text)] if "@" in text else []
    if _DIGITS.search(text):
        for kind, pattern, passes in (("ip", _IP, is_ip), ("card", _CARD, is_card), ("phone", _PHONE, is_phone)):
            out += [(kind, *m.span()) for m in pattern.finditer(text) if passes(m.group())]
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


# ---- the model -------------------------------------------------------------------

# Characters as classes: ASCII by itself, other letters, other white space, the rest; 0 pads.
_ASCII = np.arange(1, 129)
OTHER_LETTER, OTHER = 129, 130
SYMBOLS = 131


def codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.where(points >= 0xC0, OTHER_LETTER, OTHER)
    ascii_ = points < 128
    out[ascii_] = _ASCII[points[ascii_]]
    return out.astype(np.int64)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * (np.tanh(np.float32(0.5) * x) + np.float32(1))


def initial(seed: int = 11) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    normal = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
    w = {"embed": rng.standard_normal((SYMBOLS, EMBED)).astype(np.float32) * np.float32(0.5)}
    for d in "fb":
        w |= {f"x{d}": normal(EMBED, 4 * HIDDEN), f"h{d}": normal(HIDDEN, 4 * HIDDEN), f"c{d}": np.zeros(4 * HIDDEN, np.float32)}
        w[f"c{d}"][HIDDEN : 2 * HIDDEN] = 1  # remember at first
    return w | {"out": normal(2 * HIDDEN, TAGS), "bias": np.zeros(TAGS, np.float32), "step": np.zeros((TAGS, TAGS), np.float32)}


def lstm(w: dict, d: str, x: np.ndarray, keep: bool = False):
    """States of one direction; x: (length, batch) of codes in reading order."""
    table = w["embed"] @ w[f"x{d}"] + w[f"c{d}"]
    n, b = x.shape
    h, c = np.zeros((b, HIDDEN), np.float32), np.zeros((b, HIDDEN), np.float32)
    out, trace = np.empty((n, b, HIDDEN), np.float32), []
    for t in range(n):
        z = table[x[t]] + h @ w[f"h{d}"]
        s = sigmoid(z[:, : 3 * HIDDEN])
        i, f, o = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :]
        g = np.tanh(z[:, 3 * HIDDEN :])
        before, c = c, f * c + i * g
        u = np.tanh(c)
        if keep:
            trace.append((i, f, o, g, before, u, h))
        h = o * u
        out[t] = h
    return out, trace


def lstm_back(w: dict, d: str, x: np.ndarray, trace: list, dh_all: np.ndarray, grad: dict) -> None:
    b = x.shape[1]
    dh_next, dc = np.zeros((b, HIDDEN), np.float32), np.zeros((b, HIDDEN), np.float32)
    dtable = np.zeros((SYMBOLS, 4 * HIDDEN), np.float32)
    for t in reversed(range(len(trace))):
        i, f, o, g, before, u, h_before = trace[t]
        dh = dh_all[t] + dh_next
        dc = dc + dh * o * (1 - u * u)
        dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * u * o * (1 - o), dc * i * (1 - g * g)], 1)
        grad[f"h{d}"] += h_before.T @ dz
        np.add.at(dtable, x[t], dz)
        dh_next, dc = dz @ w[f"h{d}"].T, dc * f
    grad[f"x{d}"] += w["embed"].T @ dtable
    grad[f"c{d}"] += dtable.sum(0)
    grad["embed"] += dtable @ w[f"x{d}"].T


def emissions(w: dict, x: np.ndarray, keep: bool = False):
    """Tag scores (length, batch, tags) of windows x (batch, length)."""
    forward, tf = lstm(w, "f", x.T, keep)
    backward, tb = lstm(w, "b", x.T[::-1], keep)
    h = np.concatenate([forward, backward[::-1]], 2)
    return h @ w["out"] + w["bias"], h, tf, tb


def lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis, keepdims=True)) + top).squeeze(axis)


def posteriors(scores: np.ndarray, step: np.ndarray):
    """Of tags at each place, of tag pairs (their sum over places), and the log sums."""
    n = len(scores)
    a, z = np.empty_like(scores), np.zeros_like(scores)
    a[0] = scores[0]
    for t in range(1, n):
        a[t] = lse(a[t - 1][:, :, None] + step, 1) + scores[t]
    for t in reversed(range(n - 1)):
        z[t] = lse(step + (scores[t + 1] + z[t + 1])[:, None, :], 2)
    total = lse(a[-1], 1)
    place = np.exp(a + z - total[:, None])
    pairs = np.zeros_like(step)
    for t in range(1, n):
        pairs += np.exp(a[t - 1][:, :, None] + step + (scores[t] + z[t])[:, None, :] - total[:, None, None]).sum(0)
    return place, pairs, total


def viterbi(scores: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Best tags (batch, length)."""
    n, b, _ = scores.shape
    best, came = scores[0], np.empty(scores.shape, np.int8)
    for t in range(1, n):
        options = best[:, :, None] + step
        came[t] = options.argmax(1)
        best = options.max(1) + scores[t]
    tags = np.empty((b, n), np.int64)
    tags[:, -1] = best.argmax(1)
    rows = np.arange(b)
    for t in reversed(range(1, n)):
        tags[:, t - 1] = came[t][rows, tags[:, t]]
    return tags


def train(windows: list[tuple[str, list[tuple[str, int, int]]]], steps: int = STEPS, seed: int = 11) -> dict:
    """Fit the model to labelled windows by the CRF's likelihood, with Adam."""
    w = initial(seed)
    if not windows:
        return w
    x = np.zeros((len(windows), LENGTH), np.int64)
    y = np.zeros((len(windows), LENGTH), np.int64)
    for k, (text, spans) in enumerate(windows):
        c = codes(text)[:LENGTH]
        x[k, : len(c)] = c
        for kind, s, e in spans:
            tag = 1 + 2 * KINDS.index(kind)
            y[k, s:e] = tag + 1
            if s < LENGTH:
                y[k, s] = tag
    rng = np.random.default_rng(seed)
    m1, m2, n = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}, 0
    while n < steps:
        order = rng.permutation(len(x))
        for s in range(0, min(len(x), (steps - n) * BATCH), BATCH):
            xb, yb = x[order[s : s + BATCH]], y[order[s : s + BATCH]].T
            scores, h, tf, tb = emissions(w, xb, keep=True)
            place, pairs, _ = posteriors(scores, w["step"])
            grad = {k: np.zeros_like(v) for k, v in w.items()}
            ds = place.copy()
            t, b = np.indices(yb.shape)
            ds[t, b, yb] -= 1
            grad["step"] = pairs
            np.subtract.at(grad["step"], (yb[:-1].ravel(), yb[1:].ravel()), 1)
            grad["out"], grad["bias"] = np.einsum("tbh,tbk->hk", h, ds), ds.sum((0, 1))
            dh = ds @ w["out"].T
            lstm_back(w, "f", xb.T, tf, dh[:, :, :HIDDEN], grad)
            lstm_back(w, "b", xb.T[::-1], tb, dh[::-1, :, HIDDEN:], grad)
            n += 1
            rate = RATE * (1 - (n - 1) / steps)
            for k, g in grad.items():
                g = np.clip(g / len(xb), -1, 1)
                m1[k] = 0.9 * m1[k] + 0.1 * g
                m2[k] = 0.99 * m2[k] + 0.01 * g * g
                w[k] = (w[k] - rate * (m1[k] / (1 - 0.9**n)) / (np.sqrt(m2[k] / (1 - 0.99**n)) + 1e-6)).astype(np.float32)
    return w


# ---- labelled windows ------------------------------------------------------------


def written(rng: np.random.Generator) -> tuple[str, str | None]:
    """A written form and its kind: forms the patterns know, forms they miss, and what looks like one and is none."""
    d = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    n = lambda k: str(rng.integers(1, 10)) + d(k - 1)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), int(rng.integers(2, 9))))
    sort = rng.choice(["email", "ip", "card", "phone", "none"], p=[0.22, 0.1, 0.16, 0.27, 0.25])
    if sort == "email":
        name = str(rng.choice([f"{word()}.{d(2)}", word(), f"{word()}_{word()}", f"{word()}.{word()}"]))
        host, end = word() + str(rng.choice(["", d(1)])), str(rng.choice(["com", "org", "net", "de", "example.com"]))
        at = str(rng.choice(["@", " (at) ", "[at]", "(at)", " [at] ", " at "]))
        if at == "@" or rng.integers(0, 2) and at != " at ":
            return f"{name}{at}{host}.{end}", sort
        dot = " dot " if at == " at " else str(rng.choice([" dot ", "(dot)", "[dot]", " [dot] "]))
        return f"{name}{at}{host}{dot}{end.replace('.', dot)}", sort
    if sort == "ip":
        return ".".join(str(p) for p in rng.integers(0, 256, 4)), sort
    if sort == "card":
        body = str(rng.choice(["4", "5", "3", "6"])) + d(14)
        body += next(c for c in "0123456789" if luhn(body + c))
        return str(rng.choice([body, " ".join(re.findall("....", body)), ".".join(re.findall("....", body))])), sort
    if sort == "phone":
        x, y, z = n(3), n(3), d(4)
        forms = [
            f"+{rng.integers(1, 99)} ({x}) {y}-{z}", f"({x}) {y}-{z}", f"({x}) {y} {z}", *[f"{x}{c}{y}{c}{z}" for c in "--- ..."],
            f"{x} {y} {z}", f"{x} {y}-{z}", f"1-{x}-{y}-{z}", f"0{n(2)}/{n(7)}", f"0{n(2)} {n(7)}", f"0{n(3)} {n(6)}", f"0{n(3)}-{n(7)}", f"00{n(2)} {n(2)} {n(7)}", f"0{n(1)} " + " ".join(d(2) for _ in range(4)),
        ]
        return str(rng.choice(forms)), sort
    forms = [
        f'"{rng.bytes(16).hex()}"', f"{d(1)}.{d(1)}.{d(1)}", f"{rng.integers(1900, 2100)}-0{n(1)}-1{d(1)}", f"1{d(1)}.0{n(1)}.{rng.integers(1900, 2100)}",
        f"{n(2)}/{n(2)}/{rng.integers(1900, 2100)}", f"{n(1)},{d(3)},{d(3)}.{d(2)}", f"{n(3)} {d(3)} {d(3)} {d(3)}", f"${n(4)}.{d(2)}", n(int(rng.integers(4, 14))),
        f"978-{d(1)}-{d(2)}-{d(6)}-{d(1)}", f"{rng.integers(1900, 2000)}-{rng.integers(2000, 2100)}", f"1{d(1)}:{n(2)}:{n(2)}", f"{word().upper()}-{d(4)}-{d(3)}", f"{word().upper()}-{d(4)}-{d(4)}-{d(4)}",
        f"{rng.integers(1900, 2100)}-0{n(1)}-1{d(1)} 1{d(1)}:{n(2)}", f"{n(1)}.{d(5)}", f"{word()} at {word()} dot", f"{n(5)}-{n(5)}", f"{n(2)}.{d(3)}.{d(3)}.{d(3)}",
    ]
    return str(rng.choice(forms)), None


def labelled(texts: list[str], seed: int = 5) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Windows with base spans of real texts, and of real text with written forms put in."""
    rng, out = np.random.default_rng(seed), []
    each = max(6, -(-WINDOWS // max(1, len(texts))))
    for text in texts:
        spans = base_spans(text)
        own = [m.start() for m in TRIGGER.finditer(text)]
        for place in rng.permutation(own)[:OWN].tolist():
            s = max(0, place - int(rng.integers(10, 70)))
            inside = [(k, max(a, s) - s, min(b, s + LENGTH) - s) for k, a, b in spans if a < s + LENGTH and b > s]
            out.append((text[s : s + LENGTH], inside))
        for _ in range(each):
            s = int(rng.integers(0, max(1, len(text) - LENGTH)))
            around = text[s : s + LENGTH].split(" ")
            at = int(rng.integers(0, len(around) + 1))
            before = " ".join(around[:at])[-60:]
            form, kind = written(rng)
            whole = f"{before} {form} {' '.join(around[at:])}"[:LENGTH]
            a = len(before) + 1
            b = min(a + len(form), LENGTH)
            here = [(kind, a, b)] if kind and a < LENGTH else []
            here += [x for x in base_spans(whole) if x[2] <= a or x[1] >= b]
            out.append((whole, here))
    return out


def save(w: dict) -> bytes:
    to = io.BytesIO()
    np.savez(to, **w)
    return to.getvalue()


def load(raw: bytes) -> dict:
    with np.load(io.BytesIO(raw)) as z:
        return dict(z)


def fit(docs: DataFrame, sample: int = SAMPLE_DOCS, steps: int = STEPS) -> dict:
    """Train in one task on a bounded sample of texts that hold a trigger, chosen by hash.

    Of a text longer than `SECTIONS` times `SECTION` characters so many parts train the model, each from
    a place anywhere in the text that a hash chooses; finding reads all of it.
    """
    rows = docs.filter(F.col("text").rlike(TRIGGER.pattern))
    size = F.length("text")
    start = lambda i: F.pmod(F.xxhash64("doc_id", i), size - SECTION).cast("int") + 1
    parts = F.transform(F.sequence(F.lit(0), F.lit(SECTIONS - 1)), lambda i: F.substring(F.col("text"), start(i), F.lit(SECTION)))
    some = F.when(size <= SECTIONS * SECTION, F.col("text")).otherwise(F.array_join(parts, "\n"))
    chosen = hash_sample(rows.select("doc_id", some.alias("text")), sample, "doc_id").select("text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = [t for b in batches for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([save(train(labelled(texts), steps))], pa.binary())], ["weights"])

    row = chosen.coalesce(1).mapInArrow(frugal(task), "weights binary").first()
    return load(row["weights"]) if row else initial()


# ---- decoding --------------------------------------------------------------------


def window_starts(text: str) -> list[int]:
    """Starts of the windows that hold a trigger; a span without one is never given out."""
    if len(text) <= LENGTH:
        return [0] if TRIGGER.search(text) else []
    last = (len(text) - LENGTH + STRIDE - 1) // STRIDE
    out: list[int] = []
    for m in TRIGGER.finditer(text):
        for k in range(max(0, (m.start() - LENGTH) // STRIDE + 1), min(last, m.start() // STRIDE) + 1):
            if not out or k > out[-1]:
                out.append(k)
    return [k * STRIDE for k in out]


def valid(kind: str, text: str) -> bool:
    """The test of a kind, for forms that the patterns don't know: its parts, and how many digits it has."""
    if kind == "email":
        return bool(re.fullmatch(r"\S+( ?(@|[\[(]at[\])]) ?| at )[A-Za-z0-9-]+((\.| ?[\[(]dot[\])] ?| dot )[A-Za-z0-9-]+)+", text))
    if kind == "ip":
        return text.count(".") == 3 and bool(re.fullmatch(r"[0-9.]+", text)) and all(text.split(".")) and is_ip(text)
    if kind == "card":
        return bool(re.fullmatch(r"[0-9]+([ .-]?[0-9]+)*", text)) and is_card(text)
    return bool(re.fullmatch(r"\+?[0-9(][ ().0-9/-]+[0-9]", text)) and is_phone(text)


def decode(w: dict, texts: list[str], batch: int = 1024) -> list[list[tuple[str, int, int]]]:
    """The model's spans of each text, reconciled over its windows."""
    where = [(k, s) for k, t in enumerate(texts) for s in window_starts(t)]
    found: list[list[tuple[float, str, int, int]]] = [[] for _ in texts]
    for b in range(0, len(where), batch):
        part = where[b : b + batch]
        x = np.zeros((len(part), LENGTH), np.int64)
        for r, (k, s) in enumerate(part):
            c = codes(texts[k][s : s + LENGTH])
            x[r, : len(c)] = c
        scores, *_ = emissions(w, x)
        tags = viterbi(scores, w["step"])
        rows = np.flatnonzero((tags > 0).any(1))
        if not len(rows):
            continue
        place, _, _ = posteriors(scores[:, rows], w["step"])
        for q, r in enumerate(rows.tolist()):
            (k, s), tag = part[r], tags[r]
            n, t = min(LENGTH, len(texts[k]) - s), 0
            while t < n:
                if not tag[t]:
                    t += 1
                    continue
                kind, e = (tag[t] - 1) // 2, t + 1
                while e < n and tag[e] == 2 + 2 * kind:
                    e += 1
                sure = float(place[np.arange(t, e), q, tag[t:e]].mean())
                found[k].append((sure, KINDS[kind], s + t, s + e))
                t = e
    return [reconciled(f, t) for f, t in zip(found, texts, strict=True)]


def reconciled(found: list[tuple[float, str, int, int]], text: str) -> list[tuple[str, int, int]]:
    """Join overlapping spans of a kind, then take the surest that is valid and free, again and again."""
    joined: list[list] = []
    for sure, kind, s, e in sorted(found, key=lambda x: (x[1], x[2], x[3])):
        if joined and joined[-1][1] == kind and s < joined[-1][3]:
            joined[-1] = [max(sure, joined[-1][0]), kind, joined[-1][2], max(e, joined[-1][3])]
        else:
            joined.append([sure, kind, s, e])
    out: list[tuple[str, int, int]] = []
    for sure, kind, s, e in sorted(joined, key=lambda x: (-x[0], x[2], x[3])):
        while s < e and text[s].isspace():
            s += 1
        while e > s and (text[e - 1].isspace() or text[e - 1] in ".,;:!?" and kind != "phone"):
            e -= 1
        cut = s > 0 and text[s - 1].isalnum() and text[s].isalnum() or e < len(text) and text[e].isalnum() and text[e - 1 : e].isalnum()
        if sure >= SURE and not cut and valid(kind, text[s:e]) and all(e <= a or s >= b for _, a, b in out):
            out.append((kind, s, e))
    return out


def all_spans(base: list[tuple[str, int, int]], model: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Every base span, and those of the model that touch none."""
    added = [x for x in model if all(x[2] <= a or x[1] >= b for _, a, b in base)]
    return sorted([*base, *added], key=lambda x: (x[1], KINDS.index(x[0])))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def finder(broadcast):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = broadcast.value
        for batch in (part for whole in batches for part in slices(whole, "text", BATCH_BYTES)):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            base = [base_spans(t) for t in texts]
            model = decode(w, texts)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([joined(b) for b in base]), pa.array([joined(all_spans(b, m)) for b, m in zip(base, model, strict=True)])],
                [*batch.schema.names, "base", "spans"],
            )

    return task


def find(docs: DataFrame, weights: dict | None = None) -> DataFrame:
    """doc_id, text, base and spans: kind:start:end in code points, end exclusive, by start.

    Whole texts; a null or empty one has no spans. No shuffle but for the sample that
    trains the model. Repeated rows each get their own result.
    """
    w = weights if weights is not None else fit(docs)
    rows = docs.select("doc_id", "text")
    schema = with_columns(rows, "base string, spans string")
    return rows.mapInArrow(frugal(finder(docs.sparkSession.sparkContext.broadcast(w))), schema)


def digest(found: DataFrame) -> DataFrame:
    """The per-document report; counts are of the base spans."""
    count = lambda k: F.size(F.filter(F.split("base", ","), lambda x: x.startswith(f"{k}:"))).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2("base", 256).alias("base_sha256"), "spans")


def mask(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Spans replaced by their kind; where two overlap, the earlier names it."""
    out, last = [], 0
    for kind, s, e in spans:
        if s >= last:
            out += [text[last:s], f"[{kind}]"]
        last = max(last, e)
    return "".join([*out, text[last:]])


def masked(docs: DataFrame, weights: dict | None = None) -> DataFrame:
    """Documents with personal data replaced by its kind; columns as given.

    A changed text has a new `n_chars`; null stays null.
    """
    names = docs.columns
    found = find(docs.withColumn("doc_id", F.struct(*[F.col(f"`{c}`") for c in names if c != "text"])), weights or fit(docs))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[(k, int(s), int(e)) for k, s, e in (x.split(":") for x in line.split(","))] if line else [] for line in batch.column("spans").to_pylist()]
            texts = [mask(t, s) if s else t for t, s in zip(batch.column("text").to_pylist(), spans, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string()), pa.array([bool(s) for s in spans], pa.bool_())], ["doc_id", "text", "changed"]
            )

    rest = found.select("doc_id", "text", "spans").mapInArrow(frugal(task), with_columns(found.select("doc_id", "text"), "changed boolean"))
    value = lambda c: F.col("text") if c == "text" else F.when(F.col("changed"), F.length("text").cast("long")).otherwise(F.col("doc_id.n_chars")) if c == "n_chars" else F.col(f"doc_id.`{c}`")
    return rest.select(*[value(c).alias(c) for c in names])
