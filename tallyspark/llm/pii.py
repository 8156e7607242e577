"""Personal data: base patterns, and a character BiLSTM with CRF transitions trained in numpy.

Base spans of a text are e-mail addresses, IP addresses, card numbers and phone numbers by fixed
patterns; per kind they are leftmost and do not overlap. They are found by single passes over runs of
characters, so very long words or digit runs cost no more than their length.

The tagger reads windows of `WINDOW` characters around every character that each kind needs (a digit,
an @ or an "at" in brackets), `STEP` apart, so neighbours overlap. It is a bidirectional LSTM over character classes with
one score per kind, and a linear-chain CRF over the kinds. Every window is decoded (Viterbi); where
windows overlap, a character takes the kind from the window in which it stands farthest from an edge.
Runs of one kind become spans if they have the kind's least number of digits (or, once blanks and
brackets around the sign and blanks around points are taken out, an address with an @, whose first and
last words count whole), touch no base span and each other; base spans always stay.

Learning: spans written by the base patterns' rules into windows of real text, in the forms that the
patterns know and in others (separators, prefixes, " @ ", " [@] ", " (at) ", " [at] ", " . "), labelled as
they are put there (an "at" without brackets and a "dot" in words are not among them), and as many
windows without any, with codes, keys and numbers that are not personal data.
The text comes from the `SAMPLE` distinct texts of the smallest hashes, of at most `SAMPLE_CHARS`
characters each, whatever the order of the rows. Everything else covers all texts whole. Null and empty texts have no spans; rows are judged
one by one, so repeats, ties and missing ids change nothing; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds in their order, and the patterns' pieces.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

WINDOW = 64
STEP = 32
HIDDEN = 12
SAMPLE = 200
SAMPLE_CHARS = 8_000
TRAIN_WINDOWS = 1_200
EPOCHS = 12
BATCH = 60
RATE = 0.02
GROUP = 512  # windows decoded at a time

#: Mask put in place of a span, per kind.
MASKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if k % 2 == 0 else (2 * n if n < 5 else 2 * n - 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[Span]:
    free = 0  # where the next match may begin
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            yield "email", start, found.end()
            free = found.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", max(at + 1, free))


def _ips(text: str) -> Iterator[Span]:
    for run in _DOTTED.finditer(text):
        if run.group().count(".") < 3:
            continue
        parts = run.group().split(".")
        at = run.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in four):
                yield "ip", at, end
            at = end + 1


def base_spans(text: str) -> list[Span]:
    """All base spans, by start and then kind."""
    spans: list[Span] = []
    if "@" in text:
        spans += _emails(text)
    if any(d in text for d in "0123456789"):
        spans += _ips(text)
        for m in _CARD.finditer(text):
            digits = _digits(m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_digits(m.group())) <= 15:
                    spans.append(("phone", m.start(), m.end()))
    return sorted(spans, key=_order)


def _order(span: Span) -> tuple[int, int, int]:
    return span[1], KINDS.index(span[0]), span[2]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


# --- the tagger ---------------------------------------------------------------------------------

_OTHER, _LETTER_BEYOND, _PADDING = 0, 1, 2
_CLASS = np.zeros(128, np.int64)
for _k, _chars in enumerate(
    ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", " \t\r\n", "@", ".", "-", "_", "+", "(", ")", "%", ":", "=", "/", "[", "]", ",;!?\"'")
):
    _CLASS[[ord(c) for c in _chars]] = _k + 3
CLASSES = 21
STATES = len(KINDS) + 1  # 0: none


def _classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 128, _CLASS[np.minimum(points, 127)], _LETTER_BEYOND)


class Tagger(NamedTuple):
    forward: tuple[np.ndarray, np.ndarray]  # per direction: input rows (class, 4h), recurrent (h, 4h)
    backward: tuple[np.ndarray, np.ndarray]
    out: np.ndarray  # (2h + 1, states)
    moves: np.ndarray  # score of state j after state i


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _lstm(x: np.ndarray, inputs: np.ndarray, recurrent: np.ndarray):
    """Hidden states (t, n, h) over time-major classes, and what its gradient needs."""
    steps, n = x.shape
    h, c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
    states, kept = np.empty((steps, n, HIDDEN)), []
    for t in range(steps):
        gates = inputs[x[t]] + h @ recurrent
        s = _sigmoid(gates[:, : 3 * HIDDEN])
        i, f, o = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :]
        g = np.tanh(gates[:, 3 * HIDDEN :])
        before, last = c, h
        c = f * c + i * g
        squash = np.tanh(c)
        h = o * squash
        states[t] = h
        kept.append((i, f, o, g, before, squash, last))
    return states, kept


def _lstm_gradient(x: np.ndarray, recurrent: np.ndarray, kept: list, grad: np.ndarray):
    d_in, d_rec = np.zeros((CLASSES, 4 * HIDDEN)), np.zeros_like(recurrent)
    dh, dc = np.zeros_like(grad[0]), np.zeros_like(grad[0])
    for t in range(len(x) - 1, -1, -1):
        i, f, o, g, before, squash, last = kept[t]
        dh = dh + grad[t]
        dc = dc + dh * o * (1 - squash**2)
        d = np.hstack([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * squash * o * (1 - o), dc * i * (1 - g**2)])
        np.add.at(d_in, x[t], d)
        d_rec += last.T @ d
        dh = d @ recurrent.T
        dc = dc * f
    return d_in, d_rec


def _scores(model: Tagger, x: np.ndarray):
    ahead, kept_a = _lstm(x, *model.forward)
    back, kept_b = _lstm(x[::-1], *model.backward)
    both = np.concatenate([ahead, back[::-1], np.ones((*x.shape, 1))], axis=2)
    return both @ model.out, both, kept_a, kept_b


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis, keepdims=True)) + top).squeeze(axis)


def _crf_gradient(scores: np.ndarray, moves: np.ndarray, gold: np.ndarray):
    """Gradients of the mean negative log-likelihood by scores and moves."""
    steps, n, _ = scores.shape
    alpha, beta = np.empty_like(scores), np.zeros_like(scores)
    alpha[0] = scores[0]
    for t in range(1, steps):
        alpha[t] = scores[t] + _log_sum(alpha[t - 1][:, :, None] + moves, 1)
    for t in range(steps - 2, -1, -1):
        beta[t] = _log_sum((beta[t + 1] + scores[t + 1])[:, None, :] + moves, 2)
    total = _log_sum(alpha[-1], 1)
    d_scores = np.exp(alpha + beta - total[:, None])
    pairs = np.exp(alpha[:-1, :, :, None] + moves + (scores + beta)[1:, :, None, :] - total[:, None, None])
    d_moves = pairs.sum((0, 1))
    np.add.at(d_scores, (np.arange(steps)[:, None], np.arange(n)[None], gold), -1)
    np.add.at(d_moves, (gold[:-1], gold[1:]), -1)
    return d_scores / n, d_moves / n


def _viterbi(scores: np.ndarray, moves: np.ndarray) -> np.ndarray:
    steps, n, _ = scores.shape
    best, came = scores[0], []
    for t in range(1, steps):
        ways = best[:, :, None] + moves
        came.append(ways.argmax(1))
        best = ways.max(1) + scores[t]
    path = np.empty((steps, n), np.int64)
    path[-1] = best.argmax(1)
    for t in range(steps - 2, -1, -1):
        path[t] = came[t][np.arange(n), path[t + 1]]
    return path


def train(windows: np.ndarray, labels: np.ndarray, seed: int = 3) -> Tagger:
    """Fits the tagger to (n, WINDOW) classes and labels by Adam."""
    rng = np.random.default_rng(seed)

    def draw(*shape: int) -> np.ndarray:
        return rng.normal(0, 0.2, shape)

    weights = [draw(CLASSES, 4 * HIDDEN), draw(HIDDEN, 4 * HIDDEN), draw(CLASSES, 4 * HIDDEN), draw(HIDDEN, 4 * HIDDEN)]
    weights += [draw(2 * HIDDEN + 1, STATES), draw(STATES, STATES)]
    for k in (0, 2):
        weights[k][:, HIDDEN : 2 * HIDDEN] += 1  # remember at first
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(windows))
        for at in np.split(order, range(BATCH, len(order), BATCH)):
            model = Tagger((weights[0], weights[1]), (weights[2], weights[3]), weights[4], weights[5])
            x, gold = windows[at].T, labels[at].T
            scores, both, kept_a, kept_b = _scores(model, x)
            d_scores, d_moves = _crf_gradient(scores, model.moves, gold)
            d_both = d_scores @ model.out.T
            grads = [
                *_lstm_gradient(x, weights[1], kept_a, d_both[:, :, :HIDDEN]),
                *_lstm_gradient(x[::-1], weights[3], kept_b, d_both[::-1, :, HIDDEN : 2 * HIDDEN]),
                np.einsum("tnh,tns->hs", both, d_scores),
                d_moves,
            ]
            step += 1
            rate = RATE * (1 - epoch / EPOCHS)
            for w, g, m, v in zip(weights, grads, first, second, strict=True):
                g = np.clip(g, -5, 5)
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Tagger((weights[0], weights[1]), (weights[2], weights[3]), weights[4], weights[5])


# --- labelled windows ---------------------------------------------------------------------------


def _random_from(rng: np.random.Generator, chars: str, low: int, high: int) -> str:
    return "".join(rng.choice(list(chars), rng.integers(low, high + 1)))


def _invented(rng: np.random.Generator, kind: str) -> str:
    letters, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    word = lambda a, b: _random_from(rng, letters, a, b)
    number = lambda n: _random_from(rng, digits, n, n)
    if kind == "email":
        name = word(2, 8) + rng.choice(["", ".", "_", "-", "+"]) + rng.choice([word(1, 6), number(2)])
        at = rng.choice(["@", "@", "@", " @ ", " [@] ", " (at) ", " [at] "])
        host = [word(2, 7) + rng.choice(["", number(1), "-" + word(2, 4)]) for _ in range(rng.integers(1, 4))]
        return name + at + rng.choice([".", ".", " . "]).join([*host, word(2, 4)])
    if kind == "ip":
        return rng.choice([".", ".", ".", " . "]).join(str(rng.integers(1, 256)) for _ in range(4))
    if kind == "card":
        body = str(rng.integers(3, 7)) + number(14)
        check = next(d for d in digits if luhn(body + d))
        return rng.choice(["", " ", "-", "."]).join((body + check)[k : k + 4] for k in range(0, 16, 4))
    area, middle, last = number(3), number(3), number(4)
    form = rng.choice(["+1 ({}) {}-{}", "+1-{}-{}-{}", "+1 {} {} {}", "({}) {}-{}", "+49 {} {}{}", "001 {} {} {}"])
    return form.format(area, middle, last)


def _harmless(rng: np.random.Generator) -> str:
    digits, capital = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return str(
        rng.choice(
            [
                "AKIA" + _random_from(rng, capital + digits, 16, 16),
                'token = "' + _random_from(rng, "abcdef" + digits, 32, 32) + '"',
                "password=" + _random_from(rng, "abcdef" + digits, 12, 20),
                _random_from(rng, digits, 1, 4),
                "4.0",
                "v" + ".".join(_random_from(rng, digits, 1, 2) for _ in range(3)),
                "20" + _random_from(rng, digits, 2, 2) + "-0" + _random_from(rng, "123456789", 1, 1) + "-1" + _random_from(rng, digits, 1, 1),
                _random_from(rng, digits, 1, 3) + "," + _random_from(rng, digits, 3, 3),
                "@" + _random_from(rng, "abcdefgh", 3, 8),
            ]
        )
    )


def labelled_windows(texts: list[str], seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Classes and labels of `TRAIN_WINDOWS` windows, half of them with personal data."""
    rng = np.random.default_rng(seed)
    pool = [t for t in texts if len(t) > WINDOW] or ["the quick brown fox jumps over the lazy dog and runs on, far away. " * 3]
    windows, labels = [], []
    for k in range(TRAIN_WINDOWS):
        text = pool[rng.integers(len(pool))]
        at = int(rng.integers(0, len(text) - WINDOW + 1))
        kind = KINDS[k // 2 % len(KINDS)]
        thing = _invented(rng, kind) if k % 2 else _harmless(rng)
        put = int(rng.integers(-8, WINDOW - 8))
        line = text[at : at + WINDOW]
        marks = np.zeros(WINDOW + 2 * len(thing) + 2, np.int64)
        left = max(put, 0)
        shown = thing[left - put :]
        whole = line[:left] + (" " if put >= 0 else "") + shown + " " + line[left:]
        begin = left + (put >= 0)
        if k % 2:
            marks[begin : begin + len(shown)] = KINDS.index(kind) + 1
        windows.append(_classes(whole[:WINDOW]))
        labels.append(marks[:WINDOW])
    return np.array(windows), np.array(labels)


def fit(docs: DataFrame) -> Tagger:
    """Trains on windows of at most `SAMPLE` distinct texts, those of the smallest hashes: the same in every run."""
    short = docs.where(F.length("text").between(WINDOW + 1, SAMPLE_CHARS)).select("text", F.xxhash64("text").alias("draw"))
    # Copies count as rows here and fall together below, so four times the sample is let through.
    edge = -(2**63) + 2**64 * 4 * SAMPLE // max(short.count(), 4 * SAMPLE)
    drawn = short.where(F.col("draw") <= F.lit(min(edge, 2**63 - 1))).distinct()
    texts = [r["text"] for r in drawn.orderBy("draw", "text").limit(SAMPLE).collect()]
    return train(*labelled_windows([re.sub(r"[0-9@]+", "", text) for text in texts]))


# --- tagging ------------------------------------------------------------------------------------

_AT_SIGN = r"[\[(] ?(?:@|at) ?[\])]"
_NEEDED = re.compile(rf"[0-9@]|{_AT_SIGN}", re.IGNORECASE)
_SPACED_AT = re.compile(rf"\s*{_AT_SIGN}\s*|\s+@\s*|@\s+", re.IGNORECASE)
_SPACED_POINT = re.compile(r"\s+\.\s+")


def _window_starts(text: str) -> list[int]:
    """Starts of the windows, multiples of STEP, that show each digit or @ with half a window around."""
    wanted: list[int] = []
    at = 0
    while found := _NEEDED.search(text, at):
        cell = found.start() // STEP
        for k in (cell - 1, cell):
            if k >= 0 and (not wanted or wanted[-1] < k):
                wanted.append(k)
        at = (cell + 1) * STEP
    return [k * STEP for k in wanted]


def tag(texts: list[str], model: Tagger) -> list[list[Span]]:
    """Spans of the tagger for each text, from reconciled windows."""
    places = [(row, start) for row, text in enumerate(texts) for start in _window_starts(text)]
    out: list[list[Span]] = [[] for _ in texts]
    seen: dict[int, dict[int, tuple[int, int]]] = {}
    for first in range(0, len(places), GROUP):
        group = places[first : first + GROUP]
        x = np.full((len(group), WINDOW), _PADDING)
        for k, (row, start) in enumerate(group):
            found = _classes(texts[row][start : start + WINDOW])
            x[k, : len(found)] = found
        path = _viterbi(_scores(model, x.T)[0], model.moves).T
        for k in np.flatnonzero(path.any(1)):
            seen.setdefault(group[k][0], {})[group[k][1]] = path[k]
        # Windows without a find still outvote others at the characters that are nearer to their middle.
        for k in np.flatnonzero(~path.any(1)):
            seen.setdefault(group[k][0], {})[group[k][1]] = path[k]
    margin = np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1])
    for row, windows in seen.items():
        text = texts[row]
        if not any(p.any() for p in windows.values()):
            continue
        for run in _regions(sorted(windows)):
            base, end = run[0], min(run[-1] + WINDOW, len(text))
            kind, trust = np.zeros(end - base, np.int64), np.full(end - base, -1)
            for start in run:
                size = min(WINDOW, end - start)
                part = slice(start - base, start - base + size)
                better = margin[:size] > trust[part]
                kind[part] = np.where(better, windows[start][:size], kind[part])
                trust[part] = np.where(better, margin[:size], trust[part])
            edges = np.flatnonzero(np.diff(kind, prepend=0, append=0))
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if kind[a]:
                    span = _plausible(text, KINDS[kind[a] - 1], base + int(a), base + int(b))
                    if span:
                        out[row].append(span)
    return out


def _regions(starts: list[int]) -> Iterator[list[int]]:
    """Runs of windows that overlap."""
    run: list[int] = []
    for start in starts:
        if run and start >= run[-1] + WINDOW:
            yield run
            run = []
        run.append(start)
    if run:
        yield run


def _plausible(text: str, kind: str, start: int, end: int) -> Span | None:
    """The span without blanks and points around it, its numbers whole, if it has what its kind needs."""
    while start < end and text[start] in " \t\r\n.,;:":
        start += 1
    while end > start and text[end - 1] in " \t\r\n.,;:":
        end -= 1
    if kind == "email":
        return _address(text, start, end)
    if start < end:  # a number is never cut within its digits
        while start > 0 and "0" <= text[start] <= "9" and "0" <= text[start - 1] <= "9":
            start -= 1
        while end < len(text) and "0" <= text[end - 1] <= "9" and "0" <= text[end] <= "9":
            end += 1
        if kind == "ip":
            while start < end and not "0" <= text[start] <= "9":
                start += 1
            while end > start and not "0" <= text[end - 1] <= "9":
                end -= 1
    body = text[start:end]
    digits = len(_digits(body))
    if kind == "ip":
        parts = [p.strip() for p in body.split(".")]
        fine = len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    elif kind == "card":
        fine = 14 <= digits <= 19 and luhn(_digits(body)) and all(c in "0123456789 -./" for c in body)
    else:
        fine = 10 <= digits <= 15 and all(c in "0123456789 -./()+" for c in body) and any(c in " -./()+" for c in body)
    return (kind, start, end) if fine else None


def _address(text: str, start: int, end: int) -> Span | None:
    """The address of a stretch: its word with a sign inside, which parts of words at the ends count whole for.

    Around a sign with blanks any word could belong to the name, so only words that are partly in the
    stretch are left out there."""
    first, last = start, end
    while first > 0 and start < end and (text[first - 1] in _LOCAL_CHARS or text[first - 1] == "@"):
        first -= 1
    while last < len(text) and start < end and (text[last] in _LOCAL_CHARS or text[last] == "@"):
        last += 1
    firsts, lasts = [first], [last]
    words = [(first + w.start(), first + w.end()) for w in re.finditer(r"\S+", text[first:last])]
    if len(words) > 1:
        whole = next((w for w in words if "@" in text[w[0] + 1 : w[1] - 1]), None)
        if whole:
            firsts.append(whole[0])
            lasts.append(whole[1])
        else:
            firsts += [words[1][0]] * (first < start)
            lasts += [words[-2][1]] * (last > end)
    for a in firsts:
        for b in lasts:
            while a < b and text[a] in ".,;:":
                a += 1
            while b > a and text[b - 1] in ".,;:":
                b -= 1
            left, at, right = _SPACED_POINT.sub(".", _SPACED_AT.sub("@", text[a:b])).partition("@")
            if at and left.strip(" [(") and "." in right.strip(" .") and not any(c.isspace() for c in left + right):
                return "email", a, b
    return None


def all_spans(texts: list[str], model: Tagger) -> tuple[list[list[Span]], list[list[Span]]]:
    """Base spans, and base spans with those that the tagger adds, for each text."""
    base = [base_spans(t) for t in texts]
    both = []
    for known, more in zip(base, tag(texts, model), strict=True):
        taken = list(known)
        for span in more:
            if all(span[2] <= a or b <= span[1] for _, a, b in taken):
                taken.append(span)
        both.append(sorted(taken, key=_order))
    return base, both


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind's mask; of overlapping spans the first counts."""
    parts, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            parts += [text[at:start], MASKS[kind]]
        at = max(at, end)
    return "".join(parts) + text[at:]


def _slices(values: pa.Array) -> Iterator[tuple[int, int, list[str]]]:
    """Rows in groups of about a megabyte of text."""
    first, group, size = 0, [], 0
    for k, value in enumerate(values):
        group.append(value.as_py() or "")
        size += len(group[-1])
        if size >= 1 << 20 or k == len(values) - 1:
            yield first, k + 1, group
            first, group, size = k + 1, [], 0


def find(docs: DataFrame, model: Tagger | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans; counts and digest are of base spans."""
    model = model or fit(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, texts in _slices(batch.column("text")):
                base, both = all_spans(texts, model)
                counts = [pa.array([sum(s[0] == kind for s in row) for row in base], pa.int64()) for kind in KINDS]
                digests = [hashlib.sha256(joined(row).encode()).hexdigest() for row in base]
                ids = batch.column("doc_id")[first:last].cast(pa.int64())
                columns = [ids, *counts, pa.array(digests, pa.string()), pa.array(map(joined, both), pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    schema = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def mask(docs: DataFrame, model: Tagger | None = None) -> DataFrame:
    """The same rows and columns with all spans in `text` masked; null texts stay null."""
    model = model or fit(docs)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for first, last, texts in _slices(batch.column("text")):
                part = batch.slice(first, last - first)
                _, both = all_spans(texts, model)
                shown = [masked(t, spans) for t, spans in zip(texts, both, strict=True)]
                nulls = part.column(at).is_null().to_pylist()
                columns = part.columns
                columns[at] = pa.array([None if no else t for no, t in zip(nulls, shown, strict=True)], pa.string()).cast(
                    batch.schema.field(at).type
                )
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, docs.schema)
