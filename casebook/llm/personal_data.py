"""Operator 13: personal data, by rules and a character network with CRF.

Base rules find e-mail addresses, IP addresses, card and phone numbers. A
bidirectional LSTM over characters with CRF transitions, written and trained
in numpy, adds spans that the rules miss (numbers that stand side by side, and
other ways of writing them).

*Training.* Windows around digits and '@' of a bounded sample of documents
(``train_rows`` ids of smallest hash, ``train_windows`` windows of these) are
labelled with their base spans. Windows that hold a match that failed its
check teach nothing, as their truth is unknown. Labelled spans are also
inserted beside others and rewritten (other separators, no country code), and
look-alikes (dates, versions, amounts, hashes) are inserted unlabelled.

*Decoding.* Texts are cut into windows of ``WIDTH`` characters, each half over
the next. A span must hold a digit or '@', so windows without any are passed
over, which changes no result. Each window is decoded by Viterbi over B-, I-
and O-tags; a character's weight is its marginal probability.

*Reconciliation.* Spans that a window's border cuts are joined with the cut
spans of the next windows. All spans of a text then compete: the set of
disjoint spans with the largest total weight is kept (weighted interval
scheduling over the whole text). A kept span is added if it passes the check
of its kind (Luhn, octets, digit counts, form) and touches no base span.

Characters are read as classes: digits, small, capital and other letters,
white space, each ASCII mark, other.

Defined cases: a null text is empty and has no spans; repeated rows give
repeated results; a null id counts like any other; without any sampled rows
the network learns from generated spans; an empty table gives an empty
result; other columns are not read; texts are read whole.
"""

from __future__ import annotations

import random
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm._common import table

KINDS = ("email", "ip", "card", "phone")
WIDTH, STRIDE = 80, 40
HIDDEN = 20
TAGS = 1 + 2 * len(KINDS)  # O, then B and I of each kind
_BATCH = 1024  # windows decoded at once

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
# A digit run that fails from its begin fails from each of its digits, so only
# begins are tried: long runs stay linear.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TELLING = re.compile("[0-9@]")


# ---- base rules --------------------------------------------------------------

def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", at + 1)


def _digits(s: str) -> list[int]:
    return [ord(c) - 48 for c in s if "0" <= c <= "9"]


def _luhn(digits: list[int]) -> bool:
    doubled = [d * 2 - 9 * (d > 4) for d in digits[-2::-2]]
    return (sum(digits[-1::-2]) + sum(doubled)) % 10 == 0


def _octets(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in s.split("."))


def base_matches(text: str) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, whether it passes its check), by kind and start."""
    out = [(0, a, b, True) for a, b in _emails(text)]
    out += [(1, m.start(), m.end(), _octets(m[0])) for m in _IP.finditer(text)]
    for m in _CARD.finditer(text):
        n = sum("0" <= c <= "9" for c in m[0])
        out.append((2, m.start(), m.end(), 16 <= n <= 19 and _luhn(_digits(m[0]))))
    out += [(3, m.start(), m.end(), 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15) for m in _PHONE.finditer(text)]
    return out


def is_plausible(kind: int, s: str) -> bool:
    """The check of an added span."""
    n = len(_digits(s))
    if kind == 0:
        local, _, domain = s.partition("@")
        return bool(local) and _DOMAIN.fullmatch(domain) is not None
    if kind == 1:
        return re.fullmatch(r"[0-9]+(\.[0-9]+){3}", s) is not None and _octets(s)
    if kind == 2:
        return 13 <= n <= 19 and _luhn(_digits(s)) and re.fullmatch(r"[0-9][0-9 .-]*[0-9]", s) is not None
    return 7 <= n <= 15 and re.fullmatch(r"\+?\(?[0-9][0-9 ().-]*[0-9]", s) is not None and re.search(r"[+() .-]", s) is not None


# ---- network -----------------------------------------------------------------

_MARKS = {c: i for i, c in enumerate(string.punctuation)}
SYMBOLS = len(_MARKS) + 7
_PAD, _DIGIT, _SMALL, _CAPITAL, _LETTER, _SPACE, _OTHER = range(len(_MARKS), SYMBOLS)


def _symbol(c: str) -> int:
    if c in _MARKS:
        return _MARKS[c]
    if "0" <= c <= "9":
        return _DIGIT
    if "a" <= c <= "z":
        return _SMALL
    if "A" <= c <= "Z":
        return _CAPITAL
    return _LETTER if c.isalpha() else _SPACE if c.isspace() else _OTHER


def encode(windows: list[str]) -> np.ndarray:
    known: dict[str, int] = {}
    out = np.full((len(windows), WIDTH), _PAD, np.int64)
    for row, w in zip(out, windows):
        row[:len(w)] = [known[c] if c in known else known.setdefault(c, _symbol(c)) for c in w]
    return out


def _allowed() -> np.ndarray:
    """I of a kind follows B or I of that kind only."""
    ok = np.ones((TAGS, TAGS), bool)
    for k in range(len(KINDS)):
        ok[:, 2 + 2 * k] = False
        ok[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = True
    return ok


ALLOWED = _allowed()


@dataclass
class Network:
    """Weights. Axis 0 of ``inp`` and ``rec`` is the direction; an embedding
    is folded into the input weights of the gates (in, forget, out, cell)."""

    inp: np.ndarray    # 2 x SYMBOLS x 4 HIDDEN
    rec: np.ndarray    # 2 x HIDDEN x 4 HIDDEN
    out: np.ndarray    # 2 HIDDEN x TAGS
    bias: np.ndarray   # TAGS
    trans: np.ndarray  # TAGS x TAGS
    start: np.ndarray  # TAGS

    @staticmethod
    def fresh(seed: int = 0, hidden: int = HIDDEN) -> "Network":
        rnd = np.random.default_rng(seed)
        inp = rnd.normal(0, 0.3, (2, SYMBOLS, 4 * hidden))
        inp[:, :, hidden:2 * hidden] += 1.0  # remember at first
        return Network(inp, rnd.normal(0, hidden ** -0.5, (2, hidden, 4 * hidden)), rnd.normal(0, hidden ** -0.5, (2 * hidden, TAGS)),
                       np.zeros(TAGS), np.zeros((TAGS, TAGS)), np.zeros(TAGS))

    def parts(self) -> list[np.ndarray]:
        return [self.inp, self.rec, self.out, self.bias, self.trans, self.start]

    def as_float32(self) -> "Network":
        return Network(*[p.astype(np.float32) for p in self.parts()])

    def transitions(self) -> np.ndarray:
        return np.where(ALLOWED, self.trans, -1e4).astype(self.trans.dtype)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def emissions(net: Network, codes: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Tag scores, windows x places x tags. ``keep`` collects what the
    gradient needs."""
    n, width = codes.shape
    hidden = net.rec.shape[1]
    both = np.stack([codes, codes[:, ::-1]])
    h = c = np.zeros((2, n, hidden), net.rec.dtype)
    states = np.empty((width, 2, n, hidden), net.rec.dtype)
    for t in range(width):
        z = np.matmul(h, net.rec)
        z[0] += net.inp[0][both[0, :, t]]
        z[1] += net.inp[1][both[1, :, t]]
        gates, cell = _sigmoid(z[..., :3 * hidden]), np.tanh(z[..., 3 * hidden:])
        i, f, o = np.split(gates, 3, axis=-1)
        before, c = c, f * c + i * cell
        squashed = np.tanh(c)
        if keep is not None:
            keep.append((h, before, i, f, o, cell, squashed))
        h = o * squashed
        states[t] = h
    joined = np.concatenate([states[:, 0], states[::-1, 1]], axis=-1).transpose(1, 0, 2)
    scores = joined @ net.out + net.bias
    return scores if keep is None else (scores, joined, both)


def chain_sums(net: Network, scores: np.ndarray) -> tuple[np.ndarray, ...]:
    """Forward and backward sums over all tag paths, scaled at each place so
    that their product is a tag's marginal probability; besides the place's
    factors (exp of its scores over its scale), the transition factors and the
    log of the sum over all paths."""
    top = scores.max(axis=2, keepdims=True)
    factor, step = np.exp(scores - top), np.exp(net.transitions())
    fwd, bwd = np.empty_like(scores), np.ones_like(scores)
    total = top[:, :, 0].sum(1)
    for t in range(scores.shape[1]):
        now = factor[:, t] * (np.exp(net.start) if t == 0 else fwd[:, t - 1] @ step)
        scale = now.sum(1, keepdims=True) + np.finfo(now.dtype).tiny
        fwd[:, t] = now / scale
        factor[:, t] /= scale
        total = total + np.log(scale[:, 0])
    for t in range(scores.shape[1] - 2, -1, -1):
        bwd[:, t] = (factor[:, t + 1] * bwd[:, t + 1]) @ step.T
    return fwd, bwd, factor, step, total


def loss_and_gradient(net: Network, codes: np.ndarray, tags: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean negative log likelihood of the tag paths, and its gradient."""
    keep: list = []
    scores, joined, both = emissions(net, codes, keep)
    n, width = codes.shape
    hidden = net.rec.shape[1]
    fwd, bwd, factor, step, total = chain_sums(net, scores)
    trans = net.transitions()
    rows = np.arange(n)[:, None]
    path = scores[rows, np.arange(width)[None], tags].sum(1) + net.start[tags[:, 0]] + trans[tags[:, :-1], tags[:, 1:]].sum(1)
    d_scores = fwd * bwd
    d_start = d_scores[:, 0].sum(0)
    d_trans = step * (fwd[:, :-1].reshape(-1, TAGS).T @ (factor * bwd)[:, 1:].reshape(-1, TAGS))
    np.subtract.at(d_trans, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), 1)
    np.subtract.at(d_start, tags[:, 0], 1)
    d_scores[rows, np.arange(width)[None], tags] -= 1
    d_out = joined.reshape(-1, 2 * hidden).T @ d_scores.reshape(-1, TAGS)
    d_joined = (d_scores @ net.out.T).transpose(1, 0, 2)
    d_states = np.stack([d_joined[..., :hidden], d_joined[::-1, :, hidden:]], axis=1)
    d_rec, d_gates = np.zeros_like(net.rec), np.empty((2, width, n, 4 * hidden), net.rec.dtype)
    d_h = d_c = np.zeros((2, n, hidden), net.rec.dtype)
    for t in range(width - 1, -1, -1):
        h, before, i, f, o, cell, squashed = keep[t]
        d_h = d_h + d_states[t]
        d_c = d_c + d_h * o * (1 - squashed ** 2)
        d_z = np.concatenate([d_c * cell * i * (1 - i), d_c * before * f * (1 - f), d_h * squashed * o * (1 - o), d_c * i * (1 - cell ** 2)], axis=-1)
        d_gates[:, t] = d_z
        d_rec += np.matmul(h.transpose(0, 2, 1), d_z)
        d_h, d_c = np.matmul(d_z, net.rec.transpose(0, 2, 1)), d_c * f
    seen = (both.transpose(0, 2, 1).reshape(2, 1, -1) == np.arange(SYMBOLS)[None, :, None]).astype(net.rec.dtype)
    d_inp = np.matmul(seen, d_gates.reshape(2, -1, 4 * hidden))
    grads = [d_inp, d_rec, d_out, d_scores.sum((0, 1)), np.where(ALLOWED, d_trans, 0), d_start]
    return float((total - path).mean()), [g / n for g in grads]


def train(net: Network, codes: np.ndarray, tags: np.ndarray, epochs: int = 8, batch: int = 64, rate: float = 0.02, seed: int = 0) -> Network:
    """Adam over shuffled batches, with a falling rate and clipped gradients,
    in 32-bit floats."""
    net = net.as_float32()
    rnd = np.random.default_rng(seed)
    parts = net.parts()
    mean, square = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    step, steps = 0, epochs * -(-len(codes) // batch)
    for _ in range(epochs):
        order = rnd.permutation(len(codes))
        for at in range(0, len(order), batch):
            rows = order[at:at + batch]
            _, grads = loss_and_gradient(net, codes[rows], tags[rows])
            norm = float(np.sqrt(sum((g ** 2).sum() for g in grads)))
            step += 1
            for p, g, m, s in zip(parts, grads, mean, square):
                g = g * min(1.0, 5.0 / (norm + 1e-9))
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                p -= rate * (1 - 0.95 * step / steps) * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-8)
    return net


def decode(net: Network, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The best tag path of each window and each tag's marginal probability."""
    scores = emissions(net, codes)
    trans = net.transitions()
    n, width = codes.shape
    best, back = scores[:, 0] + net.start, np.empty((n, width, TAGS), np.int8)
    for t in range(1, width):
        options = best[:, :, None] + trans
        back[:, t] = options.argmax(1)
        best = options.max(1) + scores[:, t]
    tags = np.empty((n, width), np.int8)
    tags[:, -1] = best.argmax(1)
    rows = np.arange(n)
    for t in range(width - 1, 0, -1):
        tags[:, t - 1] = back[rows, t, tags[:, t]]
    fwd, bwd, *_ = chain_sums(net, scores)
    return tags, np.take_along_axis(fwd * bwd, tags[:, :, None].astype(np.int64), 2)[:, :, 0]


# ---- training data -----------------------------------------------------------

def window_starts(text: str) -> list[int]:
    """Begins of the windows that hold a digit or '@', in order."""
    starts: list[int] = []
    for m in _TELLING.finditer(text):
        last = m.start() // STRIDE
        for k in range(max(last - (WIDTH - 1) // STRIDE, 0), last + 1):
            if m.start() < k * STRIDE + WIDTH and (not starts or k * STRIDE > starts[-1]):
                starts.append(k * STRIDE)
    return starts


def _training_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts, spans = [], [], []
        for doc_id, text in zip(batch.column("h").to_pylist(), batch.column("text").to_pylist()):
            text = text or ""
            if not _TELLING.search(text):
                continue
            found = base_matches(text)
            at = 0
            found.sort(key=lambda f: f[1])
            longest = max((f[2] - f[1] for f in found), default=0)
            for start in window_starts(text):
                while at < len(found) and found[at][1] < start - longest:
                    at += 1
                inside = []
                for f in found[at:]:
                    if f[1] >= start + WIDTH:
                        break
                    if f[2] > start:
                        inside.append(f)
                # a failed match of some length is of unknown truth
                if any(not ok and b - a >= 7 for _, a, b, ok in inside):
                    continue
                good = sorted((a, b, k) for k, a, b, ok in inside if ok)
                if any(x[1] > y[0] for x, y in zip(good, good[1:])):
                    continue
                ids.append(doc_id)
                texts.append(text[start:start + WIDTH])
                spans.append(",".join(f"{k}:{max(a - start, 0)}:{min(b - start, WIDTH)}:{int(a >= start)}" for a, b, k in good))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string()), pa.array(spans, pa.string())], ["h", "text", "spans"])


def labelled_windows(docs: DataFrame, text_col: str, id_col: str, train_rows: int, train_windows: int) -> list[tuple[str, list]]:
    """(text, [(kind, start, end, whether it begins here)]) of at most
    ``train_windows`` windows of the ``train_rows`` smallest hashes of ids."""
    rows = docs.select(F.xxhash64(id_col).alias("h"), F.col(text_col).alias("text"))
    edge = rows.select("h").distinct().orderBy("h").limit(train_rows).agg(F.max("h")).first()[0]
    if edge is None:
        return []
    windows = rows.where(F.col("h") <= edge).mapInArrow(_training_windows, "h long, text string, spans string")
    got = windows.distinct().orderBy(F.xxhash64("text", "spans"), "text", "spans").limit(train_windows).collect()
    return [(r.text, [tuple(map(int, s.split(":"))) for s in r.spans.split(",") if s]) for r in got]


def _written_otherwise(rnd: random.Random, kind: int, span: str) -> str:
    if kind == 2:
        digits = re.sub("[^0-9]", "", span)
        return rnd.choice([" ", "-", "."]).join(digits[i:i + 4] for i in range(0, len(digits), 4))
    if kind == 3:
        digits = re.sub("[^0-9]", "", span)
        local, sep = digits[-10:] if len(digits) >= 10 else digits, rnd.choice("-. ")
        a, b, c = local[:-7], local[-7:-4], local[-4:]
        plain = sep.join(x for x in (a, b, c) if x)
        return rnd.choice([plain, f"({a}) {b}-{c}" if a else plain, f"+{digits[:-10] or '1'}{sep}{plain}", f"+{digits}"])
    return span


def _made(rnd: random.Random, kind: int) -> str:
    def word() -> str:
        return "".join(rnd.choice(string.ascii_lowercase) for _ in range(rnd.randint(2, 9)))

    def number(n: int) -> str:
        return "".join(rnd.choice(string.digits) for _ in range(n))
    if kind == 0:
        return f"{word()}{rnd.choice(['', '.' + word(), number(2), '_' + word()])}@{word()}{rnd.choice(['', number(1), '.' + word()])}.{rnd.choice(['com', 'org', 'net', 'de', 'io'])}"
    if kind == 1:
        return ".".join(str(rnd.randint(0, 255)) for _ in range(4))
    if kind == 2:
        return number(16)
    return f"+{rnd.randint(1, 99)} ({number(3)}) {number(3)}-{number(4)}"


def _look_alike(rnd: random.Random) -> str:
    a, b, c = rnd.randint(1900, 2099), rnd.randint(1, 12), rnd.randint(1, 28)
    hexes = "".join(rnd.choice("0123456789abcdef") for _ in range(rnd.randint(8, 40)))
    return rnd.choice([f"{a}-{b:02d}-{c:02d}", f"{c:02d}.{b:02d}.{a}", f"{b:02d}/{c:02d}/{a}", f"{rnd.randint(0, 23)}:{rnd.randint(10, 59)}", f"{b}.{c}",
                       f"{rnd.randint(0, 999999):,}", f"v{b}.{c}.{rnd.randint(0, 9)}", f"{a}-{a + b}", str(rnd.randint(0, 10 ** rnd.randint(1, 9))), hexes,
                       f'"{hexes}"', f"{a}-{b:02d}-{c:02d} {c:02d}:{b:02d}:{c:02d}", f"${rnd.randint(1, 9999)}.{rnd.randint(10, 99)}", f"@{rnd.choice(['home', 'work', 'all'])}"])


def training_set(windows: list[tuple[str, list]], made: int = 2000, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Codes and tags of the windows, and of windows with spans inserted,
    rewritten, put side by side, and with look-alikes."""
    rnd = random.Random(seed)
    spans: list[list[str]] = [[], [], [], []]
    for text, labels in windows:
        for k, a, b, begins in labels:
            if begins and b < WIDTH:
                spans[k].append(text[a:b])
    around = [t for t, labels in windows if not labels] or ["a few words of text, then more. Other words follow here (and there)"]
    texts, tags = [], []

    def add(text: str, labels: list) -> None:
        row = np.zeros(WIDTH, np.int64)
        for k, a, b, begins in labels:
            row[a:min(b, WIDTH)] = 2 + 2 * k
            if begins and a < WIDTH:
                row[a] = 1 + 2 * k
        texts.append(text[:WIDTH])
        tags.append(row)

    for text, labels in windows:
        add(text, labels)
    for _ in range(made):
        back = re.sub(r"\S*[0-9@]\S*", "", rnd.choice(around))
        cut = rnd.randint(0, len(back))
        text, labels = back[:cut], []
        text = text if not text or text[-1].isspace() else text + rnd.choice([" ", " ", ": ", " (", '"'])
        k = -1
        for _ in range(rnd.choice([1, 2, 2, 3])):
            if rnd.random() < 0.35:
                text += _look_alike(rnd)
            else:
                k = k if k >= 0 and rnd.random() < 0.3 else rnd.randrange(4)  # often of one kind
                span = rnd.choice(spans[k]) if spans[k] and rnd.random() < 0.6 else _made(rnd, k)
                span = _written_otherwise(rnd, k, span) if rnd.random() < 0.5 else span
                labels.append((k, len(text), len(text) + len(span), 1))
                text += span
            text += rnd.choice([" ", " ", " ", ", ", "\n", " and ", "; "])
        shift = rnd.randint(0, max(0, min(len(text) - WIDTH // 2, WIDTH // 2)))
        labels = [(k, max(a - shift, 0), b - shift, int(a >= shift)) for k, a, b, _ in labels if b > shift]
        add((text + back[cut:])[shift:], [x for x in labels if x[1] < WIDTH])
    return encode(texts), np.array(tags)


def fit(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", train_rows: int = 6000, train_windows: int = 2000) -> Network:
    """A network trained on at most ``train_windows`` windows of ``docs`` and
    2000 made ones."""
    codes, tags = training_set(labelled_windows(docs, text_col, id_col, train_rows, train_windows))
    return train(Network.fresh(), codes, tags)


# ---- scan --------------------------------------------------------------------

def window_spans(tags: np.ndarray, weight: np.ndarray, start: int, size: int) -> list[tuple[int, int, int, float, bool]]:
    """(kind, start, end, weight, cut) in places of the text, of one window
    of ``size`` characters from ``start``; cut: it may go on beyond."""
    out, t = [], 0
    width = min(WIDTH, size - start)
    while t < width:
        tag = int(tags[t])
        if tag == 0:
            t += 1
            continue
        kind, e = (tag - 1) // 2, t + 1
        while e < width and tags[e] == 2 + 2 * kind:
            e += 1
        cut = (tag == 2 + 2 * kind and start > 0) or (e == WIDTH and start + e < size)
        out.append((kind, start + t, start + e, float(weight[t:e].sum()), cut))
        t = e
    return out


def reconcile(spans: list[tuple[int, int, int, float, bool]]) -> list[tuple[int, int, int]]:
    """The disjoint spans of largest total weight, cut ones joined before."""
    options: dict[tuple[int, int, int], float] = {}
    joined: dict[int, list] = {}
    for kind, a, b, w, cut in sorted(spans, key=lambda s: s[1:3]):
        if not cut:
            options[kind, a, b] = max(w, options.get((kind, a, b), 0))
            continue
        open_ = joined.setdefault(kind, [])
        if open_ and open_[-1][1] > a:
            last = open_[-1]
            share = (max(b, last[1]) - last[1]) / (b - a)  # weight of what is new
            last[1], last[2] = max(b, last[1]), last[2] + w * share
        else:
            open_.append([a, b, w])
    for kind, rows in joined.items():
        for a, b, w in rows:
            options[kind, a, b] = max(w, options.get((kind, a, b), 0))
    ranked = sorted(options, key=lambda s: (s[2], s[1], s[0]))
    ends = [s[2] for s in ranked]
    best, take = [0.0], []
    for i, s in enumerate(ranked):
        low, high = 0, i
        while low < high:
            mid = (low + high) // 2
            low, high = (mid + 1, high) if ends[mid] <= s[1] else (low, mid)
        gain = best[low] + options[s]
        take.append((gain > best[-1], low))
        best.append(max(gain, best[-1]))
    out, i = [], len(ranked)
    while i:
        taken, before = take[i - 1]
        if taken:
            out.append(ranked[i - 1])
        i = before if taken else i - 1
    return out[::-1]


def _overlap(found: list[tuple[int, int, int]], added: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Those of the disjoint ``added`` that no span of ``found`` touches."""
    events = sorted([(a, b) for _, a, b in found])
    out, at, reach = [], 0, -1
    for k, a, b in sorted(added, key=lambda s: s[1]):
        while at < len(events) and events[at][0] < b:
            reach = max(reach, events[at][1])
            at += 1
        if reach <= a:
            out.append((k, a, b))
    return out


def _scanner(net: Network):
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("added", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            spans: dict[int, list] = {}
            todo: list[tuple[int, int]] = []

            def advance() -> None:
                tags, weight = decode(net, encode([texts[d][s:s + WIDTH] for d, s in todo]))
                for i in np.flatnonzero((tags > 0).any(axis=1)):
                    d, s = todo[i]
                    spans.setdefault(d, []).extend(window_spans(tags[i], weight[i], s, len(texts[d])))
                todo.clear()

            for d, text in enumerate(texts):
                for s in window_starts(text):
                    todo.append((d, s))
                    if len(todo) == _BATCH:
                        advance()
            if todo:
                advance()
            out = []
            for d, text in enumerate(texts):
                base = [f[:3] for f in base_matches(text) if f[3]] if _TELLING.search(text) else []
                new = [s for s in reconcile(spans.get(d, [])) if is_plausible(s[0], text[s[1]:s[2]])]
                rows = sorted([(*f, False) for f in base] + [(*f, True) for f in _overlap(base, new)])
                out.append([dict(zip(("kind", "start", "end", "added"), r)) for r in rows])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, kind)], ["doc_id", "found"])

    return run


def find_personal(docs: DataFrame, net: Network, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, found): array of (kind, start, end, added) by kind (index into
    KINDS) and start; code points, end exclusive."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_scanner(net), f"doc_id {kind}, found array<struct<kind:int,start:bigint,end:bigint,added:boolean>>")


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def personal_digest(docs: DataFrame, net: Network) -> DataFrame:
    """Counts and digest of the base spans, all spans, and ``n_added``."""
    found = find_personal(docs, net)
    base = F.filter("found", lambda s: ~s["added"])

    def n(k: int) -> Column:
        return F.size(F.filter("found", lambda s: (s["kind"] == k) & ~s["added"])).cast("long")
    return found.select("doc_id", *[n(k).alias(f"n_{name}") for k, name in enumerate(KINDS)], F.sha2(_joined(base), 256).alias("base_sha256"),
                        _joined(F.col("found")).alias("spans"), F.size(F.filter("found", lambda s: s["added"])).cast("long").alias("n_added"))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return personal_digest(docs, fit(docs))
