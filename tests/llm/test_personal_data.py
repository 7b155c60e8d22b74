"""Base spans against plain regular expressions, the network against finite
differences and enumeration, reconciliation against brute force."""

import hashlib
import itertools
import random
import re
import time

import numpy as np
import pytest

from casebook.llm import personal_data as P
from tests.llm.helpers import SF, edge_docs, edge_rows

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _luhn(s):
    total = 0
    for i, c in enumerate(reversed(s)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _base(text):
    text = text or ""
    d = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", m) for m in EMAIL.finditer(text)]
    out += [("ip", m) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", m) for m in CARD.finditer(text) if 16 <= len(d(m[0])) <= 19 and _luhn(d(m[0]))]
    out += [("phone", m) for m in PHONE.finditer(text) if 8 <= len(d(m[0])) <= 15]
    return [f"{k}:{m.start()}:{m.end()}" for k, m in out]


@pytest.fixture(scope="module")
def net(spark):
    return P.fit(spark.read.parquet(f"{SF}/documents.parquet"), train_rows=700)


def _check(df, net):
    got = P.personal_digest(df, net).collect()
    texts = df.select("doc_id", "text").collect()
    want = sorted((repr(r.doc_id), hashlib.sha256(",".join(_base(r.text)).encode()).hexdigest(), tuple(
        sum(s.startswith(k) for s in _base(r.text)) for k in P.KINDS)) for r in texts)
    assert sorted((repr(r.doc_id), r.base_sha256, (r.n_email, r.n_ip, r.n_card, r.n_phone)) for r in got) == want
    own = {}
    for r in texts:
        own.setdefault(r.doc_id, set()).update(_base(r.text))
    for r in got:
        spans = [s for s in r.spans.split(",") if s]
        assert len(spans) == r.n_email + r.n_ip + r.n_card + r.n_phone + r.n_added
        assert spans == sorted(spans, key=lambda s: (P.KINDS.index(s.split(":")[0]), int(s.split(":")[1])))
    return got


def test_base_on_the_whole_table(spark, net):
    got = _check(spark.read.parquet(f"{SF}/documents.parquet"), net)
    assert sum(r.n_added for r in got) < 10


def test_base_on_edge_rows(spark, net):
    tricky = ["a@b@c.de", "x@y.z@w.v", "@b.c a@ b.c a@b", "é.ü@x.y ü1@é.de", "1.2.3.4.5.6.7.8 1.2.3 300.1.1.1 0000255.1.1.0255 1..2.3.4", "1.2.3.4.5",
              "4111 1111 1111 1111", "4111-1111-1111-1111-", "41111111111111111111", "4111111111111111 4111111111111111", "+1 (017) 555-7713 x +1", "+49(30)..123456",
              "++1 2345678 +123456789012345 +1234567890123456", "a1@b2.c3" * 30, "9" * 4000 + "." + "9" * 4000 + ".1.1", "+" * 3000, "@" * 3000, "a" * 5000 + "@",
              "mail " + "x" * 200 + "@" + "y" * 200 + ".com end", "١٢٣@x.y 1².3.4.5", "𝄞 a@b.cd 𝄞 +1 234 567 89"]
    rows = edge_rows() + [(100 + i, t, "en", "s", 1) for i, t in enumerate(tricky)]
    _check(edge_docs(spark, rows).repartition(3), net)
    assert P.personal_digest(edge_docs(spark, rows).limit(0), net).count() == 0
    empty = P.labelled_windows(edge_docs(spark, rows).limit(0), "text", "doc_id", 10, 10)
    assert empty == [] and P.training_set(empty, made=50)[0].shape == (50, P.WIDTH)


def test_the_network_adds_what_rules_miss(spark, net):
    """Side by side and otherwise written numbers; look-alikes stay out."""
    rnd = random.Random(7)

    def card():
        s = "".join(rnd.choice("0123456789") for _ in range(15))
        return next(s + c for c in "0123456789" if _luhn(s + c))
    words = "some plain words of text stand here, and after them "
    pairs = [(card(), card()) for _ in range(60)]
    rows = [(i, f"{words}{a} {b} and so on.") for i, (a, b) in enumerate(pairs)]
    phones = [f"+1 ({rnd.randint(100, 999)}) 555-{rnd.randint(1000, 9999)}" for _ in range(60)]
    ips = [".".join(str(rnd.randint(10, 255)) for _ in range(4)) for _ in range(60)]
    rows += [(100 + i, f"{words * 3}{p} {q} and so on.") for i, (p, q) in enumerate(zip(phones, ips))]
    clean = ["On 2024-01-02 at 12:30:05 version 3.14.15 cost $1,234.50.", "No numbers at all.", 'token = "0123456789abcdef0123456789abcdef01234567"',
             "pages 100-200, 5 of 12, 1999/2000", "@home @work", words * 50 + "4.0"]
    rows += [(200 + i, t) for i, t in enumerate(clean)]
    got = {r.doc_id: r for r in P.personal_digest(spark.createDataFrame(rows, "doc_id long, text string"), net).collect()}
    at = len(words)
    both = sum(f"card:{at}:{at + 16},card:{at + 17}:{at + 33}" in got[i].spans for i in range(60) if got[i].n_card == 0)
    assert both >= 0.9 * sum(got[i].n_card == 0 for i in range(60)) > 40
    at = 3 * len(words)
    assert sum(f"phone:{at}:{at + len(p)}" in got[100 + i].spans for i, p in enumerate(phones)) >= 54
    assert [got[200 + i].spans for i in range(len(clean))] == [""] * len(clean)


def test_held_out_windows(spark, net):
    """The network alone, on documents that it did not learn from."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id >= 5000")
    rows = P.labelled_windows(docs, "text", "doc_id", 2000, 400)
    codes, tags = P.training_set(rows, made=0)
    got, _ = P.decode(net, codes)
    inside = tags > 0
    assert inside.sum() > 2000
    assert (got == tags)[inside].mean() > 0.93 and (got == tags)[~inside].mean() > 0.98


def test_gradient_by_differences():
    rnd = np.random.default_rng(3)
    net = P.Network.fresh(1, hidden=4)
    codes, tags = rnd.integers(0, P.SYMBOLS, (3, 6)), np.array([[0, 1, 2, 2, 0, 3], [4, 4, 0, 0, 7, 8], [0, 5, 5, 6, 0, 0]])
    _, grads = P.loss_and_gradient(net, codes, tags)
    for part, grad in zip(net.parts(), grads):
        for _ in range(12):
            at = tuple(rnd.integers(0, n) for n in part.shape)
            old, eps = part[at], 1e-5
            part[at] = old + eps
            up = P.loss_and_gradient(net, codes, tags)[0]
            part[at] = old - eps
            down = P.loss_and_gradient(net, codes, tags)[0]
            part[at] = old
            assert abs((up - down) / (2 * eps) - grad[at]) < 1e-6


def test_paths_by_enumeration():
    rnd = np.random.default_rng(5)
    net = P.Network.fresh(2, hidden=4)
    net.trans[:] = rnd.normal(size=net.trans.shape)
    net.start[:] = rnd.normal(size=net.start.shape)
    codes = rnd.integers(0, P.SYMBOLS, (4, 4))
    scores, trans = P.emissions(net, codes), net.transitions()
    tags, weight = P.decode(net, codes)
    for w in range(4):
        total = {}
        for path in itertools.product(range(P.TAGS), repeat=4):
            total[path] = net.start[path[0]] + sum(scores[w, t, k] for t, k in enumerate(path)) + sum(trans[a, b] for a, b in zip(path, path[1:]))
        best = max(total, key=total.get)
        assert tuple(tags[w]) == best
        z = np.logaddexp.reduce(list(total.values()))
        for t in range(4):
            share = sum(np.exp(s - z) for p, s in total.items() if p[t] == best[t])
            assert abs(share - weight[w, t]) < 1e-9


def test_reconcile_by_brute_force():
    rnd = random.Random(6)
    for _ in range(200):
        spans = []
        for _ in range(rnd.randint(0, 7)):
            a = rnd.randint(0, 20)
            spans.append((rnd.randrange(4), a, a + rnd.randint(1, 8), rnd.random() * 5, False))
        got = P.reconcile(spans)
        weight = {}
        for k, a, b, w, _ in spans:
            weight[k, a, b] = max(w, weight.get((k, a, b), 0))
        best = 0.0
        for n in range(len(weight) + 1):
            for chosen in itertools.combinations(weight, n):
                row = sorted(chosen, key=lambda s: s[1])
                if all(x[2] <= y[1] for x, y in zip(row, row[1:])):
                    best = max(best, sum(weight[s] for s in chosen))
        assert abs(sum(weight[s] for s in got) - best) < 1e-9
        assert all(x[2] <= y[1] for x, y in zip(got, got[1:]))
    # a span over several windows is joined from its parts
    assert P.reconcile([(0, 70, 80, 9, True), (0, 40, 120, 60, True), (0, 80, 130, 45, True), (0, 200, 210, 5, False)]) == [(0, 40, 130), (0, 200, 210)]


def test_windows_cover_every_digit():
    rnd = random.Random(8)
    for _ in range(50):
        text = "".join(rnd.choice("abc   1@" if rnd.random() < 0.1 else "abc ") for _ in range(rnd.randint(0, 700)))
        want = [s for s in range(0, max(len(text), 1), P.STRIDE) if re.search("[0-9@]", text[s:s + P.WIDTH])]
        assert P.window_starts(text) == want


def test_long_texts_stay_linear():
    for unit in ("9", "a@", "+1", "1.", "4 ", "a", "@a.", "1-"):
        took = []
        for n in (100_000, 400_000):
            t = time.process_time()
            P.base_matches(unit * (n // len(unit)))
            took.append(time.process_time() - t)
        assert took[1] < 10 * took[0] + 0.5, unit
