"""Spelling variants against brute force; the bound against every edit."""

import random
import re
import zlib
from collections import Counter

from casebook.llm import spelling_variants as V
from tests.llm.helpers import SF, edge_docs, edge_rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _counts(rows, least=5):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 6 and k >= least}


def _near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def _want(rows):
    n = _counts(rows)
    form, near = {}, {}
    for w in n:
        others = [x for x in n if abs(len(x) - len(w)) < 2 and _near(w, x)]
        near[w] = len(others)
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])
    return sorted((w, form[w] or "", root(w), n[w], near[w], n.get(form[w], 0)) for w in n)


def _got(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in df.collect())


def _rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_sample_of_the_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 150")
    got = _got(V.spelling_variants(docs))
    assert got == _want(_rows(docs)) and any(r[1] for r in got)


def test_chains_edge_rows_and_letters(spark):
    """Forms of forms, letters beyond ASCII, marks that are no letters, × and
    ÷ (which the range holds), repeated rows, nulls, an empty table."""
    rnd = random.Random(5)
    words = Counter({"chaine": 3200, "chainée": 600, "chainées": 110, "cchainées": 20, "ÀÉÎÕÜß": 30, "ÀÉÎÕÜÿ": 6, "letter": 40, "lettér": 8, "lettèr": 8,
                     "kanál×": 50, "kanál÷": 5, "aaaaaa": 100, "aaaaaaa": 18, "aaaaaaaa": 5, "ababab": 70, "bababa": 9})
    tokens = [w for w, k in words.items() for _ in range(k)]
    rnd.shuffle(tokens)
    rows = edge_rows() + [(1000 + i, " ".join(tokens[i::40]).title() if i % 2 else "_".join(tokens[i::40]), "en", "s", 1) for i in range(40)]
    rows += rows[-3:] + [(None, "missing Missing " * 20, None, None, None)]
    df = edge_docs(spark, rows)
    got = _got(V.spelling_variants(df))
    assert got == _want([(r[0], r[1]) for r in rows])
    roots = {r[0]: r[2] for r in got}
    assert roots["cchainées"] == "chaine" and roots["kanál÷"] == "kanál×"
    assert V.spelling_variants(df.limit(0)).count() == 0


def test_bound_holds_for_every_edit():
    """At least |grams| - bound grams outlast any edit, at the same place from
    the left or from the right, whatever the dictionary."""
    rnd = random.Random(9)
    vocabulary = ["".join(rnd.choice("abc") for _ in range(rnd.randint(6, 12))) for _ in range(300)]
    for low, high, limit in ((2, 5, 20), (2, 4, 60), (3, 6, 5), (2, 5, 10 ** 9), (2, 5, 0)):
        n = Counter()
        for w in vocabulary:
            t = V.LEFT * (high - 1) + w + V.RIGHT * (high - 1)
            n.update(t[i:i + q] for q in range(low, high + 1) for i in range(len(t) - q + 1))
        common = {g: k for g, k in n.items() if k > limit}
        for w in rnd.sample(vocabulary, 40):
            text, grams = V.decompose(w, common, low, high)
            bound = V.affected_bound(text, grams, common, low, high)
            assert len(grams) > bound
            own = {(text[p:e], p) for p, e in grams}
            edits = [(w[:i] + c + w[i + 1:], 0) for i in range(len(w)) for c in "abcx" if c != w[i]]
            edits += [(w[:i] + c + w[i:], 1) for i in range(len(w) + 1) for c in "abcx"] + [(w[:i] + w[i + 1:], -1) for i in range(len(w))]
            for other, shift in edits:
                t, g = V.decompose(other, common, low, high)
                theirs = {(t[p:e], p) for p, e in g}
                kept = len({(x, p) for x, p in own if (x, p) in theirs or (x, p + shift) in theirs})
                assert kept >= len(grams) - bound, (w, other)


def test_dictionary_is_bounded(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    words = V.word_counts(docs).cache()
    for size in (10, 100, 1000):
        assert len(V.gram_dictionary(words, dictionary=size, least=1)) < size
    small = V.near_pairs(words, dictionary=300, least=1).select("a", "b").collect()
    assert sorted(small) == sorted(V.near_pairs(words, low=3, high=6).select("a", "b").collect())
    words.unpersist()
