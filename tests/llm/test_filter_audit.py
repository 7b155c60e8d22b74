"""The audit against brute force and SQL; posting lists against sets."""

import itertools
import random
import re

import duckdb

from casebook.llm import filter_audit as A
from tests.llm.helpers import SF, clash, edge_docs, edge_rows

LABELS = "doc_id long, quality int, toxic int"
FIELDS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def _fails(rows):
    first = {}
    for i, t, *_ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    out = []
    for i, t, lang, *_ in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        bad = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
               "D": re.search(r"[#$%&*|]", t) is not None, "E": i is not None and i > first[t]}
        out.append((lang or "", i, {k for k, v in bad.items() if v}))
    return out


def _want(rows, labels):
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, x in labels if x == 1}
    failing = _fails(rows)
    out = []
    for part in {p for p, _, _ in failing}:
        mine = [(i, bad) for p, i, bad in failing if p == part]
        own = []
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [i for i, bad in left if f in bad]
                left = [(i, bad) for i, bad in left if f not in bad]
                redundant = sum(f in bad and not bad.isdisjoint(order[:step - 1]) for _, bad in mine)
                own.append((part, "".join(order), step, len(left), len(gone), redundant, sum(bad == {f} for _, bad in mine),
                            sum(i in good for i in gone), sum(i in toxic for i in gone)))
        total = {f: sum(r[4] for r in own if r[1][r[2] - 1] == f) for f in "ABCDE"}
        out += [(*r, total[r[1][r[2] - 1]]) for r in own]
    return sorted(out)


def _got(spark, docs, labels):
    return sorted(tuple(r[f] for f in FIELDS) for r in A.audit(A.failing_rows(docs, labels)).collect())


def _tricky():
    rnd = random.Random(4)
    rows = [(i, t, lang, s, 0) for i, t, lang, s, _ in edge_rows()]
    words = " ".join(f"w{i}" for i in range(120))
    for i in range(200, 320):
        text = rnd.choice([words, words.upper(), words + " #", "a b " * 60, "short", "SHORT", "Long Words" * 30, "", None, "é\x0bÀ\x1cx\x85y\xa0z " * 60])
        rows.append((rnd.choice([i, i, 250, None]), text, rnd.choice(["en", "de", "", None, "fr"]), "s", 0))
    return rows + rows[-5:]


def test_edge_rows_and_hot_keys(spark, monkeypatch):
    """Null and repeated ids, equal texts, null parts; keys looked up by
    broadcast and by shuffle; ranges of a few rows."""
    rows = _tricky()
    labels = [(r[0], k % 2, k % 3 % 2) for k, r in enumerate(rows) if k % 4] + [(250, 0, 1), (250, None, None), (None, 1, 1), (99999, 1, 1)]
    docs, marks = edge_docs(spark, rows), clash(spark.createDataFrame(labels, LABELS))
    want = _want(rows, [x for x in labels if x[0] is not None])
    for hot in (1, 20, 1000):
        monkeypatch.setattr(A, "HOT", hot)
        assert _got(spark, docs.repartition(3), marks) == want
    assert A.audit(A.failing_rows(docs.limit(0), marks)).count() == 0
    assert _got(spark, docs, marks.limit(0)) == _want(rows, [])


def test_whole_table_against_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    res = con.execute(A.ORACLE_SQL)
    names = [d[0] for d in res.description]
    want = sorted(tuple(dict(zip(names, r))[f] for f in FIELDS) for r in res.fetchall())
    got = sorted(tuple(r[f] for f in FIELDS) for r in A.op12_filter_audit(spark, SF).collect())
    assert got == want and len(got) % 600 == 0 and any(r[4] for r in got)


def test_merges_against_sets():
    rnd = random.Random(2)
    for _ in range(300):
        ids = [sorted(rnd.sample(range(60), rnd.randint(0, 60))) for _ in range(rnd.randint(1, 5))]
        own, others = ids[0], ids[1:]
        left = [x for a, b in A.without(own, others) for x in own[a:b]]
        assert left == sorted(set(own).difference(*others))
        x, at = rnd.randint(0, 60), rnd.randint(0, len(own))
        assert A.gallop(own, at, x) == next((k for k in range(at, len(own)) if own[k] >= x), len(own))


def test_ranges_add_up():
    """Sums over small ranges equal the sums over all rows."""
    import numpy as np
    rnd = np.random.default_rng(1)
    fails, good, toxic = rnd.integers(0, 32, 5000), rnd.integers(0, 2, 5000) > 0, rnd.integers(0, 9, 5000) > 7
    whole = A.range_sums(fails, good, toxic)
    parts = sum(A.range_sums(fails[i:i + 300], good[i:i + 300], toxic[i:i + 300]) for i in range(0, 5000, 300))
    assert (whole == parts).all()
    assert whole[A.slot(2, 0b01011)] == ((fails & 4 > 0) & (fails & 0b01011 == 0)).sum()
