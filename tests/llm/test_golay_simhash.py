"""Fingerprints against a plain count, links and classes against brute force."""

import random

import numpy as np
import xxhash

from casebook.llm import golay_simhash as G
from tests.llm.helpers import SF, edge_docs, words


def _plain(text):
    ws = (text or "").encode().lower().split()
    if not ws:
        return 0
    k = min(4, len(ws))
    h = [xxhash.xxh64_intdigest(b" ".join(ws[i:i + k]), 42) for i in range(len(ws) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _brute(fps, bits=4):
    """Class number of each fingerprint."""
    up = list(range(len(fps)))

    def root(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x
    a = np.array(fps, dtype=np.uint64)
    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1:] ^ a[i]) <= bits).tolist():
            up[root(i + 1 + j)] = root(i)
    return [root(i) for i in range(len(a))]


def _check(rows):
    """rows: (doc_id, fp, component_id)."""
    cls = _brute([f for _, f, _ in rows])
    least = {}
    for c, (d, _, _) in zip(cls, rows):
        if d is not None:
            least[c] = min(least.get(c, d), d)
    assert [least.get(c) for c in cls] == [x for _, _, x in rows]


def test_keys_share_one_for_every_link():
    r = np.random.default_rng(1)
    fp = r.integers(0, 2 ** 64, 3000, dtype=np.uint64)
    for bits in range(5):
        other = fp.copy()
        for i in range(len(fp)):
            for b in r.choice(64, bits, replace=False):
                other[i] ^= np.uint64(1 << int(b))
        pairs = [set(zip(*(x.tolist() for x in G.golay_keys(f)))) for f in (fp, other)]
        shared = {row for row, _ in pairs[0] & pairs[1]}
        assert len(shared) == len(fp)


def test_fingerprint_equals_plain_count():
    rnd = random.Random(2)
    texts = [words(rnd, n) for n in (0, 1, 2, 3, 4, 5, 50, 400)] + ["A  B\tC\nD É e", "\x0b\x0c ", "x " * 200_000]
    for t in texts[:-1]:
        assert G.fingerprint(t.encode()) == _plain(t)
    assert G.fingerprint(texts[-1].encode()) == _plain("x x x x")


def test_whole_table_against_brute_force(spark):
    out = G.op4_golay_simhash(spark, SF).collect()
    _check([(r.doc_id, int(r.fingerprint, 16), r.component_id) for r in out])
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(60).collect())
    for r in out:
        if r.doc_id in texts:
            assert int(r.fingerprint, 16) == _plain(texts[r.doc_id])


def test_edge_rows(spark):
    df = edge_docs(spark)
    out = G.near_duplicates(df).collect()
    assert len(out) == df.count()
    _check([(r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in out])
    kept = G.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert kept.count() == len({r.root for r in out})
    assert G.near_duplicates(df.limit(0)).count() == 0 and G.drop_near_duplicates(df.limit(0)).count() == 0


def test_large_group_in_pieces(spark, monkeypatch):
    """Thousands of fingerprints of one key, with the piece size lowered."""
    monkeypatch.setattr(G, "_PIECE", 16)
    r = np.random.default_rng(5)
    centre = int(r.integers(0, 2 ** 63))
    fps = {centre}
    while len(fps) < 300:
        x = centre
        for b in r.choice(64, int(r.integers(1, 7)), replace=False):
            x ^= 1 << int(b)
        fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    links = G.links(df).collect()
    assert all(bin((x.a ^ x.b) & (1 << 64) - 1).count("1") <= 4 for x in links)
    roots = {r.node & (1 << 64) - 1: r.root for r in G.classes(G.links(df)).collect()}
    cls = _brute(fps)
    for i, f in enumerate(fps):
        for j in range(i):
            same = roots.get(f, f) == roots.get(fps[j], fps[j])
            assert same == (cls[i] == cls[j])
