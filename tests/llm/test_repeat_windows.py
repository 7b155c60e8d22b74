"""Repeated byte strings against brute force."""

import collections
import hashlib
import random

from pyspark.sql import functions as F

from casebook.llm import repeat_windows as R
from tests.llm.helpers import SF, edge_docs, edge_rows


def _brute(texts, length):
    seen = collections.Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((len(t), sum(gone), sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1])),
                    hashlib.sha256(kept).hexdigest()))
    return out


def _check(df, length, gram):
    rows = df.select("doc_id", "text").collect()
    want = sorted(((r.doc_id, *b) for r, b in zip(rows, _brute([(r.text or "").encode() for r in rows], length))), key=repr)
    out = R.remove_repeats(df, length, gram).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    assert sorted(map(tuple, out.collect()), key=repr) == want
    return sum(r[2] for r in want)


def _passages():
    rnd = random.Random(5)

    def w(n):
        return "".join(rnd.choice("abcdé ") for _ in range(n))
    p, q, base = w(700), w(399), w(2000)
    ts = [p + w(300), w(100) + p, q + w(500), w(50) + q, base, base, base[:900] + "X" + base[900:], base[:1500] + "YY" + base[1510:],
          "a" * 1500, "ab" * 500, "", "short", None, w(350) + p[:401], p[100:520] + w(10) + p[100:520]]
    ts += [w(rnd.randint(0, 200)) + p[rnd.randint(0, 200):rnd.randint(500, 700)] + w(rnd.randint(0, 200)) for _ in range(25)]
    return [(i, t, "en", "s", 0) for i, t in enumerate(ts)] + [(4, base, "en", "s", 0), (None, base, None, None, None)]


def test_passages(spark):
    assert _check(edge_docs(spark, _passages()), 400, 224) > 0


def test_other_lengths_and_edge_rows(spark):
    rows = [r for r in edge_rows() if r[0] != 33]
    for length, gram in ((50, 20), (50, 50), (30, 29)):
        assert _check(edge_docs(spark, rows), length, gram) > 0
    assert R.remove_repeats(edge_docs(spark, rows).limit(0)).count() == 0


def test_pieces_of_long_texts(spark, monkeypatch):
    """Texts longer than a piece: runs end at piece edges, results do not."""
    rnd = random.Random(6)
    base = "".join(rnd.choice("abcdefgh") for _ in range(6000))
    rows = [(0, base + "x" + base[500:5000], "en", "s", 0), (1, base[100:4100], "en", "s", 0)]
    whole = sorted(map(tuple, R.remove_repeats(edge_docs(spark, rows)).collect()))
    texts = [r[1].encode() for r in rows]
    monkeypatch.setattr(R, "_PIECE", 700)
    cut = [x for chunk in R._pieces(texts, 400) for x in chunk]
    assert all(len(p) <= 700 + 399 for _, _, p in cut)
    starts = sorted((i, o + s) for i, o, p in cut for s in range(len(p) - 399))
    assert starts == [(i, s) for i, t in enumerate(texts) for s in range(len(t) - 399)]
    assert [(r[0], r[1], r[2]) for r in whole] == [(i, len(t), b[1]) for i, (t, b) in enumerate(zip(texts, _brute(texts, 400)))]


def test_table_against_brute_force(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 3000")
    assert _check(df, 400, 224) > 0


def test_texts_of_one_id_with_equal_short_hashes(spark):
    """Different texts of a null id whose 32-bit hashes are equal: only the
    one that is repeated elsewhere loses bytes."""
    made = F.concat(*[F.sha2(F.concat(F.col("id").cast("string"), F.lit(c)), 256) for c in "abcdefg"])
    many = spark.range(0, 250_000, 1, 4).select(made.alias("t")).withColumn("k", F.hash("t"))
    pairs = [sorted(r.ts) for r in many.groupBy("k").agg(F.collect_list("t").alias("ts")).where(F.size("ts") > 1).collect()]
    assert pairs
    rows = [(None, t, "en", "s", 0) for ts in pairs for t in ts] + [(i, ts[0][:430], "en", "s", 0) for i, ts in enumerate(pairs)]
    assert _check(edge_docs(spark, rows), 400, 224) == 2 * 430 * len(pairs)


def test_copies_have_each_place_once(spark):
    """Rows that repeat id and text: the places do not grow with the copies."""
    rnd = random.Random(9)
    base, other = ("".join(rnd.choice("abcdefgh") for _ in range(3000)) for _ in range(2))
    rows = [(1, base, "en", "s", 0)] * 60 + [(None, other, "en", "s", 0)] * 60 + [(2, base[:1500] + other[1500:], "en", "s", 0)]
    df = edge_docs(spark, rows)
    starts = [list(r.starts) for r in R.repeated_starts(df).collect()]
    assert len(starts) == 3 and all(len(x) == len(set(x)) for x in starts)
    assert _check(df, 400, 224) > 0
