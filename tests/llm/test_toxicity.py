"""Held-out accuracy, the composed grammar clause by clause, defined cases."""

import zlib

from casebook.llm import toxicity as T
from tests.llm.helpers import edge_docs

SF = "/root/testdata/sf0.1"


def test_clauses():
    kinds = {"oIo": "I0", "YoI": "I1", "IY": "I1", "NoI": "i", "NoooI": "I0", "NooI": "i", "RoI": "r", "IoR": "I0", "T": "T0",
             "YT": "T1", "NT": "t", "oo": None, "": None, "NIoooI": "I0", "RYT": "r", "W": "W", "WI": "I0", "TI": "T0"}
    for clause, want in kinds.items():
        assert T.clause_kind(clause) == want, clause


def test_symbols():
    s = T.Symbols({"zob": "I", "mur$": "W"})
    assert [s[w] for w in ["Idiot!", "zobbel,", "mur", "murx", "you", "not", "KILL", "said:", "..."]] == [
        "I;", "I;", "W", "o", "Y", "N", "T", "R;", "o;"]
    assert T.clause_counts("you are an idiot. She said: stupid; he is no moron", T.Symbols({}))[T.KINDS.index("I1")] == 1


def test_held_out_accuracy(spark):
    out = T.op8_toxicity(spark, SF).toPandas()
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic").toPandas()
    assert len(out) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert (out.held_out == out.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % 3 == 1)).all()
    held = out[out.held_out].merge(labels, on="doc_id")
    assert (held.predicted == held.toxic).mean() > 0.96
    assert ((held.predicted == 1) & (held.toxic == 0)).sum() <= 0.01 * len(held)


def test_edge_rows_and_labels(spark):
    df = edge_docs(spark)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(30)] + [(3, None, None), (None, 1, 1), (999, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    model = T.fit(df, labels)
    out = T.score(df, model).collect()
    assert len(out) == df.count() and all(0 <= r.score <= 1 for r in out)
    default = T.fit(df, labels.limit(0))
    texts = spark.createDataFrame([(1, "you are an idiot"), (2, "a fine day"), (3, None), (4, ""), (5, "he said: idiot")], "doc_id long, text string")
    got = {r.doc_id: r.predicted for r in T.score(texts, default).collect()}
    assert got[1] == 1 and got[2] == got[3] == got[4] == 0
    assert T.score(df.limit(0), model).count() == 0


def test_copies_teach_nothing(spark):
    """One labelled text, copied a hundred times, adds no pattern."""
    rows = [(i, "zarb mudo teri kalu " * 5) for i in range(100)] + [(100 + i, f"plain text number {i} about things") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 100)) for i in range(300)], "doc_id long, toxic int")
    assert T.fit(df, labels).lexicon == {}
