"""Held-out accuracy, defined cases, and compiled rules against the matrix."""

import zlib

import numpy as np

from casebook.llm import quality_rules as Q
from tests.llm.helpers import edge_docs

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    out = Q.op1_quality_rules(spark, SF).toPandas()
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality").toPandas()
    assert len(out) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert (out.held_out == out.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % 5 == 0)).all()
    held = out[out.held_out].merge(labels, on="doc_id")
    assert (held.predicted == held.quality).mean() > 0.97
    assert held.score.between(0, 1).all() and ((held.score >= 0.3) == (held.predicted == 1)).all()


def test_compiled_rules_equal_the_matrix(spark):
    rnd = np.random.default_rng(1)
    x = rnd.random((500, 3))
    y = ((x[:, 0] > 0.5) & (x[:, 1] < 0.4)).astype(float)
    names = ["a", "b", "c"]
    rules = Q.grow_rules(x, y, names)
    bias, w = Q.lasso_logistic(Q.rule_matrix(x, names, rules), y)
    model = Q.RuleModel(bias, tuple((r, float(v)) for r, v in zip(rules, w) if abs(v) > 1e-6))
    assert len(model.rules) < len(rules)                  # the lasso drops rules
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    got = np.array([r[0] for r in df.select(model.column()).collect()])
    want = 1 / (1 + np.exp(-(bias + Q.rule_matrix(x, names, [r for r, _ in model.rules]) @ np.array([v for _, v in model.rules]))))
    assert np.allclose(got, want) and ((got > 0.5) == (y > 0.5)).mean() > 0.97


def test_edge_rows_and_labels(spark):
    df = edge_docs(spark)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(30)] + [(3, None, None), (None, 1, 1), (999, 1, 0), (5, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    a = sorted(map(tuple, Q.score(df, Q.fit(df, labels)).collect()), key=repr)
    b = sorted(map(tuple, Q.score(df, Q.fit(df.repartition(5), labels)).collect()), key=repr)
    assert a == b and len(a) == df.count() and all(0 <= r[1] <= 1 for r in a)
    none = Q.score(df, Q.fit(df, labels.limit(0))).collect()
    assert all(r.score == 0.5 for r in none)
    one = Q.fit(df, labels.where("quality = 1"))
    assert all(r.predicted == 1 for r in Q.score(df, one).collect())
    assert Q.score(df.limit(0), one).count() == 0
