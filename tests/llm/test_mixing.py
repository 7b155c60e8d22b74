"""The mix against its SQL, and against a plain queue simulation."""

import duckdb
import pytest

from casebook.llm import mixing
from tests.llm.helpers import SF, edge_docs, rows_of


def test_equals_the_sql(spark):
    got = mixing.op9_mixing(spark, SF).toPandas().sort_values("doc_id").reset_index(drop=True)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.execute(mixing.ORACLE_SQL).df().sort_values("doc_id").reset_index(drop=True)
    assert (got == want[got.columns]).all().all()


def test_edge_rows_and_reruns(spark):
    df = edge_docs(spark)
    a, b = rows_of(mixing.mix_sources(df)), rows_of(mixing.mix_sources(df.repartition(7)))
    assert a == b and len(a) == df.count()
    con = duckdb.connect()
    con.register("documents", df.select("doc_id", "text", "source").toPandas().astype({"doc_id": "Int64"}))
    want = con.execute(f"select doc_id, size, source_size, target, taken from ({mixing.ORACLE_SQL})").fetchall()
    assert a == sorted(map(tuple, want), key=repr)
    assert mixing.mix_sources(df.limit(0)).count() == 0


def test_targets_and_limits(spark):
    out = mixing.op9_mixing(spark, SF).toPandas()
    assert ((out.taken >= 0) & (out.taken <= 2 * out["size"])).all()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source").toPandas()
    per = out.merge(docs, on="doc_id").groupby("source").agg(target=("target", "first"), taken=("taken", "sum"), largest=("size", "max"))
    assert ((per.taken - per.target).abs() <= per.largest).all()
    assert per.target.sum() == pytest.approx(1.5 * out["size"].sum())


def test_water_level(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000), (None, 4)], "source string, source_size long")
    t = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    assert t["a"] == 20 and t[None] == 8                       # stopped at twice their size
    assert t["b"] == pytest.approx(2 * t["c"]) and sum(t.values()) == pytest.approx(1.5 * 2014)


def test_one_id_with_many_texts_gives_the_same_texts(spark):
    """Null and repeated ids: the texts and columns taken do not depend on how
    the rows are dealt, and the rows of one id are spread over the key buckets."""
    rows = [(7 if i % 2 else None, f"w{i} and five other words here", "en", "s0", i) for i in range(400)]
    rows += [(7, "same text of six words here", "en" if i % 2 else "de", "s0", i) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = [rows_of(mixing.mix_sources(df.repartition(n), keep=("text", "lang", "n_chars")).where("taken > 0").select("text", "lang", "n_chars", "taken"))
           for n in (1, 3, 7)]
    assert got[0] == got[1] == got[2] and 0 < sum(r[3] == 6 for r in got[0])
    from pyspark.sql import functions as F
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5("text")))
    largest = df.where("doc_id = 7").groupBy(F.substring(key, 1, 2)).count().agg(F.max("count")).first()[0]
    assert largest < 60


def test_no_folder_on_a_cluster_is_an_error():
    from types import SimpleNamespace
    from casebook.llm._common import shared_folder

    def session(master):
        context = SimpleNamespace(master=master, _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: SimpleNamespace(isEmpty=lambda: True))),
                                  getConf=lambda: SimpleNamespace(get=lambda key, default: None))
        return SimpleNamespace(sparkContext=context)
    for master in ("spark://host:7077", "yarn", "local-cluster[3,2,3000]", "k8s://x"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(session(master))
