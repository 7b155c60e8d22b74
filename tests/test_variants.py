"""Declared text lengths, case-insensitive comparison, and the bitmap index on
basket keys that are no integers."""

import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from casebook.functions.collation import ci, collated, group_key
from casebook.functions.varchar import as_varchar, declared, widen, widths
from casebook.operators.basket import triple_counts


def test_varchar_survives_a_write_and_a_widening(spark, tmp_path):
    df = as_varchar(spark.createDataFrame([("C1",), ("F22",), (None,)], "segment string"), "segment", 4)
    df.write.parquet(str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t"))
    assert declared(back, "segment") == 4 and declared(spark.range(1).select(F.lit("x").alias("s")), "s") is None
    with pytest.raises(Exception, match="longer than varchar"):
        as_varchar(back.withColumn("segment", F.lit("unknown")), "segment", declared(back, "segment")).collect()
    wide = widen(back, "segment", 10)
    filled = as_varchar(wide.withColumn("segment", F.coalesce("segment", F.lit("unknown"))), "segment", 10)
    assert [tuple(r) for r in widths(filled).collect()] == [("segment", 10, 7, 3)]
    with pytest.raises(ValueError, match="narrower"):
        widen(wide, "segment", 3)
    with pytest.raises(Exception, match="longer than varchar"):
        as_varchar(wide, "segment", 2).collect()


def test_collated_text_in_filters_joins_and_groups(spark):
    df = collated(spark.createDataFrame([("Abc", 1), ("aBC", 2), ("abd", 3), (None, 4)], "t string, n int"), "t")
    assert df.where(F.col("t") == "ABC").count() == 2 and df.where(F.col("t").like("AB%")).count() == 3
    other = collated(spark.createDataFrame([("ABC", "x")], "u string, m string"), "u")
    assert sorted(r.n for r in df.join(other, F.col("t") == F.col("u")).collect()) == [1, 2]
    got = df.groupBy("t").agg(F.sum("n").alias("n")).select(group_key("t").alias("t"), "n").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([("abc", 3), ("abd", 3), (None, 4)], key=repr)
    assert [r.n for r in df.orderBy(ci("t").asc_nulls_last(), F.desc("n")).collect()] == [2, 1, 3, 4]


@pytest.mark.parametrize("key", ["string", "sparse", "negative"])
def test_triples_of_any_basket_key(spark, key):
    """Text keys, far apart and negative integer keys, repeated rows, NULLs,
    one basket with every item."""
    rnd = random.Random(7)
    name = {"string": lambda b: f"txn-{b}", "sparse": lambda b: b * 10 ** 12 + 7, "negative": lambda b: -b * 70_000}[key]
    items = [f"p{i:02d}" for i in range(24)]
    baskets = {name(b): rnd.sample(items, rnd.randint(1, 7)) for b in range(120)} | {name(500): items}
    rows = [(b, i) for b, own in baskets.items() for i in own]
    rows += rows[:40] + [(None, "p01"), (name(3), None)]
    df = spark.createDataFrame(rows, f"b {'string' if key == 'string' else 'long'}, item string").repartition(3)
    want = Counter(t for own in baskets.values() for t in combinations(sorted(set(own)), 3))
    got = {(r.i1, r.i2, r.i3): r.combo_count for r in triple_counts(df, "b", "item", k=5).collect()}
    fifth = sorted(want.values())[-5]
    assert all(want[t] == n for t, n in got.items()) and {t for t, n in want.items() if n >= fifth} <= set(got)
    assert triple_counts(df.limit(0), "b", "item").count() == 0
