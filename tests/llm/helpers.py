"""Small documents for the corpus operators' tests."""

import random

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rnd, n, alphabet="abcdeé"):
    return " ".join("".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 8))) for _ in range(n))


def edge_rows(seed=1):
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    rnd = random.Random(seed)
    base = words(rnd, 300)
    rows = [(i, words(rnd, rnd.randint(0, 120)), "en", f"s{i % 3}", 0) for i in range(30)]
    rows += [(30, None, None, None, None), (31, "", "en", "s0", 0), (32, "  \n\t ", "en", None, None), (None, base, "en", "s1", None)]
    rows += [(33, words(rnd, 40_000), "en", "s0", 1), (34, base, "en", "s1", 1), (35, base, "en", "s2", 1), (34, base, "en", "s1", 1)]
    rows += [(34, words(rnd, 50), "en", "s1", 1)]
    return rows


def edge_docs(spark, rows=None):
    """The rows with extra columns that clash with names used inside."""
    df = spark.createDataFrame(edge_rows() if rows is None else rows, SCHEMA)
    return clash(df)


def clash(df):
    from pyspark.sql import functions as F
    names = ["t", "th", "fp", "key", "size", "sk", "root", "score", "counts", "gram", "pos", "x", "y", "m", "found", "ids", "vec", "b", "g",
             "kind", "rank", "target", "taken", "starts", "listed", "spans", "predicted", "component_id", "doc", "h", "s", "text_", "__t"]
    return df.select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)])


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)
