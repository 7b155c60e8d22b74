"""The corpus pipeline: stages applied to ``documents`` one after another.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and
returns a DataFrame; all but the last return the columns of ``documents``.

1. quality: documents that the rule ensemble rejects (score below 0.3) go
2. near_duplicates: one document of each class of fingerprints stays
3. secrets: spans that the scan finds are masked, every document stays
4. mix: each document as often as the mix to the target weights takes it
5. encode: the ids of each document's text

Defined cases are those of the operators. Extra columns of ``docs`` are
dropped; an empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm import bpe, golay_simhash, mixing, quality_rules, secret_scan
from casebook.llm._common import table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of at least 0.3."""
    model = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    return quality_rules.score(docs, model, keep=tuple(COLUMNS)).where("predicted = 1").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class linked at 4 or fewer bits (4-word shingles)."""
    return golay_simhash.drop_near_duplicates(docs.select(*COLUMNS), words=4, bits=4)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets masked; n_chars is the new length."""
    masked = secret_scan.redact(docs.select(*COLUMNS, F.col("text").alias("masked")), "masked")
    changed = F.col("masked") != F.col("text")
    return masked.select("doc_id", F.col("masked").alias("text"), "lang", "source",
                         F.when(changed, F.length("masked").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")).alias("n_chars"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix to the target weights takes it."""
    mixed = mixing.mix_sources(docs, keep=tuple(COLUMNS[1:]))
    turns = F.col("taken").cast("double") / F.when(F.col("size") > 0, F.col("size"))
    return (mixed.where("taken > 0").withColumn("turn", F.explode(F.sequence(F.lit(1), F.round(turns).cast("int"))))
            .select(*COLUMNS))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document's text."""
    return bpe.encode(docs, keep=("doc_id", "lang", "source")).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mix", mix), ("encode", encode)]

# A fitted model, fingerprint classes and BPE have no SQL form; the stages are
# tested against brute force in tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table; what a stage returns is
    written as Parquet and reread as the next one's documents."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
