"""Lazy loader for the driver's parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


class Tables(dict):
    """``dict`` of DataFrames that reads each parquet file on first access. It
    lives as long as one query: the next query lists the files anew."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __missing__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise KeyError(name)
        df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        self[name] = df
        return df

    def __getattr__(self, name: str) -> DataFrame:
        try:
            return self[name]
        except KeyError as e:
            raise AttributeError(name) from e


def load(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)
