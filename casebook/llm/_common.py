"""Helpers shared by the corpus operators: table access and checkpoints."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The reliable checkpoint folder: the context's own if one is set, else
    the one that ``spark.checkpoint.dir`` names. With neither, a local session
    (a test) gets a temp folder; on a cluster, whose executors do not share
    the driver's disk, that is an error."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = sc.getConf().get("spark.checkpoint.dir", None)
        if not named and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("no checkpoint folder: set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="casebook-llm-"))
    return sc._jsc.sc().getCheckpointDir().get()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the reliable checkpoint folder and read back."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared folder and reread."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}.parquet"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
