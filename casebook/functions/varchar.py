"""Length-checked text types (VARCHAR(n)) for DataFrames.

The declared length is kept in the column's metadata under the name Spark
itself uses, so it survives a write to Parquet and a read; text that is too
long fails the job, as a strict server refuses the row. Widening changes the
declaration alone, narrowing checks every value anew."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_KEY = "__CHAR_VARCHAR_TYPE_STRING"


def declared(df: DataFrame, column: str) -> int | None:
    """n of a VARCHAR(n) column, None for text of any length."""
    m = re.fullmatch(r"varchar\((\d+)\)", df.schema[column].metadata.get(_KEY, ""))
    return int(m[1]) if m else None


def _declare(df: DataFrame, column: str, n: int) -> DataFrame:
    return df.withMetadata(column, {**df.schema[column].metadata, _KEY: f"varchar({n})"})


def as_varchar(df: DataFrame, column: str, n: int) -> DataFrame:
    """``column`` as VARCHAR(n); the job fails on longer text."""
    c = F.col(column)
    too_long = F.raise_error(F.concat(F.lit(f"{column}: longer than varchar({n}): "), c))
    return _declare(df.withColumn(column, F.when(F.char_length(c) > n, too_long.cast("string")).otherwise(c)), column, n)


def widen(df: DataFrame, column: str, n: int) -> DataFrame:
    """A longer VARCHAR: no value is read. A shorter one is refused."""
    old = declared(df, column)
    if old is not None and n < old:
        raise ValueError(f"{column} is varchar({old}); varchar({n}) would be narrower, use as_varchar")
    return _declare(df, column, n)


def widths(df: DataFrame) -> DataFrame:
    """One row per VARCHAR column: declared, longest (characters), free."""
    cols = [(f.name, declared(df, f.name)) for f in df.schema.fields if declared(df, f.name) is not None]
    per = df.agg(*[F.max(F.char_length(c)).cast("bigint").alias(c) for c, _ in cols])
    rows = F.array(*[F.struct(F.lit(c).alias("col_name"), F.lit(n).cast("bigint").alias("declared"), F.col(c).alias("longest")) for c, n in cols])
    return per.select(F.explode(rows).alias("x")).select("x.*", (F.col("x.declared") - F.col("x.longest")).alias("free"))
