"""Table housekeeping of the studies' scripts, as DataFrame operations.

The scripts preview tables (``select * from t``), inspect them
(``describe t``, ``show tables``) and rewrite columns in place (``UPDATE`` /
``ALTER TABLE``). On immutable DataFrames these become an ordered limit, a
schema listing, temporary views, and a column rewrite that returns a new
DataFrame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def preview(df: DataFrame, n: int = 20, order: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows in an explicit order (``select * ... limit n``):
    a top-k, not a full sort. Without ``order`` the columns are the order."""
    return df.orderBy(*(order or df.columns)).limit(n)


def describe(df: DataFrame) -> DataFrame:
    """``describe t``: one row per column with its type and nullability.
    Built from the schema (metadata), without reading any data."""
    rows = [(f.name, f.dataType.simpleString(), "YES" if f.nullable else "NO") for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "col_name string, data_type string, nullable string")


def register_views(spark: SparkSession, views, names: Sequence[str], prefix: str = "") -> list[str]:
    """Expose study views as temporary views (``show tables`` lists them),
    so the studies' SQL can run through ``spark.sql`` on the same tables."""
    done = []
    for name in names:
        getattr(views, name).createOrReplaceTempView(prefix + name)
        done.append(prefix + name)
    return done


def update(df: DataFrame, column: str, value: Column, where: Column | None = None) -> DataFrame:
    """``UPDATE t SET column = value [WHERE where]`` (or ``ALTER TABLE ADD``
    when ``column`` is new): rows failing ``where`` keep their old value."""
    if where is None or column not in df.columns:
        new = value if where is None else F.when(where, value)
    else:
        new = F.when(where, value).otherwise(F.col(column))
    return df.withColumn(column, new)
