"""Joins on keys of which a few may hold much of the fact table.

A hash join sends all rows of a key to one task. ``hot_join`` finds the heavy
keys in the plan itself, with a frequent-items sketch (``approx_top_k``) over
the key column, and splits only those: each fact row of a heavy key gets one of
n salts, the matching rows of the other side are repeated n times. n follows
from the key's share, so that a salted key is about as large as an average
partition. Keys the sketch misses are joined unsplit; the result never depends
on the sketch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SALT = "_salt"


def heavy_keys(keys: DataFrame, key: str, parts: int) -> Column:
    """Scalar map from each key with over two partitions' worth of rows to the
    number of salts it is split into. There are fewer than ``parts`` / 2."""
    most = min(max(parts, 8), 1000)
    top = keys.where(F.col(key).isNotNull()).agg(
        F.expr(f"approx_top_k(`{key}`, {most}, {10 * most})").alias("top"), F.count(F.lit(1)).alias("n"))
    share = lambda x: x["count"] * parts
    heavy = F.filter("top", lambda x: share(x) > F.col("n") * 2)
    salts = F.transform(heavy, lambda x: F.struct(x["item"], F.least(F.lit(parts), F.ceil(share(x) / F.col("n"))).cast("int")))
    return top.select(F.map_from_entries(salts).alias("heavy")).scalar()


def hot_join(facts: DataFrame, right: DataFrame, key: str, how: str = "inner",
             keys: DataFrame | None = None, parts: int | None = None) -> DataFrame:
    """``facts.join(right, key, how)`` for an inner or left join, with heavy
    keys of ``facts`` split. ``keys``: a cheaper table with a like share of
    rows per key for the sketch (default: ``facts``). A NULL key matches
    nothing; in a left join such rows are spread."""
    if how not in ("inner", "left"):
        raise ValueError(f"hot_join does inner and left joins, not {how}")
    parts = parts or int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = heavy_keys((facts if keys is None else keys).select(key), key, parts)
    salts = F.coalesce(F.try_element_at(heavy, F.col(key)), F.lit(1))
    spread = F.when(F.col(key).isNull(), F.lit(parts)).otherwise(salts) if how == "left" else salts
    rest = [F.col(f"`{c}`") for c in facts.columns if c != key] or [F.col(key)]
    salted = facts.withColumn("_n", spread).withColumn(
        _SALT, F.when(F.col("_n") > 1, F.pmod(F.xxhash64(*rest), F.col("_n")).cast("int")).otherwise(0)).drop("_n")
    repeated = right.withColumn(_SALT, F.explode(F.sequence(F.lit(0), salts - 1)))
    return salted.join(repeated, [key, _SALT], how).drop(_SALT)
