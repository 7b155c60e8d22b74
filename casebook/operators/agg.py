"""Grouped totals, shares of a total and ratio-of-counts helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.functions.numeric import percent


def share_of_total(df: DataFrame, part_cols: Sequence[str], value: Column | str,
                   within: Sequence[str] = (), out: str = "percentage",
                   scale: int = 2) -> DataFrame:
    """Percent of the ``within`` group's total that each part contributes.

    Parts are aggregated first (partial aggregation, one shuffle); group
    totals are then re-aggregated from that already small result and joined
    back on the group key. With no ``within`` the grand total is a scalar
    subquery computed once.
    """
    part_cols, within = list(part_cols), list(within)
    v = F.col(value) if isinstance(value, str) else value
    parts = df.groupBy(*within, *part_cols).agg(F.sum(v).cast(f"decimal(38,{scale})").alias("_part"))
    if within:
        totals = parts.groupBy(*within).agg(F.sum("_part").cast(f"decimal(38,{scale})").alias("_total"))
        return parts.join(totals, within).select(*within, *part_cols, percent("_part", "_total").alias(out))
    grand = parts.agg(F.sum("_part").cast(f"decimal(38,{scale})").alias("_total")).scalar()
    return parts.select(*part_cols, percent(F.col("_part"), grand).alias(out))


def count_where(cond: Column, value: Column | str | None = None) -> Column:
    """``count(case when cond then value end)``; counts rows when no value."""
    if value is None:
        return F.count_if(cond)
    v = F.col(value) if isinstance(value, str) else value
    return F.count(F.when(cond, v))


def sum_where(cond: Column, value: Column | str, otherwise=None) -> Column:
    """``sum(case when cond then value [else otherwise] end)``."""
    v = F.col(value) if isinstance(value, str) else value
    e = F.when(cond, v)
    if otherwise is not None:
        e = e.otherwise(otherwise)
    return F.sum(e)
