"""Interval joins: each point with the intervals that contain it.

The calendar is cut into cells of 1, 32, 1024, ... days. An interval is
covered by the largest cells that fit, at most 62 a level, so its rows grow with
the logarithm of its length: one to 9999-12-31 takes about a hundred, not
millions. The cells of an interval don't overlap, so a point meets each
interval at most once: it looks up its own cell at each level, and the exact
bounds decide. Points are never repeated, whatever the intervals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BITS = 5      # a cell holds 32 of the level below
LEVELS = 5     # cells of 1 day to 2^20 days, a few of which span all dates


def _run(first: Column, last: Column, level: int) -> Column:
    """Cells first..last of a level; none if first > last."""
    cells = F.transform(F.sequence(first, last), lambda c: F.struct(F.lit(level).alias("level"), c.alias("cell")))
    return F.when(first <= last, cells).otherwise(F.array().cast("array<struct<level:int,cell:bigint>>"))


def cover(first_day: Column, last_day: Column) -> Column:
    """The fewest aligned cells whose days are ``first_day`` to ``last_day``
    (dates, both included): array of (level, cell)."""
    a, b = F.unix_date(first_day).cast("bigint"), F.unix_date(last_day).cast("bigint")
    parts = []
    for level in range(LEVELS):
        size = _BITS * level
        # the whole cells of this level, and of the next, inside the interval
        low, high = -F.shiftright(-a, size), F.shiftright(b + 1, size) - 1
        if level == LEVELS - 1:
            parts.append(_run(low, high, level))
            continue
        up_low, up_high = -F.shiftright(-a, size + _BITS), F.shiftright(b + 1, size + _BITS) - 1
        none_above = up_low > up_high
        parts.append(F.when(none_above, _run(low, high, level)).otherwise(F.concat(
            _run(low, F.shiftleft(up_low, _BITS) - 1, level), _run(F.shiftleft(up_high + 1, _BITS), high, level))))
    return F.when(a.isNotNull() & b.isNotNull(), F.concat(*parts))


def interval_join(points: DataFrame, intervals: DataFrame, at: str, start: str, end: str, how: str = "inner") -> DataFrame:
    """``points`` with the columns of each of ``intervals`` whose ``start`` <=
    ``at`` <= ``end`` (timestamps or dates); with ``how="left"`` points in no
    interval stay, with NULLs. An interval with a NULL bound contains nothing."""
    if how not in ("inner", "left"):
        raise ValueError(f"interval_join does inner and left joins, not {how}")
    cells = intervals.select(F.struct(*intervals.columns).alias("_iv"), F.explode(cover(F.to_date(start), F.to_date(end))).alias("_c"))
    out = points.withColumn("_day", F.unix_date(F.to_date(at)).cast("bigint"))
    for level in range(LEVELS):
        own = cells.where(F.col("_c.level") == level).groupBy(F.col("_c.cell").alias("_cell")).agg(F.collect_list("_iv").alias(f"_at{level}"))
        out = out.join(own, F.shiftright("_day", _BITS * level) == F.col("_cell"), "left").drop("_cell")
    none = F.array().cast(f"array<{cells.schema['_iv'].dataType.simpleString()}>")
    near = F.concat(*[F.coalesce(F.col(f"_at{level}"), none) for level in range(LEVELS)])
    hits = F.filter(near, lambda iv: (F.col(at) >= iv[start]) & (F.col(at) <= iv[end]))
    one = (F.explode_outer if how == "left" else F.explode)(hits).alias("_hit")
    return out.select(*points.columns, one).select(*points.columns, *[F.col(f"_hit.{c}").alias(c) for c in intervals.columns])
