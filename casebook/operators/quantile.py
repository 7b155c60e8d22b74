"""Exact ordinal percentiles without a sorted single partition.

``row_number() over (order by v)`` (or ``partition by g`` with a few large
groups) sorts every row of a group in one task. ``ordinal_pick`` returns the
same value, the one at a given 1-based rank of the ascending order:

1. cut the value axis into chunks by an order-preserving expression of the
   value (its sign and 1/1024 octaves of its size), so a hot group is spread
   over many tasks and a heavy tail over few chunks; the chunk is a function
   of the value, so no ranges are sampled and nothing is written in between;
2. count rows per (group, chunk), combined map-side: this first pass sends a
   few thousand counts, however many values there are. Running sums over them
   give each chunk's rank offset and the chunks that hold a wanted rank;
3. a second pass reads only the values of those chunks, collapses equal ones
   to (value, multiplicity), and ranks them by a running sum, a chunk a task.

Input values must be non-NULL.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

RankFn = Callable[[Column], Column]


def rank_floor(num: int, den: int) -> RankFn:
    """rank = floor(n * num / den), integer arithmetic."""
    return lambda n: _idiv(n * num, den)


def rank_ceil(num: int, den: int) -> RankFn:
    """rank = ceil(n * num / den), integer arithmetic."""
    return lambda n: _idiv(n * num + (den - 1), den)


def _idiv(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b))


def value_chunk(v: Column) -> Column:
    """A long that never decreases with the numeric ``v``; equal values have
    equal chunks."""
    d = v.cast("double")
    size = F.floor(F.log2(F.abs(d)) * 1024) + (1 << 21)
    return F.when(d == 0, F.lit(0)).otherwise(F.signum(d).cast("bigint") * size).cast("bigint")


def ordinal_pick(df: DataFrame, value: str, picks: dict[str, RankFn],
                 by: Sequence[str] = ()) -> DataFrame:
    """For each group of ``by``: columns ``picks`` holding the value at rank
    ``picks[name](n)`` (n = rows in the group), or NULL when that rank is
    below 1 or above n."""
    by = list(by)
    names = list(picks)
    # the group is carried as one struct column: struct equality is
    # null-safe, so a NULL group key joins back to itself like any other
    gk = F.struct(*[F.col(b) for b in by]) if by else F.lit(0)
    keys = ["_gk"]
    ranged = df.select(gk.alias("_gk"), F.col(value).alias("_v"), value_chunk(F.col(value)).alias("_chunk"))

    # chunk offsets within each group (rows: groups + chunks)
    wc = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, 0)
    chunks = (ranged.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_cc"))
              .withColumn("_end", F.sum("_cc").over(wc))
              .withColumn("_start", F.col("_end") - F.col("_cc")))
    sizes = chunks.groupBy(*keys).agg(F.max("_end").alias("_n"))
    targets = sizes.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(nm).alias("name"), picks[nm](F.col("_n")).alias("r")) for nm in names
    ])).alias("_t")).select(*keys, F.col("_t.name").alias("_name"), F.col("_t.r").alias("_r"))
    located = targets.join(chunks, keys).where(
        (F.col("_r") > F.col("_start")) & (F.col("_r") <= F.col("_end"))).select(
        *keys, "_name", "_r", "_chunk", "_start")

    # exact ranks inside the few chunks that hold a target
    wv = Window.partitionBy(*keys, "_chunk").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (ranged.join(located.select(*keys, "_chunk").distinct(), keys + ["_chunk"], "left_semi")
              .groupBy(*keys, "_chunk", "_v").agg(F.count(F.lit(1)).alias("_c"))
              .withColumn("_cend", F.sum("_c").over(wv)))
    hits = ranked.join(located, keys + ["_chunk"]).where(
        (F.col("_r") > F.col("_start") + F.col("_cend") - F.col("_c"))
        & (F.col("_r") <= F.col("_start") + F.col("_cend")))
    picked = hits.groupBy(*keys).agg(*[F.max(F.when(F.col("_name") == nm, F.col("_v"))).alias(nm) for nm in names])
    out = sizes.select(*keys).join(picked, keys, "left")
    return out.select(*[F.col(f"_gk.{b}").alias(b) for b in by], *names)
