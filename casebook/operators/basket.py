"""Basket combinations: how often sets of three items share a basket.

A vertical bitmap index replaces the self-joins: for each item and bucket of
32768 baskets one bitmap says which baskets hold the item
(``bitmap_construct_agg``). The support of a set of items is the number of
bits in the intersection of their bitmaps, so no basket is ever expanded to
its pairs, and a basket of any size costs one bit per item.

The search is pruned a-priori style with an exact lower bound on the answer:

1. item supports;
2. the bound: the best triple count among the ``seed_items`` most frequent
   items. It is the count of a real triple, so the best triple overall has at
   least that count;
3. only items, then pairs with at least that support can be in such a triple;
4. triples of what is left, counted exactly.

A task streams its buckets one after another, adds the counts up and hands on
one row per set of items, so rows out do not grow with the buckets. What a
bucket holds in memory is one bitmap (4 KB) per frequent item.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

_MOST = 1 << 20  # sets whose counts a task holds before it hands them on


def numbered_baskets(items: DataFrame, basket: str, item: str) -> DataFrame:
    """(id, item) with baskets as integers that fill buckets densely: an
    integer key as it is, any other key by its rank within a hash bucket."""
    rows = items.select(F.col(basket).alias("basket"), F.col(item).alias("item")).dropna()
    if isinstance(rows.schema["basket"].dataType, IntegralType):
        return rows.select(F.col("basket").cast("bigint").alias("id"), "item")
    keys = rows.select("basket").distinct()
    buckets = keys.agg(F.greatest(F.lit(1), F.call_function("div", F.count(F.lit(1)), F.lit(16384)))).scalar()
    from pyspark.sql.window import Window
    placed = keys.withColumn("b", F.pmod(F.xxhash64("basket"), buckets)).withColumn(
        "r", F.row_number().over(Window.partitionBy("b").orderBy("basket")).cast("bigint") - 1)
    # 2^22 ranks a bucket: far beyond what a hash bucket of about 16384 holds
    return rows.join(placed, "basket").select((F.col("b") * (1 << 22) + F.col("r")).alias("id"), "item")


def basket_bitmaps(items: DataFrame, basket: str, item: str) -> DataFrame:
    """The vertical index: (bucket, item, bits)."""
    rows = numbered_baskets(items, basket, item)
    return rows.groupBy(F.bitmap_bucket_number("id").alias("bucket"), "item").agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """item -> (bitmap as 512 words, partners) of each bucket, in the order of
    the items. The rows come sorted by bucket and item."""
    at, held = None, {}
    for batch in batches:
        partners = batch.column("partners").to_pylist() if "partners" in batch.schema.names else [None] * batch.num_rows
        for bucket, item, bits, mates in zip(batch.column("bucket").to_pylist(), batch.column("item").to_pylist(), batch.column("bits"), partners):
            if bucket != at and held:
                yield held
                held = {}
            at = bucket
            held[item] = (np.frombuffer(bits.as_buffer(), np.uint64), mates)
    if held:
        yield held


def _pair_sums(batches: Iterator[pa.RecordBatch], emit: Callable) -> Iterator[pa.RecordBatch]:
    total: dict = {}
    for held in _by_bucket(batches):
        names = sorted(held)
        words = np.stack([held[n][0] for n in names])
        for i, a in enumerate(names):
            both = np.bitwise_count(words[i + 1:] & words[i]).sum(axis=1, dtype=np.int64)
            for j in np.flatnonzero(both):
                pair = (a, names[i + 1 + j])
                total[pair] = total.get(pair, 0) + int(both[j])
        if len(total) > _MOST:
            yield emit(total)
    if total:
        yield emit(total)


def _triple_sums(batches: Iterator[pa.RecordBatch], emit: Callable) -> Iterator[pa.RecordBatch]:
    """Partners are the later items of the frequent pairs; without the column,
    all later items are."""
    total: dict = {}
    for held in _by_bucket(batches):
        names = sorted(held)
        place = {n: i for i, n in enumerate(names)}
        words = np.stack([held[n][0] for n in names])
        later = [np.arange(i + 1, len(names)) if held[n][1] is None else np.array(sorted(place[m] for m in held[n][1] if m in place), np.int64)
                 for i, n in enumerate(names)]
        for i, a in enumerate(names):
            for j in later[i]:
                thirds = np.intersect1d(later[i][later[i] > j], later[j], assume_unique=True)
                both = words[i] & words[j]
                some = np.flatnonzero(both)
                if not len(thirds) or not len(some):
                    continue
                n = np.bitwise_count(words[np.ix_(thirds, some)] & both[some]).sum(axis=1, dtype=np.int64)
                for k in np.flatnonzero(n):
                    triple = (a, names[j], names[thirds[k]])
                    total[triple] = total.get(triple, 0) + int(n[k])
        if len(total) > _MOST:
            yield emit(total)
    if total:
        yield emit(total)


def _counted(index: DataFrame, size: int) -> DataFrame:
    """Sums of the sets of ``size`` items (i1 < i2 ...) over all buckets: n."""
    names = [f"i{k + 1}" for k in range(size)]
    sums = _pair_sums if size == 2 else _triple_sums

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(total: dict) -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([*[pa.array([s[k] for s in total]) for k in range(size)], pa.array(list(total.values()), pa.int64())],
                                             [*names, "n"])
            total.clear()
            return out
        return sums(batches, emit)

    kind = index.schema["item"].dataType.simpleString()
    part = index.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, ", ".join([*[f"{n} {kind}" for n in names], "n bigint"]))
    return part.groupBy(*names).agg(F.sum("n").alias("n"))


def triple_counts(items: DataFrame, basket: str, item: str, k: int = 1,
                  seed_items: int = 32) -> DataFrame:
    """All item triples (i1 < i2 < i3) whose basket count is at least the
    pruning bound, with ``combo_count``. The ``k`` most frequent triples and
    everything tied with them are always included."""
    index = basket_bitmaps(items, basket, item)
    support = index.groupBy("item").agg(F.sum(F.bitmap_count("bits")).alias("s"))

    # Items are unique below, so these inner joins filter; unlike semi-joins
    # they stay above the aggregate, and all uses of the index share one shuffle.
    # The k-th best seed triple count is a lower bound for the k-th best overall.
    seed = support.orderBy(F.desc("s"), F.asc("item")).limit(seed_items).withColumn("seeded", F.lit(True))
    seeds = index.join(F.broadcast(seed), "item").where("seeded").select("bucket", "item", "bits")     # at most seed_items items
    kth = (_counted(seeds, 3).orderBy(F.desc("n")).limit(k)
           .agg(F.when(F.count(F.lit(1)) >= k, F.min("n")).otherwise(F.lit(1)).alias("best")))
    bound = F.coalesce(kth.scalar(), F.lit(1))

    frequent = index.join(support.where(F.col("s") >= bound), "item").select("bucket", "item", "bits")
    pairs = _counted(frequent, 2).where(F.col("n") >= bound)
    partners = pairs.groupBy(F.col("i1").alias("item")).agg(F.collect_list("i2").alias("partners"))
    candidates = frequent.join(partners, "item", "left").withColumn(
        "partners", F.coalesce("partners", F.array().cast(partners.schema["partners"].dataType)))
    return _counted(candidates, 3).where(F.col("n") >= bound).select("i1", "i2", "i3", F.col("n").alias("combo_count"))


def most_common_triple(items: DataFrame, basket: str, item: str, k: int = 1) -> DataFrame:
    """Top-k triples by basket count; ties by item names ascending."""
    return (triple_counts(items, basket, item, k=k)
            .orderBy(F.desc("combo_count"), "i1", "i2", "i3").limit(k)
            .select(F.col("i1").alias("product_1"), F.col("i2").alias("product_2"),
                    F.col("i3").alias("product_3"), "combo_count"))
