"""Operator 12: interaction audit of filters, by sorted posting lists.

Every row gets the set of filters it fails. A partition's rows, numbered as
they come, are cut into id ranges; in each range and part the ids that fail a
filter form a sorted posting list. For each filter and each set of other
filters a galloping k-way merge finds the ids of the filter's list that are
on none of the other lists (the rows it removes after those filters), and
sizes are summed: rows, good and toxic ones. Unions follow from differences,
as |U with f| = |U| + |f without U|. Sums of ranges are added up by part, and
the 120 orders read their steps from them.

Ranges are made of rows, not of id values, so a hot part, source, text or id
is spread over all partitions. Rows look up their text's smallest id, and
their labels, by a join in which keys with over a thousandth of the rows (less
than 1000 of them) take a broadcast and the rest a shuffle.

Defined cases: a null text is empty, a null part the empty string. A null id
is neither smaller than any nor has smaller ones (it never fails E) and has
no label; each of repeated rows counts; rows with equal id and text are no
copies of each other. An id's label is 1 if any of its label rows says so. An
empty table has no parts and gives no rows. Other columns are not read; texts
are read whole and told apart by 128-bit hashes.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from bisect import bisect_left
from collections.abc import Iterator
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm._common import table, written

FILTERS = "ABCDE"
RANGE = 1 << 16  # rows of an id range
HOT = 1000  # a key with over 1/HOT of the rows is looked up by broadcast
_MARKS = re.compile(rb"[#$%&*|]")
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))


def text_fails(text: str) -> int:
    """Bits of the filters A to D that the text fails."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at space and 0x09-0x0D, nothing else
    n = len(words)
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    return ((n < 100) | (100 * len(set(words)) < 80 * n) << 1 | (100 * capitals > 10 * len(text)) << 2
            | (_MARKS.search(raw) is not None) << 3)


def _flagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fails, keys = [], []
        for text in batch.column("text"):
            text = text.as_py() or ""
            fails.append(text_fails(text))
            keys.append(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("part"), pa.array(fails, pa.int32()), pa.array(keys)],
                                         ["id", "part", "fails", "text_key"])


def _looked_up(rows: DataFrame, small: DataFrame, key: str, rows_total: int) -> DataFrame:
    """``rows`` left joined with ``small`` (one row per ``key``)."""
    hot = [r[0] for r in rows.where(F.col(key).isNotNull()).groupBy(key).count().where(F.col("count") * HOT > rows_total).select(key).collect()]
    none = rows.where(F.col(key).isNull()).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in small.schema.fields if f.name != key])
    few = rows.where(~F.col(key).isin(hot) if hot else F.col(key).isNotNull()).join(small, key, "left")
    out = few.unionByName(none)
    if hot:
        out = out.unionByName(rows.where(F.col(key).isin(hot)).join(F.broadcast(small.where(F.col(key).isin(hot))), key, "left"))
    return out


def failing_rows(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", part_col: str = "lang") -> DataFrame:
    """(part, fails, good, toxic) of each row; bit i of ``fails`` is filter i."""
    kind = docs.schema[id_col].dataType.simpleString()
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.col(text_col).alias("text"))
    rows = written(base.mapInArrow(_flagged, f"id {kind}, part string, fails int, text_key string"), "fails")
    total = rows.count()
    firsts = rows.groupBy("text_key").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").select("text_key", "first")
    rows = _looked_up(rows, firsts, "text_key", total)
    rows = rows.withColumn("fails", F.col("fails") + F.when(F.col("id") > F.col("first"), 16).otherwise(0)).drop("first", "text_key")
    marked = labels.where("quality = 1 or toxic = 1").groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    return _looked_up(rows, marked, "id", total).select(
        "part", "fails", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


def gallop(ids: list[int], at: int, x: int) -> int:
    """The first place from ``at`` on whose id is at least ``x``: steps double
    until they pass it, a binary search ends it."""
    n, step, high = len(ids), 1, at
    while high < n and ids[high] < x:
        at = high + 1
        high += step
        step *= 2
    return bisect_left(ids, x, at, min(high, n))


def without(own: list[int], others: list[list[int]]) -> list[tuple[int, int]]:
    """The stretches (start, end) of ``own`` whose ids are on no other list."""
    heads = [[0, ids] for ids in others if ids]
    out, i, n = [], 0, len(own)
    while i < n:
        x, nearest = own[i], None
        for head in heads:
            at = head[0] = gallop(head[1], head[0], x)
            if at < len(head[1]) and (nearest is None or head[1][at] < nearest):
                nearest = head[1][at]
                if nearest == x:
                    break
        if nearest is None:
            out.append((i, n))
            break
        if nearest == x:
            i += 1
            continue
        end = gallop(own, i, nearest)
        out.append((i, end))
        i = end
    return out


def slot(f: int, before: int) -> int:
    """Place in the sums of the rows that filter ``f`` removes after the set ``before``."""
    return 1 + 3 * (f * 32 + before)


_SLOTS = slot(4, 31) + 3


def range_sums(fails: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """The sums of one part's rows in an id range: [rows, then (rows, good,
    toxic) that each filter removes after each set of others]."""
    sums = np.zeros(_SLOTS, np.int64)
    sums[0] = len(fails)
    lists = [np.flatnonzero(fails >> f & 1) for f in range(5)]
    plain = [ids.tolist() for ids in lists]
    for f in range(5):
        if not plain[f]:
            continue
        marks = [np.concatenate([[0], np.cumsum(m[lists[f]])]) for m in (good, toxic)]
        for before in range(32):
            if before >> f & 1:
                continue
            left = without(plain[f], [plain[g] for g in range(5) if before >> g & 1])
            at = slot(f, before)
            sums[at] = sum(b - a for a, b in left)
            for k, m in enumerate(marks):
                sums[at + 1 + k] = sum(int(m[b] - m[a]) for a, b in left)
    return sums


def _range_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(totals), pa.string()), pa.array([v.tolist() for v in totals.values()], pa.list_(pa.int64()))],
                                         ["part", "sums"])
        totals.clear()
        return out

    def add(rows: list[pa.RecordBatch]) -> None:
        t = pa.Table.from_batches(rows)
        coded = t.column("part").combine_chunks().dictionary_encode()
        codes = coded.indices.to_numpy()
        fails, good, toxic = (t.column(c).to_numpy() for c in ("fails", "good", "toxic"))
        order = np.argsort(codes, kind="stable")
        for ids in np.split(order, np.flatnonzero(np.diff(codes[order])) + 1):
            part = coded.dictionary[int(codes[ids[0]])].as_py()
            sums = range_sums(fails[ids], good[ids], toxic[ids])
            totals[part] = totals[part] + sums if part in totals else sums

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= RANGE:
            add(held)
            held = []
        if len(totals) > 1000:
            yield flush()
    if held:
        add(held)
    if totals:
        yield flush()


def _steps() -> Column:
    """All orders with, for each step, the filter and the places in the sums;
    one literal, as the plan would grow with hundreds of them."""
    out = []
    for order in itertools.permutations(range(5)):
        before, done = 0, []
        for step, f in enumerate(order, 1):
            done.append(slot(f, before))
            out.append({"filter_order": "".join(FILTERS[g] for g in order), "step": step, "f": f, "at": done[-1], "done": list(done),
                        "alone": slot(f, 0), "only": slot(f, 31 ^ 1 << f)})
            before |= 1 << f
    return F.from_json(F.lit(json.dumps(out)), "array<struct<filter_order:string,step:int,f:int,at:int,done:array<int>,alone:int,only:int>>")


def audit(rows: DataFrame) -> DataFrame:
    """The report over (part, fails, good, toxic) rows: one row per part,
    order of the filters and step."""
    sums = rows.mapInArrow(_range_sums, "part string, sums array<long>")
    added = (sums.select("part", F.posexplode("sums").alias("i", "v")).groupBy("part", "i").agg(F.sum("v").alias("v"))
             .groupBy("part").agg(F.sort_array(F.collect_list(F.struct("i", "v"))).alias("s")).select("part", F.col("s.v").alias("s")))
    weights = [[(slot(f, before), factorial(before.bit_count()) * factorial(4 - before.bit_count())) for before in range(32) if not before >> f & 1]
               for f in range(5)]
    shapley = F.array(*[sum((F.get("s", F.lit(at)) * w for at, w in per), F.lit(0)) for per in weights])
    flat = added.select("part", "s", shapley.alias("shapley"), F.explode(_steps()).alias("o"))

    def at(name: str, extra: int = 0) -> Column:
        return F.get("s", F.col(f"o.{name}") + extra)
    gone = F.aggregate("o.done", F.lit(0).cast("long"), lambda acc, i: acc + F.get("s", i))
    return flat.select("part", "o.filter_order", "o.step", (F.get("s", F.lit(0)) - gone).alias("kept"), at("at").alias("removed"),
                       (at("alone") - at("at")).alias("redundant"), at("only").alias("unique_fails"), at("at", 1).alias("good_lost"),
                       at("at", 2).alias("toxic_lost"), F.get("shapley", F.col("o.f")).alias("shapley"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(failing_rows(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


ORACLE_SQL = r"""
with d as (select coalesce(lang, '') as part, doc_id, coalesce(text, '') as t from documents),
firsts as (select t, min(doc_id) as first_id from d group by t),
lab as (select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
        from labels group by doc_id),
w as (select d.*, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws from d),
m as (select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
        (case when len(ws) < 100 then 1 else 0 end)
        + (case when 100 * len(list_distinct(ws)) < 80 * len(ws) then 2 else 0 end)
        + (case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) then 4 else 0 end)
        + (case when regexp_matches(t, '[#$%&*|]') then 8 else 0 end)
        + (case when doc_id > first_id then 16 else 0 end) as bits
      from w join firsts using (t) left join lab using (doc_id)),
c as (select part, bits, count(*) as n, sum(good) as good, sum(toxic) as toxic from m group by part, bits),
letters(l, bit) as (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders as (select a.l || b.l || c.l || d.l || e.l as filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] as bits_of
           from letters a, letters b, letters c, letters d, letters e
           where a.bit + b.bit + c.bit + d.bit + e.bit = 31 and a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps as (select filter_order, k as step, bits_of[k] as own, list_sum(list_concat([0], bits_of[1:k - 1]))::int as seen
          from orders, (select unnest([1, 2, 3, 4, 5]) as k)),
r as (select part, filter_order, step, own,
        sum(case when bits & (own | seen) = 0 then n else 0 end) as kept,
        sum(case when bits & own != 0 and bits & seen = 0 then n else 0 end) as removed,
        sum(case when bits & own != 0 and bits & seen != 0 then n else 0 end) as redundant,
        sum(case when bits = own then n else 0 end) as unique_fails,
        sum(case when bits & own != 0 and bits & seen = 0 then good else 0 end) as good_lost,
        sum(case when bits & own != 0 and bits & seen = 0 then toxic else 0 end) as toxic_lost
      from c cross join steps group by part, filter_order, step, own)
select part, filter_order, step::int as step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
       unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
       (sum(removed) over (partition by part, own))::bigint as shapley
from r
"""
