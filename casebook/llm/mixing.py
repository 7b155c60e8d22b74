"""Operator 9: mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in a shuffled (hash) order, the queue
repeated ``max_repeat`` times. A document's virtual finish time is the
cumulative size of its queue up to and including it, divided by the source's
target. All queues are merged by finish time and the merged order is cut at
the total budget.

Nothing is summed in one task. Running sums are taken in two levels: sums per
(source, leading hex digits of the shuffle key), a running sum over those few
sums, and a window inside each such bucket. The cut is found the same way:
sums per finish-time bucket, then a window over the one bucket in which the
budget ends. A source that holds a third of the rows is spread over all its
key buckets, and so is a null or repeated id: the key is a hash of id and text.

Defined cases: a null text has size 0; a null source is a source of its own,
ordered last; a null id hashes like the empty string; rows that repeat id and
text each count as a document, and which of them is taken is told by their
``keep`` columns, so reruns agree in whatever they carry; documents of size 0 are never taken; an empty
table gives an empty result. Extra columns are carried only if named in
``keep``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casebook.llm._common import checkpointed, table

WORD = r"[^\x20\x09-\x0D]+"
_FINISH_BUCKETS = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=(5, 2, 1), share: float = 1.5,
                   max_repeat: int = 2) -> DataFrame:
    """Targets per source from ``sizes`` (source, source_size): weights repeat
    over the sources by code point (null last); ``share`` of all sizes is
    shared by weight; a target stops at ``max_repeat`` times the source's
    size and the excess is reshared. One row per source.

    The shares are the water level ``min(cap, level * weight)``. With sources
    sorted by cap / weight, the level is the largest of (budget - caps
    before) / (weights from here on). The windows run over one row a source.
    """
    every = Window.partitionBy()
    ranked = sizes.select(
        "source", "source_size",
        (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1).alias("i"))
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), (F.col("i") % len(weights) + 1).cast("int"))
    order = Window.orderBy("ratio", "i").rowsBetween(Window.unboundedPreceding, -1)
    t = (ranked.withColumn("w", w)
         .withColumn("cap", F.col("source_size") * max_repeat)
         .withColumn("ratio", F.col("cap") / F.col("w"))
         .withColumn("budget", F.lit(float(share)) * F.sum("source_size").over(every))
         .withColumn("caps_before", F.coalesce(F.sum("cap").over(order), F.lit(0)))
         .withColumn("w_from", F.sum("w").over(every) - F.coalesce(F.sum("w").over(order), F.lit(0)))
         .withColumn("level", F.max((F.col("budget") - F.col("caps_before")) / F.col("w_from")).over(every)))
    return t.select("source", "source_size", "budget",
                    F.least(F.col("cap").cast("double"), F.col("level") * F.col("w")).alias("target"))


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def _finish(p: int) -> Column:
    """Virtual finish time in the p-th turn (0, 1, ...) of the queue."""
    return F.when(F.col("target") > 0, (F.col("source_size") * p + F.col("upto")) / F.col("target")).otherwise(F.lit(0.0))


def _bucket(t: Column) -> Column:
    return F.least(F.floor(t * _FINISH_BUCKETS), F.lit(2 * _FINISH_BUCKETS)).cast("int")


def mix_sources(docs: DataFrame, weights=(5, 2, 1), share: float = 1.5, max_repeat: int = 2,
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                keep: tuple[str, ...] = ()) -> DataFrame:
    """The documents with what the mix takes of each: id, size, source_size,
    target, taken (size times the turns taken) and the columns in ``keep``."""
    def rows(extra=()):
        return docs.select(
            F.col(id_col).alias("doc_id"), _key(F.col(source_col)).alias("sk"),
            word_count(F.col(text_col)).alias("size"),
            F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(F.col(text_col), F.lit(""))))).alias("key"),
            *[F.col(c).alias(f"keep_{c}") for c in extra])

    thin = checkpointed(rows())
    n = thin.count()
    digits = max(2, math.ceil(math.log(max(n, 1) / 2000 + 1, 16)))
    part = F.substring("key", 1, digits)
    sums = thin.groupBy("sk", part.alias("kb")).agg(F.sum("size").alias("in_bucket"))
    sums = checkpointed(sums)
    sizes = sums.groupBy("sk").agg(F.sum("in_bucket").alias("source_size"))
    # 's' + name sorts like the name; 'n' (null) must come last
    sizes = sizes.select(F.when(F.col("sk") != "n", F.col("sk")).alias("source"), "source_size")
    targets = checkpointed(source_targets(sizes, weights, share, max_repeat))
    targets = targets.select(F.coalesce("source", F.lit("n")).alias("sk"), "source_size", "target", "budget")
    before = Window.partitionBy("sk").orderBy("kb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (sums.withColumn("start", F.coalesce(F.sum("in_bucket").over(before), F.lit(0)))
               .join(targets, "sk").drop("in_bucket", "budget"))

    def queued(frame: DataFrame) -> DataFrame:
        # rows of one key differ in kept columns at most; these break the tie
        kept = [c for c in frame.columns if c.startswith("keep_")]
        inside = (Window.partitionBy("sk", "kb").orderBy("key", "doc_id", "size", *kept)
                  .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return (frame.withColumn("kb", part).join(offsets, ["sk", "kb"])
                .withColumn("upto", F.col("start") + F.sum("size").over(inside)))

    def place(p: int) -> Column:
        return F.struct(_finish(p).alias("t"), F.col("sk"), F.lit(p).alias("p"), F.col("key"),
                        F.col("doc_id"), F.col("size"))

    turns = (checkpointed(queued(thin).where("size > 0"))
             .withColumn("place", F.explode(F.array(*[place(p) for p in range(max_repeat)])))
             .select("place", _bucket(F.col("place.t")).alias("fb")))
    # at most 2 * _FINISH_BUCKETS + 1 rows
    by_finish = turns.groupBy("fb").agg(F.sum("place.size").alias("words"))
    upto = by_finish.withColumn("cum", F.sum("words").over(Window.orderBy("fb")))
    budget = float(targets.agg(F.max("budget")).first()[0] or 0.0)
    edge = upto.where(F.col("cum") > budget).orderBy("fb").select("fb", "cum", "words").first()
    if edge is None:
        last, cut = 2 * _FINISH_BUCKETS + 1, None
    else:
        last, left = edge["fb"], budget - (edge["cum"] - edge["words"])
        order = Window.partitionBy("fb").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        got = (turns.where(F.col("fb") == last).withColumn("run", F.sum("place.size").over(order))
               .where(F.col("run") <= left).agg(F.max("place").alias("cut")))
        cut = checkpointed(got)  # one row

    out = queued(rows(keep) if keep else thin)
    if cut is not None:
        out = out.crossJoin(F.broadcast(cut))  # a single row
    def takes(p: int) -> Column:
        b = _bucket(_finish(p))
        at_edge = F.coalesce((b == last) & (place(p) <= F.col("cut")), F.lit(False)) if cut is not None else F.lit(False)
        return ((b < last) | at_edge).cast("long")
    turns_taken = sum((takes(p) for p in range(1, max_repeat)), takes(0))
    return out.select("doc_id", "size", "source_size", F.col("target").cast("double").alias("target"),
                      (F.col("size") * turns_taken).alias("taken"),
                      *[F.col(f"keep_{c}").alias(c) for c in keep if c != id_col])


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


_RE = r"[^\x20\x09-\x0D]+"
ORACLE_SQL = rf"""
with d as (
  select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '{_RE}')), 0) as bigint) as size,
         md5(coalesce(cast(doc_id as varchar), '') || ':' || md5(coalesce(text, ''))) as key, row_number() over () as rn
  from documents),
s as (
  select source, cast(sum(size) as bigint) as source_size,
         row_number() over (order by source nulls last) - 1 as i
  from d group by source),
w as (select *, case i % 3 when 0 then 5 when 1 then 2 else 1 end as w from s),
l as (
  select *, (1.5::double * (sum(source_size) over ())::double
             - coalesce(sum(2 * source_size) over before, 0)::double)
            / (sum(w) over () - coalesce(sum(w) over before, 0))::double as lev
  from w window before as (order by (2 * source_size)::double / w, i rows between unbounded preceding and 1 preceding)),
t as (
  select source, source_size, least((2 * source_size)::double, (max(lev) over ()) * w) as target,
         1.5::double * (sum(source_size) over ())::double as budget, coalesce('s' || source, 'n') as sk from l),
q as (
  select d.*, t.source_size, t.target, t.budget, t.sk,
         sum(d.size) over (partition by t.sk order by d.key, d.doc_id, d.size rows unbounded preceding) as upto
  from d join t on d.source is not distinct from t.source),
turns as (
  select *, case when target > 0 then (source_size * p + upto)::double / target else 0 end as f
  from q, (values (0), (1)) as turn(p) where size > 0),
kept as (
  select rn, size, sum(size) over (order by f, sk, p, key, doc_id, size rows unbounded preceding) <= budget as ok
  from turns),
per as (select rn, sum(case when ok then size else 0 end) as taken from kept group by rn)
select q.doc_id, q.size, q.source_size, q.target, cast(coalesce(per.taken, 0) as bigint) as taken
from q left join per using (rn)
"""
