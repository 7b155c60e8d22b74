"""Web-funnel analytics over an event log (visit, page, event type).

Distinct-visit counts under several conditions are computed by first
reducing the log to one row per (visit, key) carrying boolean flags, then
counting flags per key. That is two plain aggregations, both partially
aggregated map-side, instead of one ``Expand`` per ``count(distinct ...)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.functions.numeric import percent
from casebook.operators.agg import count_where
from casebook.operators.intervals import interval_join

VIEW, CART_ADD, PURCHASE, IMPRESSION, CLICK = 1, 2, 3, 4, 5
_BLOCK_BITS = 20  # sequence numbers of one piece of an ordered list: 2^20


def visit_flags(events: DataFrame, flags: dict[str, Column], by: tuple[str, ...] = ()) -> DataFrame:
    """One row per (visit_id, *by) with ``flags`` = bool_or(condition)."""
    return events.groupBy("visit_id", *by).agg(*[F.bool_or(c).alias(n) for n, c in flags.items()])


def share_of_visits(events: DataFrame, hit: dict[str, Column], out: str, combine=None) -> DataFrame:
    """Percent of visits for which ``combine(flags)`` holds (default: the
    single flag)."""
    f = visit_flags(events, hit)
    cond = combine(f) if combine else F.col(next(iter(hit)))
    return f.agg(percent(F.count_if(cond), F.count(F.lit(1))).alias(out))


def product_funnel(events: DataFrame, key: str, not_purchased_name: str) -> DataFrame:
    """Per ``key`` (product or category): visits with a purchase, a cart
    add, a view, and a cart add without a purchase of the same key.

    As in the study, "same key" is an equality test, so for the NULL key a
    cart add never finds its purchase and always counts as not purchased.
    """
    et = F.col("event_type")
    f = visit_flags(events, {"v": et == VIEW, "a": et == CART_ADD, "p": et == PURCHASE}, by=(key,))
    bought = F.col("p") & F.col(key).isNotNull()
    return f.groupBy(key).agg(
        F.count_if("p").alias("number_of_purchases"),
        F.count_if("a").alias("number_of_cart_addition"),
        F.count_if("v").alias("number_of_views"),
        F.count_if(F.col("a") & ~bought).alias(not_purchased_name))


def visit_summary(events: DataFrame, users: DataFrame, pages: DataFrame,
                  product_pages: tuple[int, int] = (3, 11)) -> DataFrame:
    """Per (visit, user): start time, event counts by type, purchase flag and
    the visit's cart-add products in event order (comma-separated, NULL when
    there are none)."""
    et = F.col("event_type")
    lo, hi = product_pages
    in_cart = (F.col("page_id") >= lo) & (F.col("page_id") <= hi) & (et == CART_ADD)
    joined = events.join(users, "cookie_id").join(pages, "page_id")
    # Ordered lists merge by blocks of the sequence: a block becomes one piece
    # of text, so a visit of very many cart adds is never one list of them.
    items = F.array_sort(F.collect_list(F.when(in_cart, F.struct(F.col("sequence_number").alias("s"), F.col("product_id").alias("p")))))
    pieces = joined.groupBy("visit_id", "user_id", F.shiftright(F.col("sequence_number").cast("bigint"), _BLOCK_BITS).alias("_block")).agg(
        F.min("event_time").alias("visit_start_time"),
        F.count("page_id").alias("page_views"),
        count_where(et == CART_ADD, et).alias("cart_adds"),
        F.max(F.when(et == PURCHASE, F.lit(1)).otherwise(F.lit(0))).alias("purchase"),
        count_where(et == IMPRESSION, et).alias("impressions"),
        count_where(et == CLICK, et).alias("click"),
        items.alias("_items"))
    piece = F.array_join(F.transform("_items", lambda x: x["p"].cast("string")), ",")
    pieces = pieces.select("*", F.when(F.size("_items") > 0, F.struct("_block", piece.alias("text"))).alias("_piece")).drop("_items")
    per = pieces.groupBy("visit_id", "user_id").agg(
        F.min("visit_start_time").alias("visit_start_time"),
        *[F.sum(c).alias(c) for c in ("page_views", "cart_adds")], F.max("purchase").alias("purchase"),
        *[F.sum(c).alias(c) for c in ("impressions", "click")], F.array_sort(F.collect_list("_piece")).alias("_pieces"))
    texts = F.filter(F.transform("_pieces", lambda x: x["text"]), lambda t: t != "")
    return per.withColumn("cart_products", F.when(F.size("_pieces") > 0, F.array_join(texts, ","))).drop("_pieces")


def attach_campaign(visits: DataFrame, campaigns: DataFrame, how: str = "inner") -> DataFrame:
    """Campaign(s) whose [start_date, end_date] contains the visit start."""
    return interval_join(visits, campaigns, "visit_start_time", "start_date", "end_date", how).drop("start_date", "end_date")


def product_funnel_by_visit_purchase(events: DataFrame, key: str, not_purchased_name: str) -> DataFrame:
    """Intended reading of the funnel: a product (or category) counts as
    bought in a visit when it was added to the cart in a visit that has any
    purchase event (purchases fire on a confirmation page, not on the
    product's own page). Keys are products only (no NULL key)."""
    et = F.col("event_type")
    bought_visit = visit_flags(events, {"vp": et == PURCHASE})
    per = visit_flags(events.where(F.col(key).isNotNull()),
                      {"v": et == VIEW, "a": et == CART_ADD}, by=(key,))
    f = per.join(bought_visit, "visit_id")
    bought = F.col("a") & F.col("vp")
    return f.groupBy(key).agg(
        F.count_if(bought).alias("number_of_purchases"),
        F.count_if("a").alias("number_of_cart_addition"),
        F.count_if("v").alias("number_of_views"),
        F.count_if(F.col("a") & ~F.col("vp")).alias(not_purchased_name))
