"""Loyalty points and price-list revenue (weighted sums over purchases)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def points_by_product(purchases: DataFrame, special: str, base: int = 10, bonus: int = 20) -> DataFrame:
    """Per customer: ``base`` points per unit of price, ``bonus`` for the
    ``special`` product name. Amounts are summed per (customer, product name)
    first, then weighted (the study's two-level form).

    ``purchases``: customer_id, product_name, price.
    """
    per = purchases.groupBy("customer_id", "product_name").agg(F.sum("price").alias("amount_spent"))
    w = F.when(F.col("product_name") == special, F.lit(bonus)).otherwise(F.lit(base))
    return per.groupBy("customer_id").agg(F.sum(w * F.col("amount_spent")).alias("points"))


def points_member_split(purchases: DataFrame, special: str, base: int = 10, bonus: int = 20) -> DataFrame:
    """As written in the study: amounts before and on/after ``join_date`` per
    (customer, product name); before joining ``base`` (``bonus`` for the
    special product), from joining on ``bonus`` for everything.

    ``purchases``: customer_id, product_name, price, order_date, join_date.
    """
    before = F.col("order_date") < F.col("join_date")
    per = purchases.groupBy("customer_id", "product_name").agg(
        F.sum(F.when(before, F.col("price")).otherwise(F.lit(0))).alias("b"),
        F.sum(F.when(~before, F.col("price")).otherwise(F.lit(0))).alias("a"))
    pts = F.when(F.col("product_name") == special, F.col("b") * bonus + F.col("a") * bonus).otherwise(
        F.col("b") * base + F.col("a") * bonus)
    return per.groupBy("customer_id").agg(F.sum(pts).alias("points"))


def points_join_week(purchases: DataFrame, special: str, cutoff: dt.date, days: int = 7,
                     base: int = 10, bonus: int = 20) -> DataFrame:
    """Intended reading: ``bonus`` on everything during the first ``days``
    days from ``join_date`` (inclusive), otherwise ``base`` (``bonus`` for
    the special product); only purchases up to ``cutoff``."""
    in_week = (F.col("order_date") >= F.col("join_date")) & (
        F.col("order_date") <= F.date_add(F.col("join_date"), days - 1))
    w: Column = F.when(in_week | (F.col("product_name") == special), F.lit(bonus)).otherwise(F.lit(base))
    return (purchases.where(F.col("order_date") <= F.lit(cutoff))
            .groupBy("customer_id").agg(F.sum(w * F.col("price")).alias("points")))


def price_list_revenue(lines: DataFrame, key: str, prices: dict, default_price: int) -> Column:
    """Helper expression: fixed price per product id, ``default_price`` for
    every other id."""
    e = None
    for k, p in prices.items():
        e = (F.when if e is None else e.when)(F.col(key) == k, F.lit(p))
    return e.otherwise(F.lit(default_price))
