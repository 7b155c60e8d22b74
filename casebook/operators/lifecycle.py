"""Subscription lifecycle over a state-change log (key, state, start_date)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.functions.numeric import int_div
from casebook.operators.agg import count_where
from casebook.operators.rank import first_per
from casebook.operators.sequence import neighbor, neighbors

KEY, STATE, START = "customer_id", "plan_id", "start_date"
ORDER = [START, STATE]          # ties on the date are broken by the plan id


def with_next_state(log: DataFrame, out: str = "next_plan") -> DataFrame:
    """Each row plus the customer's next plan (``lead``), NULL on the last."""
    return neighbor(log, [KEY], ORDER, STATE, out, "next")


def with_prev_state(log: DataFrame, out: str = "prev_plan") -> DataFrame:
    """Each row plus the customer's previous plan (``lag``), NULL on the first."""
    return neighbor(log, [KEY], ORDER, STATE, out, "prev")


def latest_state(log: DataFrame, before: dt.date | None = None, inclusive: bool = False) -> DataFrame:
    """Each customer's latest row, optionally only among rows before
    ``before`` (on or before when ``inclusive``)."""
    if before is not None:
        c = F.col(START) <= F.lit(before) if inclusive else F.col(START) < F.lit(before)
        log = log.where(c)
    return first_per(log.select(KEY, START, STATE), [KEY], ORDER, descending=True)


def pivot_counts(df: DataFrame, col: str, values: Sequence[int], name: str, counted: str = KEY) -> DataFrame:
    """One row: ``count(case when col = v then counted end)`` per value."""
    return df.agg(*[count_where(F.col(col) == v, counted).alias(name.format(v)) for v in values])


def days_to_state(log: DataFrame, target: int) -> DataFrame:
    """For every row in state ``target``: days since the customer's first row."""
    first = log.groupBy(KEY).agg(F.min(START).alias("date_of_join"))
    hit = log.where(F.col(STATE) == target).select(KEY, F.col(START).alias("date_of_upgrade"))
    return first.join(hit, KEY).select(
        KEY, F.datediff("date_of_upgrade", "date_of_join").alias("days"))


def day_bin(days: Column, width: int) -> Column:
    """0-based bin index of a day count in bins of ``width`` days."""
    return int_div(days, F.lit(width))


def payment_schedule(log: DataFrame, plans: DataFrame, period_start: dt.date, period_end: dt.date,
                     monthly: Sequence[int], annual: Sequence[int], upgrade_from: int,
                     upgrade_credit: Column) -> DataFrame:
    """Payments dated in [period_start, period_end).

    A monthly plan pays on its start day every month until the customer's
    next plan starts; an annual plan pays once, at its start; the first
    payment of a plan that follows ``upgrade_from`` is reduced by
    ``upgrade_credit``; churn (no price) ends payments. Identical plan rows
    (same customer, day and plan) are one subscription event.

    Each plan row expands to the month offsets between the period's start and
    the row's own end (its next plan or the period's end), so the output grows
    with rows x months of the period only."""
    d = log.select(KEY, START, STATE).distinct().withColumn("_s", F.struct(START, STATE))
    d = (neighbors(d, [KEY], ORDER, "_s", next_out="_nx", prev_out="_pv")
         .withColumn("_next_start", F.col(f"_nx.{START}")).withColumn("_prev_plan", F.col(f"_pv.{STATE}")))
    end = F.least(F.coalesce(F.col("_next_start"), F.lit(period_end)), F.lit(period_end))
    # first month offset that can fall in the period (integer month arithmetic)
    lag_months = ((F.lit(period_start.year) - F.year(START)) * 12 + F.lit(period_start.month) - F.month(START))
    k0 = F.greatest(F.lit(0), lag_months - 1)
    # and the last: the calendar months from the row's start to its end
    k1 = (F.year(end) - F.year(START)) * 12 + F.month(end) - F.month(START)
    paid = d.where(F.col(STATE).isin(*monthly, *annual)).where(k1 >= k0).select(
        "*", F.explode(F.sequence(k0, k1)).alias("_k"))
    due = paid.withColumn("payment_date", F.add_months(F.col(START), F.col("_k"))).where(
        (F.col("payment_date") < end) & (F.col("payment_date") >= F.lit(period_start))
        & (F.col(STATE).isin(*monthly) | (F.col("_k") == 0)))
    first_after_upgrade = (F.col("_k") == 0) & (F.col("_prev_plan") == upgrade_from)
    amount = F.when(first_after_upgrade, F.col("price") - upgrade_credit).otherwise(F.col("price"))
    return due.join(plans, STATE).select(
        KEY, STATE, "plan_name", "payment_date", amount.cast("decimal(6,2)").alias("amount"))
