"""Account ledgers: signed amounts, monthly flows, running and month-end balances.

Running sums are windows over *monthly aggregates*: a customer has at most
one row per calendar month there, so a window partition is bounded by the
calendar span, not by how many transactions the customer has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

KEY, DATE, TYPE, AMOUNT = "customer_id", "txn_date", "txn_type", "txn_amount"
CREDIT, DEBITS = "deposit", ("purchase", "withdrawal")


def signed_amount(credit: str = CREDIT) -> Column:
    """Amount with its sign: credits positive, everything else negative."""
    return F.when(F.col(TYPE) == credit, F.col(AMOUNT)).otherwise(-F.col(AMOUNT))


def monthly_flows(txns: DataFrame, month: Column, zero_fill: bool) -> DataFrame:
    """Per (customer, month): summed deposit, purchase and withdrawal.

    ``zero_fill=False`` keeps the study's first form, where a month without
    a given type has NULL for it; ``True`` is its second form (ELSE 0)."""
    def part(t):
        e = F.when(F.col(TYPE) == t, F.col(AMOUNT))
        return F.sum(e.otherwise(F.lit(0)) if zero_fill else e).alias(t)
    return txns.groupBy(KEY, month.alias("month")).agg(part(CREDIT), *[part(t) for t in DEBITS])


def running_balance(flows: DataFrame, out: str = "left_over") -> DataFrame:
    """``sum(deposit - coalesce(purchase,0) - coalesce(withdrawal,0))`` over
    the customer's months in order (default RANGE frame: NULL terms skipped)."""
    w = Window.partitionBy(KEY).orderBy("month")
    net = F.col(CREDIT) - F.coalesce(F.col(DEBITS[0]), F.lit(0)) - F.coalesce(F.col(DEBITS[1]), F.lit(0))
    return flows.withColumn(out, F.sum(net).over(w))


def month_end_balances(txns: DataFrame) -> DataFrame:
    """Closing balance of every customer at the end of every month, from the
    customer's first active month to the last month in the ledger (months
    with no transaction carry the previous balance).

    A month with transactions is repeated up to the month before the customer's
    next one: no calendar is built beside the ledger and nothing is joined
    back; the customer's rows are shuffled once, as monthly sums."""
    m = F.trunc(F.col(DATE), "month")
    flows = txns.where(F.col(DATE).isNotNull()).groupBy(KEY, m.alias("month")).agg(F.sum(signed_amount()).alias("net"))
    last = txns.agg(F.max(F.trunc(F.col(DATE), "month"))).scalar()
    w = Window.partitionBy(KEY).orderBy("month")
    closed = flows.select(KEY, "month", F.sum(F.coalesce(F.col("net"), F.lit(0))).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("closing_balance"),
                          F.add_months(F.lead("month").over(w), -1).alias("until"))
    months = F.sequence("month", F.coalesce("until", last), F.expr("interval 1 month"))
    return closed.select(KEY, F.explode(months).alias("month"), "closing_balance")
