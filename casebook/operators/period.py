"""Calendar-period comparisons over a weekly sales table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.functions.numeric import TOTAL, ratio


def _window_sums(before: Column, after: Column, value: str) -> list[Column]:
    v = F.coalesce(F.col(value), F.lit(0))
    return [F.sum(F.when(before, v)).cast(TOTAL).alias("_before"),
            F.sum(F.when(after, v)).cast(TOTAL).alias("_after")]


def window_days(baseline: dt.date, weeks: int) -> tuple[dt.date, dt.date]:
    """The first and last day that either window around ``baseline`` reads."""
    return baseline - dt.timedelta(weeks=weeks), baseline + dt.timedelta(weeks=weeks)


def days_of_weeks(first: dt.date, last: dt.date) -> tuple[dt.date, dt.date]:
    """Predicate inversion of ``date_trunc('week', d) between first and last``:
    the half-open range of days ``d`` that it accepts, so that a filter on the
    derived week becomes a range on the stored date. Weeks start on Monday."""
    def monday(d: dt.date) -> dt.date:
        return d - dt.timedelta(days=d.weekday())
    start = monday(first + dt.timedelta(days=6))
    return start, max(start, monday(last) + dt.timedelta(days=7))


def day_texts(first: dt.date, last: dt.date) -> list[str]:
    """Predicate inversion of a text date, day/month/year: every text, with or
    without leading zeros and with four or two digits of the year, that means
    a day from ``first`` to ``last``. Two digits stand for 2000 to 2099."""
    out = []
    for n in range((last - first).days + 1):
        d = first + dt.timedelta(days=n)
        years = [f"{d.year:04d}"] + [f"{d.year % 100:02d}"] * (2000 <= d.year <= 2099)
        out += [f"{a}/{b}/{y}" for a in {str(d.day), f"{d.day:02d}"} for b in {str(d.month), f"{d.month:02d}"} for y in years]
    return sorted(out)


def around_date_as_written(df: DataFrame, date_col: str, value: str, baseline: dt.date, weeks: int,
                           by: tuple[str, ...] = ()) -> DataFrame:
    """The study's form: both windows are closed and share the baseline week;
    reduction = before - after and percent of before."""
    d = F.col(date_col)
    b = F.lit(baseline)
    before = d.between(F.date_sub(b, 7 * weeks), b)
    after = d.between(b, F.date_add(b, 7 * weeks))
    agg = df.groupBy(*by).agg(*_window_sums(before, after, value))
    return agg.select(*by, F.col("_before").alias("prev_weeks_sales"), F.col("_after").alias("after_weeks_sales"),
                      (F.col("_before") - F.col("_after")).alias("reduction_in_sales"),
                      (ratio(F.col("_before") - F.col("_after"), F.col("_before")) * 100)
                      .alias("percentage_reduction"))


def around_date(df: DataFrame, date_col: str, value: str, baseline: Column | dt.date, weeks: int,
                by: tuple[str, ...] = ()) -> DataFrame:
    """Half-open windows [b - n weeks, b) and [b, b + n weeks); change =
    after - before, percent of before. ``baseline`` may be a column (one
    baseline per group, e.g. the same day of each year)."""
    d = F.col(date_col)
    b = baseline if isinstance(baseline, Column) else F.lit(baseline)
    before = (d >= F.date_sub(b, 7 * weeks)) & (d < b)
    after = (d >= b) & (d < F.date_add(b, 7 * weeks))
    agg = df.groupBy(*by).agg(*_window_sums(before, after, value))
    return agg.select(*by, F.col("_before").alias("before_sales"), F.col("_after").alias("after_sales"),
                      (F.col("_after") - F.col("_before")).alias("sales_change"),
                      (ratio(F.col("_after") - F.col("_before"), F.col("_before")) * 100)
                      .alias("percentage_change"))


def month_ranges_as_written(df: DataFrame, month_col: str, value: str, by: tuple[str, ...]) -> DataFrame:
    """Months 4-8 against 8-12 per group (month 8 in both, as written)."""
    m = F.col(month_col)
    agg = df.groupBy(*by).agg(*_window_sums(m.between(4, 8), m.between(8, 12), value))
    return agg.select(*by, F.col("_before").alias("prev_weeks_sales"), F.col("_after").alias("after_weeks_sales"),
                      (F.col("_before") - F.col("_after")).alias("reduction_in_sales"),
                      (ratio(F.col("_before") - F.col("_after"), F.col("_before")) * 100)
                      .alias("percentage_reduction"))


def missing_numbers(present: DataFrame, col: str, bound: DataFrame, out: str = "rn") -> DataFrame:
    """Numbers 1..N that do not occur in ``present[col]``, where N is the
    single value of the one-row aggregate ``bound`` (NULLs in ``present`` are
    ignored, so one NULL does not empty the answer as ``NOT IN`` would)."""
    n = bound.columns[0]
    upto = F.col(n).cast("bigint")
    nums = bound.select(F.explode(F.when(upto >= 1, F.sequence(F.lit(1).cast("bigint"), upto))).alias(out))
    seen = present.where(F.col(col).isNotNull()).select(F.col(col).cast("bigint").alias(out)).distinct()
    return nums.join(seen, out, "left_anti")
