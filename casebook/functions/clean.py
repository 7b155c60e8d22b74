"""Column cleaning and calendar helpers (all built-in expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from casebook.functions.numeric import col_

# Spellings of "no value" found in hand-entered text columns.
NULL_TOKENS = ("", "null")


def nullify(c, tokens=NULL_TOKENS) -> Column:
    """Map any of ``tokens`` (and NULL) to NULL, keep every other value."""
    c = col_(c)
    return F.when(~c.isin(*tokens), c)


def to_number(c, type_: str = "double") -> Column:
    """Text to number; malformed text becomes NULL instead of failing."""
    return col_(c).try_cast(type_)


def parse_date(c, fmt: str) -> Column:
    """Text to DATE with a Spark datetime pattern; bad text becomes NULL."""
    return F.try_to_date(col_(c), fmt)


def week_mode0(d) -> Column:
    """MySQL ``week(d)`` in its default mode 0: weeks start on Sunday and
    days before the year's first Sunday are week 0 (range 0..53)."""
    d = col_(d)
    return F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7).cast("int")


def week_from_jan1(d) -> Column:
    """Week 1 = 1-7 January, week 2 = 8-14 January, ... (range 1..53)."""
    return F.ceil(F.dayofyear(col_(d)) / 7).cast("int")


def flag_to_int(c, true_token: str = "t", false_token: str = "f") -> Column:
    """Text flag to 1/0; anything else (including NULL) to NULL."""
    c = col_(c)
    return F.when(c == true_token, F.lit(1)).when(c == false_token, F.lit(0))


def label_by_suffix(c, mapping: dict[str, str], default: str | None) -> Column:
    """CASE on the text's last characters (``LIKE '%1'``)."""
    c = col_(c)
    out = None
    for suffix, label in mapping.items():
        out = (F.when if out is None else out.when)(c.endswith(suffix), F.lit(label))
    return out.otherwise(F.lit(default))


def label_by_prefix(c, mapping: dict[str, str], default: str | None) -> Column:
    """CASE on the text's first characters (``LIKE 'C%'``)."""
    c = col_(c)
    out = None
    for prefix, label in mapping.items():
        out = (F.when if out is None else out.when)(c.startswith(prefix), F.lit(label))
    return out.otherwise(F.lit(default))


def reject_counts(df, casts: dict[str, str]):
    """One-row report: for each column, how many non-NULL values fail to
    convert to its target type (text a cleaning step left unparseable)."""
    return df.agg(*[F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(f"{c}_rejects")
                    for c, t in casts.items()])
