"""Text compared without regard to case, as a MySQL server's default collation
does (``=``, LIKE, joins, GROUP BY, ORDER BY). Spark's collated string type
carries the rule through every operator; the stored text stays as it is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.functions.numeric import col_

CI, BINARY = "UTF8_LCASE", "UTF8_BINARY"


def ci(c) -> Column:
    """The text, compared without regard to case from here on."""
    return F.collate(col_(c), CI)


def plain(c) -> Column:
    """The text, compared byte by byte again (for results)."""
    return F.collate(col_(c), BINARY)


def collated(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` with ``columns`` of the case-insensitive type: filters, joins
    and grouping on them follow it without further change."""
    return df.withColumns({c: ci(c) for c in columns})


def group_key(c) -> Column:
    """One spelling for all texts that are equal but for case."""
    return F.lower(plain(c))
