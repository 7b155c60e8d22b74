"""First / last / top-k selection without per-key windows over raw rows.

``row_number() over (partition by k order by o) = 1`` puts every row of a key
into one task. The same pick is a ``min`` / ``max`` aggregate, which Spark
combines map-side, so a key holding a third of the data costs one partial
aggregate per input split and one small merge, never a sorted partition.

A ``min`` of a struct would still need a sort-based aggregate, as a struct
cannot be updated in place. Columns of fixed width are therefore packed into
one number that keeps their order (a long, or a DECIMAL(38) beyond 63 bits):
the pick is a plain hash aggregate and the columns are unpacked from it.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, ByteType, DataType, DateType, IntegerType, LongType, ShortType
from pyspark.sql.window import Window

# Bits of a value shifted to 1..2^bits - 1; 0 stands for NULL, which sorts
# first. Dates are those SQL knows, 0001-01-01 (day -719162) to 9999-12-31.
_WIDTH = {BooleanType: 2, ByteType: 9, ShortType: 17, IntegerType: 33, LongType: 65, DateType: 22}
_SHIFT = {BooleanType: 1, ByteType: (1 << 7) + 1, ShortType: (1 << 15) + 1, IntegerType: (1 << 31) + 1, LongType: (1 << 63) + 1, DateType: 719163}
_LONG_BITS, _DECIMAL_BITS = 63, 126


def _number(c: Column, kind: DataType, wide: bool) -> Column:
    """The value as a number from 1 on, 0 for NULL."""
    n = F.unix_date(c) if isinstance(kind, DateType) else c.cast("int") if isinstance(kind, BooleanType) else c
    shift = _SHIFT[type(kind)]
    n = n.cast("decimal(20,0)") + F.lit(Decimal(shift)) if wide else n.cast("bigint") + F.lit(shift)
    return F.coalesce(n, F.lit(Decimal(0)) if wide else F.lit(0))


def _value(n: Column, kind: DataType) -> Column:
    shift = _SHIFT[type(kind)]
    plain = (n.cast("decimal(38,0)") - F.lit(Decimal(shift))).cast("bigint") if isinstance(kind, LongType) else n.cast("bigint") - shift
    if isinstance(kind, DateType):
        plain = F.date_from_unix_date(plain.cast("int"))
    return F.when(n != 0, plain.cast(kind))


def packed(df: DataFrame, cols: Sequence[str]) -> tuple[Column, dict[str, Column]] | None:
    """One number that orders rows as the tuple ``cols`` does, and each column
    read back from a column ``_pick`` holding such a number. None where a type
    is not of fixed width or the widths exceed 126 bits."""
    kinds = [df.schema[c].dataType for c in cols]
    if any(type(k) not in _WIDTH for k in kinds):
        return None
    widths = [_WIDTH[type(k)] for k in kinds]
    if sum(widths) > _DECIMAL_BITS:
        return None
    wide = sum(widths) > _LONG_BITS
    key, back, below = None, {}, sum(widths)
    for c, kind, width in zip(cols, kinds, widths):
        below -= width
        n = _number(F.col(c), kind, wide)
        part = F.col("_pick")
        if wide:
            part = F.when(part.isNotNull(), _digits(part, below, width))
            n = n * F.lit(Decimal(1 << below))
        else:
            part = F.shiftright(part, below).bitwiseAND((1 << width) - 1)
            n = F.shiftleft(n, below)
        key = n if key is None else key + n
        back[c] = _value(part, kind)
    return key.cast("decimal(38,0)") if wide else key, back


def _digits(n: Column, below: int, width: int) -> Column:
    """Bits ``below`` to ``below + width`` of a DECIMAL, without rounding."""
    low = n % F.lit(Decimal(1 << (below + width)))
    return ((low - low % F.lit(Decimal(1 << below))) / F.lit(Decimal(1 << below))).cast("decimal(20,0)")


def first_per(df: DataFrame, keys: Sequence[str], order: Sequence[str],
              descending: bool = False) -> DataFrame:
    """One row per ``keys``: the row with the smallest ``order`` tuple
    (largest if ``descending``). Remaining columns break ties in the same
    direction, so the pick is deterministic.

    NULLs in ``order`` sort first ascending and last descending, as Spark's
    default window order does.
    """
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    key = packed(df, order + rest)
    st, back = key or (F.struct(*[F.col(c) for c in order + rest]), {c: F.col(f"_pick.{c}") for c in order + rest})
    pick = F.max(st) if descending else F.min(st)
    return df.groupBy(*keys).agg(pick.alias("_pick")).select(*keys, *[back[c].alias(c) for c in order + rest])


def all_firsts_per(df: DataFrame, keys: Sequence[str], order_col: str,
                   descending: bool = False) -> DataFrame:
    """Every row whose ``order_col`` equals the key's minimum (maximum):
    ``rank() = 1``, ties kept; a NULL in ``order_col`` is never picked.

    Spark turns the filter on the rank into a group limit that runs before the
    shuffle as well, so only a key's candidates of each input split are sent,
    and the rows are read once."""
    o = F.col(order_col)
    rank = F.rank().over(Window.partitionBy(*keys).orderBy(o.desc() if descending else o.asc()))
    return df.where(o.isNotNull()).withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def top_k(df: DataFrame, order: Sequence, k: int) -> DataFrame:
    """Global top-k: ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject,
    a per-partition top-k followed by a k-row merge (no full sort)."""
    return df.orderBy(*order).limit(k)
