"""Regenerate casebook/plans/output_types.py: per query, the result columns
the driver contract hands over as DOUBLE.

    python tools/gen_output_types.py

Those are the DECIMAL columns (read from the Spark result schemas) and the
integer columns that hold NULLs on the driver's tables (a nullable integer
crosses to pandas as float64 from Spark but as Int64 from DuckDB).
"""

from __future__ import annotations

import sys

sys.path.insert(0, ".")

from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import DateType, DecimalType, IntegerType, LongType, TimestampNTZType  # noqa: E402

from casebook.plans import QUERIES  # noqa: E402
from casebook.session import get_session  # noqa: E402

SCALES = ("/root/testdata/sf0.001", "/root/testdata/sf0.01")


def main() -> None:
    spark = get_session("local[8]", 8)
    out, dates, stamps = {}, {}, {}
    for qid, fn in sorted(QUERIES.items()):
        fields = fn(spark, SCALES[0]).schema.fields
        d = [f.name for f in fields if isinstance(f.dataType, (DateType, TimestampNTZType))]
        if d:
            dates[qid] = d
        ts = [f.name for f in fields if isinstance(f.dataType, TimestampNTZType)]
        if ts:
            stamps[qid] = ts
        cols = set()
        for sf in SCALES:
            df = fn(spark, sf)
            cols |= {f.name for f in df.schema.fields if isinstance(f.dataType, DecimalType)}
            ints = [f.name for f in df.schema.fields if isinstance(f.dataType, (IntegerType, LongType))]
            if ints:
                r = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in ints]).first()
                cols |= {c for c in ints if r[c]}
        if cols:
            out[qid] = [f.name for f in fn(spark, SCALES[0]).schema.fields if f.name in cols]
    lines = ['"""Result columns handed over as DOUBLE at the driver boundary, per query',
             "(generated by tools/gen_output_types.py).",
             "",
             "DECIMAL columns, and integer columns that hold NULLs: client libraries",
             "convert these differently (Python Decimal vs float; pandas float64 vs",
             "Int64), a DOUBLE crosses the same way everywhere. The library itself",
             'keeps the exact types."""',
             "",
             "DOUBLE_COLUMNS = {"]
    lines += [f"    {qid!r}: {cols!r}," for qid, cols in out.items()]
    lines += ["}", "",
              "# DATE / TIMESTAMP result columns, handed over as ISO text ('yyyy-MM-dd',",
              "# 'yyyy-MM-dd HH:mm:ss.ffffff'): clients turn them into date objects or",
              "# datetime64 values of different units depending on the engine.",
              "DATE_COLUMNS = {"]
    lines += [f"    {qid!r}: {cols!r}," for qid, cols in dates.items()]
    lines += ["}", "", "# the TIMESTAMP ones among them", "TIMESTAMP_COLUMNS = {"]
    lines += [f"    {qid!r}: {cols!r}," for qid, cols in stamps.items()]
    lines += ["}", ""]
    open("casebook/plans/output_types.py", "w").write("\n".join(lines))
    print(len(out), "queries")


if __name__ == "__main__":
    main()
