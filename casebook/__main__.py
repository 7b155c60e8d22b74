"""Command line: list, run or explain the registered queries.

    python -m casebook list
    python -m casebook run bt_16 --sf /root/testdata/sf0.01 [--rows 20]
    python -m casebook explain db_05 --sf /root/testdata/sf0.01
    python -m casebook sql bt_16          # the DuckDB oracle text
"""

from __future__ import annotations

import argparse
import os
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="casebook")
    ap.add_argument("command", choices=["list", "run", "explain", "sql"])
    ap.add_argument("query", nargs="?")
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--rows", type=int, default=20)
    ap.add_argument("--master", default=os.environ.get("CASEBOOK_MASTER", "local[*]"))
    a = ap.parse_args(argv)

    from casebook.plans import DOC, ORACLE, QUERIES
    if a.command == "list":
        for qid in sorted(QUERIES):
            print(f"{qid:18s} {DOC[qid].splitlines()[0] if DOC[qid] else ''}")
        return 0
    if a.query not in QUERIES:
        print(f"unknown query {a.query!r}; try: python -m casebook list", file=sys.stderr)
        return 2
    if a.command == "sql":
        print(ORACLE.get(a.query, "-- no oracle"))
        return 0

    from casebook.session import get_session
    spark = get_session(a.master)
    df = QUERIES[a.query](spark, a.sf)
    if a.command == "explain":
        df.explain("formatted")
    else:
        df.show(a.rows, truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
