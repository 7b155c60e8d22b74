"""casebook: business-analytics operators on Spark DataFrames.

Layout
------
sources/    driver-table loader and the per-study views built on it
functions/  column-level helpers (cleaning, exact arithmetic, calendar)
operators/  DataFrame -> DataFrame analytics, one module per family
plans/      the registered queries (Spark side) and their DuckDB oracles
streaming/  incremental form of the per-visit summary
"""

from casebook.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
