"""Write a study's views once, run its queries many times.

Every registered query derives its study's views from the driver tables
(joins included). A workload that runs many queries over the same data can
write the views once, as parquet under a shared folder, and pass the
written tables to the queries instead of the driver folder: the joins and
cleaning steps then run once, and lineage starts at the written files.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

from casebook.sources import studies
from casebook.sources.tables import load

# study -> (builder, views worth writing)
STUDIES = {
    "retail": (studies.retail, ["sales_raw", "product_details"]),
    "diner": (studies.diner, ["sales", "menu", "members"]),
    "delivery": (studies.delivery, ["customer_orders_raw", "runner_orders_raw", "pizza_names",
                                    "pizza_recipes", "pizza_toppings"]),
    "subscriptions": (studies.subscriptions, ["subscriptions", "plans"]),
    "bank": (studies.bank, ["regions", "customer_nodes", "customer_transactions"]),
    "mart": (studies.mart, ["weekly_sales_raw"]),
    "funnel": (studies.funnel, ["events", "users", "page_hierarchy", "campaign_identifier"]),
}


def materialize(spark: SparkSession, sf_dir: str, out_dir: str, study: str) -> list[str]:
    """Write ``study``'s views from the driver tables in ``sf_dir`` to
    ``out_dir/<study>/<view>`` (parquet, overwritten). Returns the paths."""
    builder, names = STUDIES[study]
    v = builder(load(spark, sf_dir))
    paths = []
    for name in names:
        path = os.path.join(out_dir, study, name)
        getattr(v, name).write.mode("overwrite").parquet(path)
        paths.append(path)
    return paths


def load_materialized(spark: SparkSession, out_dir: str, study: str) -> studies.LazyViews:
    """The written views of ``study`` as a source for its queries."""
    _, names = STUDIES[study]
    return studies.LazyViews(**{
        n: (lambda p=os.path.join(out_dir, study, n): spark.read.parquet(p)) for n in names})
