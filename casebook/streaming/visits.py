"""Incremental visit summary (the funnel study's CB-13) with Structured Streaming.

A visit is one user's events on one calendar day, so the batch summary's
group-by (visit_id, user_id) is a one-day tumbling window per user here.
Rows are emitted once the watermark passes the end of the day (append
mode), each exactly once; late events within the watermark delay are still
counted. Campaigns are attached per micro-batch (a stream-static range join
against the small campaign calendar) and written as parquet.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from casebook.operators.funnel import CART_ADD, CLICK, IMPRESSION, PURCHASE, attach_campaign
from casebook.session import checkpoint_dir
from casebook.sources.studies import CAMPAIGNS, EVENT_CODES, N_PAGES

EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def read_events(spark: SparkSession, folder: str, files: str = "events*.parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream the driver's ``events`` parquet files as they land in ``folder``."""
    r = spark.readStream.schema(EVENTS_SCHEMA).option("pathGlobFilter", files)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(folder)


def study_events(raw: DataFrame) -> DataFrame:
    """The funnel study's event columns (same mapping as the batch view),
    row by row, so it works on a stream."""
    et = None
    for name, code in EVENT_CODES.items():
        et = (F.when if et is None else et.when)(F.col("event_type") == name, F.lit(code))
    page = (F.get_json_object("props", "$.k").cast("int") % N_PAGES) + 1
    return raw.select(
        "user_id",
        F.col("ts").alias("event_time"),
        # watermarks need TIMESTAMP (the files hold TIMESTAMP_NTZ, read as UTC)
        F.col("ts").cast("timestamp").alias("_wm_time"),
        F.col("event_id").alias("sequence_number"),
        et.alias("event_type"),
        page.alias("page_id"),
        F.when(page.between(3, 11), page - 2).alias("product_id"),
    )


def visit_summary_stream(events: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Per (user, day): the CB-13 counters, emitted when the day is closed."""
    et = F.col("event_type")
    in_cart = F.col("page_id").between(3, 11) & (et == CART_ADD)
    agg = (events.withWatermark("_wm_time", lateness)
           .groupBy("user_id", F.window("_wm_time", "1 day").alias("day"))
           .agg(F.min("event_time").alias("visit_start_time"),
                F.count("page_id").alias("page_views"),
                F.count(F.when(et == CART_ADD, et)).alias("cart_adds"),
                F.max(F.when(et == PURCHASE, F.lit(1)).otherwise(F.lit(0))).alias("purchase"),
                F.count(F.when(et == IMPRESSION, et)).alias("impressions"),
                F.count(F.when(et == CLICK, et)).alias("click"),
                F.collect_list(F.when(in_cart, F.struct(F.col("sequence_number").alias("s"),
                                                        F.col("product_id").alias("p")))).alias("_items")))
    ordered = F.transform(F.array_sort("_items"), lambda x: x["p"].cast("string"))
    return agg.select(
        F.concat(F.col("user_id").cast("string"), F.lit("-"),
                 F.col("day.start").cast("date").cast("string")).alias("visit_id"),
        "user_id", "visit_start_time", "page_views", "cart_adds", "purchase", "impressions", "click",
        F.when(F.size("_items") > 0, F.array_join(ordered, ",")).alias("cart_products"))


def start(spark: SparkSession, folder: str, out_dir: str, checkpoint: str | None = None,
          available_now: bool = False, how: str = "left", files: str = "events*.parquet",
          max_files_per_trigger: int = 1) -> StreamingQuery:
    """Run the incremental summary: ``folder`` of events files in, campaign-
    tagged visit summaries appended as parquet under ``out_dir``. The stream
    checkpoint defaults to a folder of this ``out_dir`` under the session's
    checkpoint folder; without either an error says so."""
    campaigns = spark.createDataFrame(
        CAMPAIGNS, "campaign_name string, start_date timestamp_ntz, end_date timestamp_ntz")
    ckpt = checkpoint or os.path.join(
        checkpoint_dir(spark), "visit-summary-" + hashlib.sha256(out_dir.encode()).hexdigest()[:16])
    summary = visit_summary_stream(study_events(read_events(spark, folder, files, max_files_per_trigger)))

    def write(batch: DataFrame, epoch: int) -> None:
        # one folder per micro-batch, overwritten on replay: a batch re-run
        # after a failure replaces its own output instead of duplicating it
        attach_campaign(batch, campaigns, how).write.mode("overwrite").parquet(
            os.path.join(out_dir, f"batch_id={epoch}"))

    w = summary.writeStream.outputMode("append").option("checkpointLocation", ckpt).foreachBatch(write)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
