"""The incremental visit summary equals the batch one for closed days."""

import tempfile

import pyarrow.compute as pc
import pyarrow.parquet as pq

import __spark_entry__ as se
from casebook.streaming import visits
from tests.conftest import SMALL


def test_stream_matches_batch_summary(spark):
    out = tempfile.mkdtemp(prefix="casebook-stream-out-")
    ckpt = tempfile.mkdtemp(prefix="casebook-stream-ckpt-")
    q = visits.start(spark, SMALL, out, checkpoint=ckpt, available_now=True)
    q.awaitTermination(300)
    assert q.exception() is None
    streamed = spark.read.parquet(out)
    batch = se.queries()["cb_13_intended"](spark, SMALL)
    cols = ["visit_id", "user_id", "page_views", "cart_adds", "purchase", "impressions", "click",
            "cart_products", "campaign_name"]
    s = sorted(tuple(r[c] for c in cols) for r in streamed.collect())
    b = {tuple(r[c] for c in cols) for r in batch.collect()}
    # the last day stays open (no later event moves the watermark past it)
    assert s and set(s) <= b
    last_day = max(r["visit_id"].split("-", 1)[1] for r in batch.collect())
    assert {x for x in b if not x[0].endswith(last_day)} == set(s)


def test_stream_over_several_files_and_batches(spark):
    """The events arrive as several files, one per micro-batch; the result
    still equals the batch summary for every closed day."""
    src = tempfile.mkdtemp(prefix="casebook-stream-src-")
    # four files in event-time order, as a feed would deliver them (the
    # smallest events table, 1,000 rows, split by event id with its types kept)
    table = pq.read_table(f"{SMALL}/events.parquet")
    n = pc.max(table["event_id"]).as_py() + 1
    for i in range(4):
        ids = table["event_id"]
        part = table.filter(pc.and_(pc.greater_equal(ids, i * n // 4), pc.less(ids, (i + 1) * n // 4)))
        pq.write_table(part, f"{src}/events_{i}.parquet")
    out = tempfile.mkdtemp(prefix="casebook-stream-out-")
    ckpt = tempfile.mkdtemp(prefix="casebook-stream-ckpt-")
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "true")
    q = visits.start(spark, src, out, checkpoint=ckpt, available_now=True)
    q.awaitTermination(300)
    assert q.exception() is None
    streamed = spark.read.parquet(out)
    assert streamed.select("batch_id").distinct().count() >= 2          # several micro-batches
    cols = ["visit_id", "user_id", "page_views", "cart_adds", "purchase", "impressions", "click",
            "cart_products", "campaign_name"]
    s = sorted(tuple(r[c] for c in cols) for r in streamed.collect())
    assert len(s) == len(set(s))                                         # each visit once
    b = {tuple(r[c] for c in cols) for r in se.queries()["cb_13_intended"](spark, SMALL).collect()}
    assert set(s) <= b and len(s) >= len(b) - 50
