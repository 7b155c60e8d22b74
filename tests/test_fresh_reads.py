"""No result outlives its query, building a query runs no job over the data,
and the fact table is not shuffled on the few keys of a small dimension."""

import os
import shutil
import tempfile

import pytest

import __spark_entry__ as se
from tests.conftest import SMALL

LARGER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("qid", ["ff_05", "db_04_intended", "bt_06"])
def test_replaced_files_are_seen(spark, qid):
    folder = tempfile.mkdtemp(prefix="casebook-fresh-")
    for name in ("orders", "lineitem", "customer", "nation", "region", "part"):
        shutil.copyfile(f"{SMALL}/{name}.parquet", os.path.join(folder, f"{name}.parquet"))
    q = se.queries()[qid]
    assert q(spark, folder).collect() == q(spark, SMALL).collect()
    for name in ("orders", "lineitem"):
        # another file takes the name, as a rewritten table would
        shutil.copyfile(f"{LARGER}/{name}.parquet", os.path.join(folder, f"{name}.new"))
        os.replace(os.path.join(folder, f"{name}.new"), os.path.join(folder, f"{name}.parquet"))
    assert not [f for f in os.listdir(folder) if f.endswith(".crc")]
    again = q(spark, folder).collect()
    mixed = tempfile.mkdtemp(prefix="casebook-fresh-")
    for name in ("customer", "nation", "region", "part"):
        shutil.copyfile(f"{SMALL}/{name}.parquet", os.path.join(mixed, f"{name}.parquet"))
    for name in ("orders", "lineitem"):
        shutil.copyfile(f"{LARGER}/{name}.parquet", os.path.join(mixed, f"{name}.parquet"))
    assert again == q(spark, mixed).collect() != q(spark, SMALL).collect()


@pytest.mark.parametrize("qid", ["db_01", "bt_06", "bt_19", "ff_05", "ff_12", "cb_13"])
def test_building_runs_no_job_over_the_data(spark, qid):
    sc = spark.sparkContext
    sc.setJobGroup(f"build-{qid}", qid)
    try:
        se.queries()[qid](spark, SMALL)
        jobs = sc.statusTracker().getJobIdsForGroup(f"build-{qid}")
        tasks = [sc.statusTracker().getStageInfo(s) for j in jobs for s in sc.statusTracker().getJobInfo(j).stageIds]
        # schema reads are one task each
        assert all(t is None or t.numTasks == 1 for t in tasks) and len(jobs) <= 4
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("qid", ["cb_08", "cb_09", "cb_10", "cb_11", "cb_12", "cb_13", "ff_03_intended", "ff_12"])
def test_small_dimensions_are_broadcast(spark, qid):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = se.queries()[qid](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = plan.splitlines()
    assert any("BroadcastHashJoin" in x for x in lines)
    assert not any("SortMergeJoin [page_id" in x or "SortMergeJoin [plan_id" in x for x in lines)
