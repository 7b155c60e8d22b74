"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import shlex

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Settings every job relies on. On a cluster these are normally set by the
# submitter; get_session only fills in what is missing.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a hot join key is split even if an aggregate on the key follows
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # checkpoints written by operators are removed once their data is unreachable
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def _submitted() -> set[str]:
    """Settings already given by the submitter: in the driver JVM's
    configuration if one is running, else in PYSPARK_SUBMIT_ARGS and in the
    defaults file of SPARK_CONF_DIR."""
    if SparkContext._gateway is not None or "PYSPARK_GATEWAY_PORT" in os.environ:
        SparkContext._ensure_initialized()
        return {k for k, _ in SparkConf().getAll()}
    args = shlex.split(os.environ.get("PYSPARK_SUBMIT_ARGS", ""))
    given = {b.split("=", 1)[0] for a, b in zip(args, args[1:]) if a in ("--conf", "-c")}
    if "--driver-memory" in args:
        given.add("spark.driver.memory")
    file = os.path.join(os.environ.get("SPARK_CONF_DIR", ""), "spark-defaults.conf")
    if os.path.isfile(file):
        with open(file) as f:
            given |= {x.split("=")[0].split()[0] for x in f if x.strip() and not x.startswith("#")}
    return given


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "casebook") -> SparkSession:
    """The running session, unchanged, or a new one (local runs and tests)
    with the defaults above for whatever the submitter left unset."""
    running = SparkSession.getActiveSession() or SparkSession._instantiatedSession
    if running is not None and running.sparkContext._jsc is not None:
        return running
    defaults = dict(_DEFAULTS)
    if shuffle_partitions:
        defaults["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if memory := os.environ.get("CASEBOOK_DRIVER_MEMORY", "8g" if master and master.startswith("local") else ""):
        defaults["spark.driver.memory"] = memory
    given = _submitted()
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in defaults.items():
        if k not in given:
            builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: the context's own, else the one named by
    ``spark.checkpoint.dir``. Raises if there is neither; nothing is set."""
    own = spark.sparkContext._jsc.sc().getCheckpointDir()
    d = own.get() if own.isDefined() else spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        raise ValueError("no checkpoint folder: set spark.checkpoint.dir to a shared folder or pass checkpoint=")
    return d
