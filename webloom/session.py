"""Session helpers.

The cluster names a shared folder in ``spark.checkpoint.dir``; jobs read it from
the session. Only when it is unset (local tests) do we set one of our own.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # plan building: skip the per-call Python call-site capture (py4j round trips for
    # every column function); errors still name the failing expression
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # joins keyed by (page_id, rule...) reuse the page_id partitioning of the element
    # index instead of re-shuffling on every key
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # explicit broadcasts are size-checked in code; keep auto-broadcast modest
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
}


def get_session(master: str | None = None, cpus: int | None = None, app: str = "webloom") -> SparkSession:
    """Local session for tests and the bench; on a cluster use the provided session."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    for k, v in _DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(cpus))
    builder = builder.config("spark.driver.memory", os.environ.get("WEBLOOM_DRIVER_MEM", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; set a scratch one only if unset, and only on one machine."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="webloom-ckpt-")
    sc.setCheckpointDir(shared)
    return sc.getCheckpointDir() or shared
