"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings the plans in this package are written for.  Adaptive execution
# sizes shuffle partitions, splits skewed join partitions (even where that costs an
# extra exchange) and picks broadcast joins from measured sizes.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Timestamps in the default INT96 form carry no statistics, so scans could not skip by them.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


# Rounds of tasks a full-size shuffle is cut into on a cluster.  Adaptive execution merges
# partitions that turn out small, but it cannot cut a shuffle finer than it began.
_ROUNDS = 8


def build_session(app_name: str = "tallymill", master: str | None = None, **conf: str) -> SparkSession:
    """Create or reuse a session with the settings above.

    On a cluster leave ``master`` unset: master, memory and executors then come from
    spark-submit, and shuffles start with several partitions per core unless their number is set.  In local mode the
    number of shuffle partitions follows the cores.
    """
    builder = SparkSession.builder.appName(app_name)
    settings = dict(RUNTIME_CONF)
    if master is not None:
        builder = builder.master(master)
        if master.startswith("local"):
            cores = master.removeprefix("local").strip("[]")
            settings["spark.sql.shuffle.partitions"] = cores if cores.isdigit() else str(os.cpu_count())
            settings["spark.ui.enabled"] = "false"
            settings["spark.driver.bindAddress"] = "127.0.0.1"
            settings["spark.driver.host"] = "127.0.0.1"
    settings.update({key: str(value) for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    chosen = spark.sparkContext.getConf().contains("spark.sql.shuffle.partitions") or spark.conf.get(initial, None) is not None
    if not spark.sparkContext.master.startswith("local") and not chosen:
        spark.conf.set(initial, str(max(_cluster_cores(spark) * _ROUNDS, 200)))
    return spark


def _cluster_cores(spark: SparkSession) -> int:
    """Cores the application may get, from its settings, or else those registered so far."""
    conf = spark.sparkContext.getConf()
    executors = int(conf.get("spark.executor.instances", conf.get("spark.dynamicAllocation.maxExecutors", "0")))
    cores = executors * int(conf.get("spark.executor.cores", "1"))
    return max(cores, spark.sparkContext.defaultParallelism)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name for intermediate tables, below ``spark.checkpoint.dir``.

    Every executor must see the folder, so a temporary folder of this machine is used
    only in local mode and only where the setting is absent.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.gettempdir()
    return f"{shared.rstrip('/')}/tallymill/{label}-{uuid.uuid4().hex}"
