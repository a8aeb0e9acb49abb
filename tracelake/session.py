"""SparkSession settings and shared-folder helpers.

Every library function takes an existing session; ``get_spark`` is only a
convenience for scripts, tests and the bench.  Scratch output (tables written
by the proof queries, streaming checkpoints) always goes under the shared
folder the cluster names in ``spark.checkpoint.dir``; a local folder is set
only when that setting is absent, as in tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings of the session itself (fixed when the context starts).
STATIC_CONF = {
    "spark.ui.enabled": "false",
    # Lineage cuts (running totals, order statistics) write checkpoint files;
    # remove them once their data is no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.checkpoint.compress": "true",
}

# SQL settings the library prefers; ``configure`` applies them where unset.
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A JSON object with a repeated key keeps its last value (as Python's json does).
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Streaming state (dedup keys, open windows) in RocksDB, off the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

DEFAULT_CONF = {**STATIC_CONF, **SQL_CONF}


def get_spark(master: str | None = None, app: str = "tracelake", **conf: str) -> SparkSession:
    """A new session with the library's defaults, for local runs, tests and
    the bench.  ``master`` is set only when given.  Under ``spark-submit``
    use ``configure(SparkSession.builder.getOrCreate())`` instead, which
    keeps whatever the launcher set."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        settings.setdefault("spark.sql.shuffle.partitions", os.environ.get("BENCH_CPUS", "8"))
        settings.setdefault("spark.driver.memory", "8g")
    settings.update(conf)
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the library's SQL settings to an existing session, each only
    where the session has no explicit value for it."""
    for k, v in SQL_CONF.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and scratch tables.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir); only when neither is set do we create a local one and
    register it as the checkpoint dir (local runs and tests).
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="tracelake-shared-")
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir() or base
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused directory under the shared folder."""
    return f"{shared_dir(spark)}/tracelake/{name}-{uuid.uuid4().hex[:12]}"


def shuffle_partitions(spark: SparkSession) -> int:
    try:
        return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    except (TypeError, ValueError):
        return 200
