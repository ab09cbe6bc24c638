"""Session construction and cluster-facing settings."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "txnscope") -> SparkSession:
    """Local/test session.  On a cluster, pass the session you already have.

    AQE is on so that joins against data-derived lookup tables are converted
    to broadcast joins only after their real size is known at runtime, and
    skewed shuffle partitions are split.
    """
    master = master or os.environ.get("TXNSCOPE_MASTER", "local[8]")
    parts = shuffle_partitions or int(os.environ.get("TXNSCOPE_SHUFFLE_PARTITIONS", "8"))
    spark = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("TXNSCOPE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared filesystem folder and is used as
    is.  Only when it is unset (tests, local runs) a fresh local folder is
    created and registered.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf = tempfile.mkdtemp(prefix="txnscope-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", conf)
    spark.sparkContext.setCheckpointDir(conf)
    return conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint directory for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}"
