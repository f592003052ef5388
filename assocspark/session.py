"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Adaptive execution picks broadcast sides from measured sizes, splits skewed join
# partitions and merges small ones. Nothing in the package forces a broadcast.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession, initial_partitions: int | None = None) -> SparkSession:
    """Apply the settings the operators are designed for to an existing session.

    ``initial_partitions`` is the number of shuffle partitions adaptive execution starts from and
    merges down; for large data choose it so that a partition stays within some hundred megabytes.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    if initial_partitions:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(initial_partitions))
    return spark


def new_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "assocspark") -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    A machine-local folder is used only by a local master without that setting, as in tests. On a
    cluster each executor would write to its own disk, so there the setting is required.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        return tempfile.mkdtemp(prefix="run-")
    return os.path.join(shared, f"assocspark-{uuid.uuid4().hex}")
