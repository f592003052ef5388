"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assocspark.session import scratch_dir


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame as Parquet in the shared folder and read it back.

    This cuts the lineage: later steps, and executors that replace lost ones, read the files. The folder
    is ``spark.checkpoint.dir``; who owns that folder clears it, as results may read it later.
    """
    path = os.path.join(scratch_dir(df.sparkSession), name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sampled(docs: DataFrame, sample: int, holds: str) -> DataFrame:
    """doc_id and text (the least, where an id repeats) of the ``sample`` ids with the lowest hashes; NULL ids are left out.

    Only ids with a text that matches the pattern ``holds`` are asked; the pattern is tried in one pass.

    The share of hashes that can be among the lowest follows from the number of ids, so no task sorts more than a few
    times ``sample`` ids, and an id of very many rows counts once.
    """
    ids = stored(docs.where("doc_id IS NOT NULL").where(F.col("text").rlike(holds)).select("doc_id").distinct().withColumn("place", F.xxhash64("doc_id")), "ids")
    share = 4 * sample / max(ids.count(), 1)
    if share < 1:
        ids = ids.where(F.col("place") < int(share * 2**64) - 2**63)
    chosen = ids.orderBy("place", "doc_id").limit(sample).select("doc_id")
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, for sessions that were started without it on their path.

    Also bounds the bytes of an Arrow batch, so that long texts do not add up in a worker.
    """
    context = spark.sparkContext
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    if getattr(context, "_assocspark_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    target = os.path.join(tempfile.mkdtemp(prefix="assocspark-"), "assocspark-package.zip")
    with zipfile.ZipFile(target, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(target)  # the driver serves the file to executors
    context._assocspark_shipped = True
