"""Materialised intermediate tables in the cluster's shared folder.

A table that several jobs read (the day cube, the feature frame) is written
once as Parquet and read back.  That cuts the lineage, so the loss of an
executor later costs a re-read of a small table and not a second pass over the
raw events, and it gives the reader real file sizes to choose joins by.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by the session.

    Only a local-mode session without one gets a folder of its own; on a
    cluster a machine-local folder would not be visible to the other hosts.
    """
    sc = spark.sparkContext
    base = spark.conf.get(CHECKPOINT_KEY, None) or sc.getConf().get(CHECKPOINT_KEY)
    if base:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(base)
        return base.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    base = tempfile.mkdtemp(prefix="daytally-")
    sc.setCheckpointDir(base)
    return base


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once and return a reader over the written table."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
