"""Cutting the lineage of iterative jobs through the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Point Spark at the shared folder named by the session; a temporary one only in local mode."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_SETTING, None)
    if not configured:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="minewright-checkpoint-")
    context.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the checkpoint folder and return a frame that reads it back.

    A written table outlives lost executors, and unlike a checkpointed frame it tells Catalyst its real size, so loops
    neither pile up plans nor inflate the size estimates that joins are planned by.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    written._table_path = path
    return written


def release(df: DataFrame) -> None:
    """Delete the table behind a frame of ``cut_lineage`` once nothing will read it again."""
    path = getattr(df, "_table_path", None)
    if path is not None:
        spark = df.sparkSession
        location = spark._jvm.org.apache.hadoop.fs.Path(path)
        location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)
