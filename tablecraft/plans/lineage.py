"""Cutting lineage with reliable checkpoints, so that lost executors cost a re-read only."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_home(spark: SparkSession) -> str:
    """Folder for checkpoints: the one the cluster names, or a fresh one in local mode."""
    context = spark.sparkContext
    home = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not home:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        home = tempfile.mkdtemp(prefix="tablecraft-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(home)
    return home


def materialize(df: DataFrame) -> DataFrame:
    """Write the rows once to the shared checkpoint folder and continue from there."""
    checkpoint_home(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder, for a table that is written and read again."""
    return f"{checkpoint_home(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a scratch folder once nothing reads it any more, on whichever file system it lies."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete shuffle files and checkpoints that no frame refers to any more.

    Spark does so when the driver collects garbage, which a job of many short stages may not come to for hours.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
