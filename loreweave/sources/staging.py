"""Cutting lineage through written tables in the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a local session (tests) gets a folder of its own when none is set.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="loreweave-"))
        folder = sc.getCheckpointDir()
    return folder.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder that goes away when the application ends."""
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Later uses survive lost executors without recomputing, and the planner
    knows the written size, so it broadcasts the table only if it is small.
    """
    path = scratch(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
