"""Session for tests and the benchmark; a cluster brings its own."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int = 8, memory: str = "12g") -> SparkSession:
    shared = tempfile.mkdtemp(prefix="loreweave-")  # one machine: every executor reaches it
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("loreweave")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.checkpoint.dir", shared)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
