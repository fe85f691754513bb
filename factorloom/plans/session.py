"""A local session with the settings that the engine is tuned for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: int | str | None = None, partitions: int = 8, memory: str = "8g", **conf: str) -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("factorloom")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
