"""A session with the settings the operators are written for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# AQE re-plans joins from measured sizes and splits skewed join partitions, and
# is on by default; state lives in RocksDB so that it may outgrow the heap, and a batch
# writes what it changed; sessions are merged in each task before they move.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def local_session(name: str, cpus: int | None = None, **extra: str) -> SparkSession:
    """Single-machine session for tests and benchmarks; clusters bring their own."""
    cpus = cpus or os.cpu_count() or 1
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
