"""Where checkpoints, stream state and result tables go."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
ROWS_A_PARTITION = 500_000
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where the setting is missing, a session whose only executor is the driver
    itself gets a folder of its own; any other is told to name one.
    """
    sc = spark.sparkContext
    folder = spark.conf.get(SETTING, None) or sc.getConf().get(SETTING, None) or sc.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError(f"set {SETTING} to a folder that the driver and every executor can reach")
        folder = tempfile.mkdtemp(prefix="loomwork-")
        spark.conf.set(SETTING, folder)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, kind: str) -> str:
    """An unused path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{kind}/{uuid.uuid4().hex}"


def use_rocksdb(spark: SparkSession) -> None:
    """Let streams that start in this session keep their state in RocksDB.

    State with several variables, timers among them, is only held by it; Spark's default provider
    ends such a query.  A stream that goes on keeps the provider that its checkpoint names.
    """
    spark.conf.set(STATE_STORE, ROCKSDB)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later stages start from files that outlive any executor, and the planner
    sees their size.
    """
    path = new_path(df.sparkSession, "cuts")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_cut(df: DataFrame | None) -> None:
    """Delete the files of a table that ``cut_lineage`` gave, once nothing reads it any more."""
    if df is None:
        return
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/cuts/" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing names any more.

    It does so when the driver's JVM collects them, which may be long after a loop has filled the disks.
    """
    gc.collect()  # first Python's handles of plans
    spark._jvm.System.gc()


def room_for(rows: DataFrame, expected: float | None = None) -> None:
    """Let shuffles begin with a partition for each ``ROWS_A_PARTITION`` rows of a cut table, or of the ``expected``.

    Spark joins small neighbours again, but never splits a partition of an aggregation, so with a fixed number
    the memory and the spills of a task grow with the input.  A larger number that is set already stays.
    """
    spark = rows.sparkSession
    at_least = int(spark.conf.get(INITIAL, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set(INITIAL, max(at_least, int((rows.count() if expected is None else expected) / ROWS_A_PARTITION)))


def bucketed(df: DataFrame, *columns: str, buckets: int | None = None, placed: bool = False) -> DataFrame:
    """``cut_lineage`` into a table bucketed by ``columns``: joins on them do not move it again.

    ``placed`` says that the rows come from a grouping by the same columns, and need no move before they are written.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"bucketed_{uuid.uuid4().hex}"
    (
        (df if placed else df.repartition(n, *columns))
        .write.bucketBy(n, *columns)
        .sortBy(*columns)
        .option("path", new_path(spark, "buckets"))
        .saveAsTable(name)
    )
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the catalog entry only; the files and their layout stay
    return table
