"""Streaming sources.  Every streaming operator takes any streaming DataFrame."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def new_files(spark: SparkSession, folder: str, per_batch: int | None = None) -> DataFrame:
    """Lines of files as they appear in a folder, as ``value``."""
    reader = spark.readStream
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.text(folder)


def parquet_table(
    spark: SparkSession, path: str, schema: T.StructType, per_batch: int | None = None
) -> DataFrame:
    """Rows of a parquet table, which may be one file or a folder of part files that grows.

    A path that is not there is an error.
    """
    reader = spark.readStream.schema(schema)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.parquet(as_pattern(path) if is_file(spark, path) else path)


def is_file(spark: SparkSession, path: str) -> bool:
    """Whether the path is one file; raises if there is nothing."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(place):
        raise FileNotFoundError(path)
    return fs.getFileStatus(place).isFile()


def as_pattern(path: str) -> str:
    """A pattern that only this path matches: a stream takes a plain path for a folder."""
    return f"{path[:-1]}[{path[-1]}]"


def with_ingest_time(stream: DataFrame) -> DataFrame:
    """Add the time of the micro-batch as ``timestamp``."""
    return stream.withColumn("timestamp", F.current_timestamp())


def replay(rows: DataFrame, part: Column, parts: int, folder: str) -> Iterator[int]:
    """Write the rows of one part after the other into a folder that a stream reads, giving each
    part's number once it is there.  Run the stream in between, and batches are cut where parts are."""
    for number in range(parts):
        rows.where(part == number).write.mode("append").parquet(folder)
        yield number
