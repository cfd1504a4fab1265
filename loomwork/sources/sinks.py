"""Writing the batches of a stream to outside storage."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage


def text_batches(path: str, column: str = "value") -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: one text directory per batch, replaced if the batch is repeated."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.select(column).write.mode("overwrite").text(f"{path}/batch_id={batch_id}")

    return write


@dataclass
class Written(WriterCommitMessage):
    """What a task wrote."""

    file: str
    rows: int


class _Writer(DataSourceStreamArrowWriter):
    """Each task opens a connection of its own, here a file, and closes it; what tasks that died have
    written counts in nothing, as only the files of a batch that is whole are named."""

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, base = pafs.FileSystem.from_uri(self.path)
        name, rows, out = f"{base}/rows/{uuid.uuid4().hex}.parquet", 0, None
        try:
            for batch in iterator:
                if out is None and batch.num_rows:
                    fs.create_dir(f"{base}/rows", recursive=True)
                    out = pq.ParquetWriter(name, batch.schema, filesystem=fs)
                if batch.num_rows:
                    out.write_batch(batch)
                    rows += batch.num_rows
        finally:
            if out is not None:
                out.close()
        return Written(name if rows else "", rows)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        fs, base = pafs.FileSystem.from_uri(self.path)
        fs.create_dir(f"{base}/batches", recursive=True)
        named = [{"file": m.file, "rows": m.rows} for m in messages if m is not None and m.rows]
        with fs.open_output_stream(f"{base}/batches/{batchId}.json") as out:  # a repeated batch replaces its list
            out.write("".join(json.dumps(x) + "\n" for x in named).encode())

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        fs, _ = pafs.FileSystem.from_uri(self.path)
        for m in messages:
            if m is not None and m.rows:
                fs.delete_file(m.file)


class PartitionSink(DataSource):
    """``writeStream.format("partitions").option("path", ...)``: every task of every batch writes by itself."""

    @classmethod
    def name(cls) -> str:
        return "partitions"

    def streamWriter(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"])


def read_partitions(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows of all whole batches that ``PartitionSink`` wrote."""
    files = spark.read.schema("file string, rows long").json(f"{path}/batches").select("file")
    names = [r.file for r in files.collect()]  # one for each task of each batch
    scheme = path.split("://")[0] + "://" if "://" in path else ""
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(f"{scheme}{n}" if scheme and "://" not in n else n for n in names))
