"""Running a stream into a result table that can be queried while it grows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..storage import new_path

BATCH = "batch_id"


class ResultTable:
    """The output of a stream as parquet in the shared folder, a partition for each batch.

    A batch that is repeated overwrites its partition, and partitions count up
    to the newest that is whole.  ``mode`` is the output mode: ``complete`` has
    the newest batch, ``append`` all of them, and ``update`` the newest row of
    each of ``keys``, by one aggregation.  A path goes with its checkpoint.  Old
    partitions of a complete table are for the folder's owner to expire.

    With ``name`` the table is a temporary view that SQL can poll, from before
    the first batch on.
    """

    def __init__(
        self,
        stream: DataFrame,
        mode: str,
        keys: Sequence[str] = (),
        name: str | None = None,
        transform: Callable[[DataFrame], DataFrame] | None = None,
        path: str | None = None,
        checkpoint: str | None = None,
        schema: T.StructType | None = None,
    ):
        self.stream, self.mode, self.keys, self.name = stream, mode, list(keys), name
        self.transform = transform
        self.spark = stream.sparkSession
        self.path = path or new_path(self.spark, "streams")
        self.checkpoint = checkpoint or new_path(self.spark, "stream-state")
        self.rows_schema = schema or (None if transform else stream.schema)
        if name:
            self.read().createOrReplaceTempView(name)

    @property
    def last(self) -> int:
        """The newest whole batch; -1 before the first."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        done = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{BATCH}=*/_SUCCESS")
        found = done.getFileSystem(conf).globStatus(done) or []
        return max((int(f.getPath().getParent().getName().split("=")[1]) for f in found), default=-1)

    def _write(self, batch: DataFrame, batch_id: int) -> None:
        out = self.transform(batch) if self.transform else batch
        self.rows_schema = self.rows_schema or out.schema
        out.write.mode("overwrite").parquet(f"{self.path}/{BATCH}={batch_id}")
        if self.name:
            self.read().createOrReplaceTempView(self.name)

    def start(self, interval: str | None = None) -> StreamingQuery:
        """Start with a trigger interval such as "5 seconds", or on what is available now."""
        trigger = {"processingTime": interval} if interval else {"availableNow": True}
        return (
            self.stream.writeStream.outputMode(self.mode)
            .option("checkpointLocation", self.checkpoint)
            .trigger(**trigger)
            .foreachBatch(self._write)
            .start()
        )

    def run(self) -> DataFrame:
        """Process what is available now, then read."""
        self.start().awaitTermination()
        return self.read()

    def read(self) -> DataFrame:
        """Rows of all whole batches, also those of an earlier run on the same path."""
        last = self.last
        if last < 0:
            fields = self.rows_schema.fields if self.rows_schema else []
            rows = self.spark.createDataFrame([], T.StructType([*fields, T.StructField(BATCH, T.IntegerType())]))
        else:
            reader = self.spark.read
            if self.rows_schema:
                reader = reader.schema(T.StructType([*self.rows_schema.fields, T.StructField(BATCH, T.IntegerType())]))
            rows = reader.parquet(self.path).where(F.col(BATCH) == last if self.mode == "complete" else F.col(BATCH) <= last)
        if self.mode == "complete":
            return rows.drop(BATCH)
        return latest_rows(rows, self.keys) if self.mode == "update" and self.keys else rows


def latest_rows(rows: DataFrame, keys: Sequence[str], version: str = BATCH) -> DataFrame:
    """The newest version of each key's row."""
    rest = [c for c in rows.columns if c not in (*keys, version)]
    newest = F.max_by(F.struct(*rest), F.col(version)).alias("_row")
    return rows.groupBy(*keys).agg(newest).select(*keys, "_row.*")


def console(
    stream: DataFrame,
    mode: str,
    interval: str = "5 seconds",
    rows: int = 20,
    truncate: bool = False,
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Print each batch on the driver, at most ``rows`` rows of it."""
    return (
        stream.writeStream.outputMode(mode)
        .format("console")
        .option("numRows", rows)
        .option("truncate", truncate)
        .option("checkpointLocation", checkpoint or new_path(stream.sparkSession, "stream-state"))
        .trigger(processingTime=interval)
        .start()
    )
