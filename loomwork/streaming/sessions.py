"""Sessions over a stream: by Spark's session windows, and as keyed state for the text of each event."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.parse import LOG_TIME_FORMAT
from ..operators.sessions import metric_record, session_metrics
from ..storage import new_path, use_rocksdb

# executors get the functions below with the plan and need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Batch(NamedTuple):
    """A micro-batch with rows: its id, its number of events, the newest time seen up to it, and its arrival."""

    batch_id: int
    events: int
    newest_ms: int
    arrival: object


class SessionStream:
    """Sessions by an inactivity gap over a stream of events, with those still open.

    An event joins a session when it is at most the gap away from it, so events
    out of order extend and join sessions as in a batch job.  A session is
    closed, and written once, when the watermark is past its end by the gap; an
    event is late when a session of its own would be closed already.  Events of
    a task are merged to sessions before they move
    (``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition``),
    so a key with a third of all events arrives as a few rows from each task.

    ``arrival`` grows from batch to batch and is the same within one: the time
    of the batch if not given.
    """

    COLUMNS = ("session_start", "session_end", "events", "first_arrival", "last_arrival")

    def __init__(
        self, events: DataFrame, key: str, time: str, gap: str, watermark: str, arrival: Column | None = None,
        path: str | None = None, checkpoint: str | None = None,
    ):
        self.spark, self.key = events.sparkSession, key
        self.path = path or new_path(self.spark, "sessions")
        self.checkpoint = checkpoint or new_path(self.spark, "stream-state")
        arrived = events.withColumn("_arrival", F.current_timestamp() if arrival is None else arrival)
        seen = arrived.observe("batch", F.count(F.lit(1)).alias("events"), F.max(F.unix_millis(time)).alias("newest"), F.max("_arrival").alias("arrival"))
        self.sessions = (
            seen.withWatermark(time, watermark)
            .groupBy(F.col(key), F.session_window(time, gap).alias("_window"))
            .agg(
                F.min(time).alias("session_start"), F.max(time).alias("session_end"), F.count(F.lit(1)).alias("events"),
                F.min("_arrival").alias("first_arrival"), F.max("_arrival").alias("last_arrival"),
            )
        )
        self.batches: list[Batch] = []

    def run(self) -> list[Batch]:
        """Process what is available now; returns the batches that had rows."""
        query = (
            self.sessions.writeStream.outputMode("append").format("parquet").option("path", self.path)
            .option("checkpointLocation", self.checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        newest, fresh = max((b.newest_ms for b in self.batches), default=None), []
        for progress in query.recentProgress:
            row = progress.observedMetrics.get("batch")
            if progress.numInputRows and row and row["events"]:
                newest = row["newest"] if newest is None else max(newest, row["newest"])
                fresh.append(Batch(progress.batchId, row["events"], newest, row["arrival"]))
        self.batches += fresh
        return fresh

    def closed(self) -> DataFrame:
        """Sessions behind the watermark, each once."""
        return self.spark.read.schema(self.sessions.schema).parquet(self.path).drop("_window")

    def live(self, batch_id: int | None = None) -> DataFrame:
        """All sessions in state after a batch, of the newest if not told, from Spark's state store."""
        reader = self.spark.read.format("statestore")
        if batch_id is not None:
            reader = reader.option("batchId", batch_id)
        # Spark names the fields by their functions, two of them alike, so they are taken by place and whole
        rows = reader.load(self.checkpoint).select(F.when(F.col("key").isNotNull(), F.col("value")).alias("row")).select("row.*")
        return rows.toDF(self.key, "_window", *self.COLUMNS).drop("_window")

    def all_sessions(self) -> DataFrame:
        return self.closed().unionByName(self.live())

    def metrics(self, batch: Batch, **limits: int) -> DataFrame:
        """``(metric, value)`` over the sessions that were in state after the batch, as of the newest
        time seen up to it; a session is new if all its events came in this batch."""
        in_ms = self.live(batch.batch_id).select(
            F.unix_millis("session_start").alias("start_ms"), F.unix_millis("session_end").alias("end_ms"), "events",
            (F.col("first_arrival") == F.lit(batch.arrival)).alias("is_new"),
        )
        return session_metrics(in_ms, F.lit(batch.newest_ms), is_new=F.col("is_new"), arrived=batch.events, **limits)

    def record(self, batch: Batch, **limits: int) -> DataFrame:
        """The metrics of a batch as one wide record whose key sorts the newest first."""
        return metric_record(self.metrics(batch, **limits), F.lit(batch.newest_ms))


class _SessionText(StatefulProcessor):
    """Holds events until no earlier one can come, then gives them the start of their session.

    A key's state is its events of the time that may still change, and of its
    last session the start and the last event, which goes on from batch to batch.
    """

    def __init__(self, gap_us: int):
        self.gap_us = gap_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "us long, line string")
        self.session = handle.getValueState("session", "start long, last long")

    def _wake(self, us: int) -> None:
        self.handle.registerTimer(-(-us // 1000))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            if len(pdf):
                self.held.appendList(list(zip(pdf["us"].tolist(), pdf["line"].tolist())))
                self._wake(int(pdf["us"].min()))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        settled = timerValues.getCurrentWatermarkInMs() * 1000
        held = sorted((tuple(r) for r in self.held.get()), key=lambda r: r[0])
        ready = [r for r in held if r[0] <= settled]
        if not ready:
            return
        rest = held[len(ready) :]
        start, last = self.session.get() if self.session.exists() else (None, None)
        out = []
        for us, line in ready:
            if last is None or us > last + self.gap_us:
                start = us
            last = us
            out.append((start, line))
        self.session.update((start, last))
        if rest:
            self.held.put(rest)
            self._wake(rest[0][0])
        else:
            self.held.clear()
        yield pd.DataFrame(out, columns=["start_us", "line"], dtype=object)

    def close(self) -> None:
        pass


def session_lines(events: DataFrame, key: str, time: str, line: Column, gap_seconds: int, watermark: str) -> DataFrame:
    """Each event as text, ``value``: formatted start of its session, a tab, the raw event; append mode.

    An event is given out once the watermark has reached its time.  By then all
    earlier events have come, so the start is final, and the text is the same
    however the stream was cut into batches and in whatever order events came,
    but for those later than the watermark, which are dropped.  A key's events of
    the time within the watermark are held by one task.  Such state needs RocksDB,
    which the session is told to use.
    """
    use_rocksdb(events.sparkSession)
    # as text a null key is a key like any other; by itself it would share a call with its neighbour
    text_key = F.to_json(F.struct(F.col(key).alias("k"))).alias("key")
    rows = events.withWatermark(time, watermark).select(text_key, time, F.unix_micros(time).alias("us"), line.alias("line"))
    lines = rows.groupBy("key").transformWithStateInPandas(
        _SessionText(gap_seconds * 1_000_000), "start_us long, line string", "Append", "EventTime"
    )
    start = F.date_format(F.timestamp_micros("start_us"), LOG_TIME_FORMAT)
    return lines.select(F.concat(start, F.lit("\t"), F.col("line")).alias("value"))
