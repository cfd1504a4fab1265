"""Session definition by inactivity gap, and session metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parse import LOG_TIME_FORMAT
from ..plans.ordered import carry_last

# The metric names.
METRICS = (
    "TOTAL_SESSION_TIME",
    "UNDER_A_MINUTE_COUNT",
    "ONE_TO_TEN_MINUTE_COUNT",
    "OVER_TEN_MINUTES_COUNT",
    "NEW_SESSION_COUNTS",
    "TOTAL_SESSION_COUNTS",
    "TOTAL_SESSION_EVENT_COUNTS",
    "EVENT_COUNTS",
    "DEAD_SESSION_COUNTS",
)
# Fixed values, in milliseconds.
SESSION_TIMEOUT = 30_000
SLACK = 11_000
ONE_MINUTE = 60_000
TEN_MINUTES = 600_000
LARGEST_LONG = 9223372036854775807


def assign_sessions(
    df: DataFrame, group_by: Sequence[str], order_by: Sequence[str], gap: Column, **paging
) -> DataFrame:
    """Add ``session_start`` to every row.

    A session opens at a group's first row and wherever the time, the first of
    ``order_by``, is past the previous row's time plus ``gap``.
    """
    ts = order_by[0]

    def opens(w):
        previous = F.lag(ts).over(w)
        return F.when(previous.isNull() | (F.col(ts) > previous + gap), F.col(ts))

    return carry_last(
        df, group_by, order_by, "session_start", opens, reads=[ts], preceding=1, **paging
    )


def sessions(
    df: DataFrame, group_by: Sequence[str], order_by: Sequence[str], gap: Column, **paging
) -> DataFrame:
    """One row per session: start, end, length (``end - start``) and number of events."""
    narrow = df.select(*group_by, *order_by)
    return (
        assign_sessions(narrow, group_by, order_by, gap, **paging)
        .groupBy(*group_by, "session_start")
        .agg(F.max(order_by[0]).alias("session_end"), F.count(F.lit(1)).alias("events"))
        .withColumn("length", F.col("session_end") - F.col("session_start"))
    )


def key_span(df: DataFrame, key: str, start: str, end: str, count: Column) -> DataFrame:
    """Earliest start, latest end and summed count per key."""
    return df.groupBy(key).agg(
        F.min(start).alias("first_start"),
        F.max(end).alias("last_end"),
        F.sum(count).alias("events"),
    )


def session_metrics(
    sessions_ms: DataFrame,
    as_of: Column,
    timeout: int = SESSION_TIMEOUT,
    slack: int = SLACK,
    short: int = ONE_MINUTE,
    long: int = TEN_MINUTES,
    is_new: Column | None = None,
    batch_events: Column | None = None,
    arrived: int | None = None,
) -> DataFrame:
    """Rows ``(metric, value)`` from sessions with ``start_ms``, ``end_ms``, ``events``.

    One pass, combined before the shuffle.  A session is active when it ended
    less than ``timeout`` before ``as_of``.  ``is_new`` marks sessions opened
    in this batch; without it a session that began within ``slack`` is new.
    ``batch_events`` is a session's number of events in this batch; ``arrived`` is
    the number of all events in this batch, where that is known.
    """
    rows = sessions_ms.withColumn("_idle", as_of - F.col("end_ms")).withColumn(
        "_length", F.col("end_ms") - F.col("start_ms")
    )
    idle, length = F.col("_idle"), F.col("_length")
    active = idle < timeout
    fresh = is_new if is_new is not None else (as_of - F.col("start_ms") < slack)
    in_batch = batch_events if batch_events is not None else F.col("events")

    def total(condition: Column, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, value)), F.lit(0)).cast("long")

    values = (
        total(active, length),
        F.count_if(active & (length < short)),
        F.count_if(active & (length >= short) & (length < long)),
        F.count_if(active & (length >= long)),
        F.count_if(active & (idle < slack) & fresh),
        F.count_if(active),
        total(active, F.col("events")),
        F.lit(arrived).cast("long") if arrived is not None else F.coalesce(F.sum(in_batch), F.lit(0)).cast("long"),
        F.count_if((idle > timeout) & (idle < timeout + slack)),
    )
    wide = rows.agg(*[v.alias(m) for m, v in zip(METRICS, values)])
    return wide.unpivot([], list(METRICS), "metric", "value")


def metric_record(metrics: DataFrame, as_of: Column) -> DataFrame:
    """One wide record of the metrics, keyed so that the newest sorts first."""
    key = F.concat(F.lit("C."), (F.lit(LARGEST_LONG) - as_of).cast("string"))
    return metrics.withColumn("row_key", key).groupBy("row_key").pivot("metric", list(METRICS)).agg(
        F.first("value")
    )


def session_lines(
    df: DataFrame, group_by: Sequence[str], order_by: Sequence[str], gap: Column, line: Column, **paging
) -> DataFrame:
    """Each event as text: formatted start of its session, a tab, the raw event.

    An event belongs to exactly one session, so the start is carried along the
    rows; no join of events to sessions is needed.
    """
    stamped = assign_sessions(df, group_by, order_by, gap, **paging)
    start = F.date_format(F.col("session_start").cast("timestamp"), LOG_TIME_FORMAT)
    return stamped.withColumn("value", F.concat(start, F.lit("\t"), line))

