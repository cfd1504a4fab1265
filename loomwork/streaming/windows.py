"""Event-time windows and stateless enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parse import MESSAGE_FIELDS, parse_messages, rendered
from .counts import exact_sum

# Window, slide and watermark of the trade report.
WINDOW, SLIDE, WATERMARK = "30 seconds", "5 seconds", "30 seconds"


def window_trades(
    trades: DataFrame,
    time: str,
    ticker: str = "ticker",
    price: str = "price",
    window: str = WINDOW,
    slide: str = SLIDE,
    watermark: str = WATERMARK,
    price_sum: Column | None = None,
) -> DataFrame:
    """Latest time, total and average price and number of trades per sliding window and ticker.

    ``time`` is a timestamp; rows later than ``watermark`` behind the newest
    time are dropped.  Prices are summed as decimals, so totals do not depend on
    the order of rows.
    """
    total = price_sum if price_sum is not None else exact_sum(price)
    return (
        trades.withWatermark(time, watermark)
        .groupBy(F.window(time, window, slide), ticker)
        .agg(
            F.max(time).alias("max_time"),
            total.alias("total_price"),
            (total / F.count(price)).alias("avg_price"),
            F.count(F.lit(1)).alias("trades"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            ticker, "max_time", "total_price", "avg_price", "trades",
        )
    )


def ingest_window_trades(lines: DataFrame, ingest_time: str = "timestamp", **sizes) -> DataFrame:
    """``window_trades`` over message lines, timed by their receipt."""
    messages = parse_messages(lines, trade_time=F.unix_timestamp(ingest_time))
    timed = messages.withColumn("trade_time", F.timestamp_seconds("tradeTs"))
    return window_trades(timed, "trade_time", **sizes)


def enrich(lines: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse message lines and render each as one upper-case text."""
    messages = parse_messages(lines)
    return messages.select(*keep, rendered(*[F.col(c) for c in MESSAGE_FIELDS]).alias("value"))
