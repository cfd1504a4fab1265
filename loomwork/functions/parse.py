"""Parsing of messages, web log lines and words, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The time format of log lines, and the fields of a message.
LOG_TIME_FORMAT = "dd/MMM/yyyy HH:mm:ss Z"
MESSAGE_FIELDS = ("srcUser", "destUser", "ticker", "price", "tradeTs")


def tokens(value: Column, lower: bool = True) -> Column:
    """Pieces between single blanks; trailing empty pieces are dropped, leading ones kept."""
    return F.split(F.rtrim(F.lower(value) if lower else value), " ")


def explode_tokens(lines: DataFrame, column: str = "value", lower: bool = True) -> DataFrame:
    """One ``word`` per token.  An empty line gives one empty word, a line of blanks none."""
    value = F.col(column)
    kept = lines.where((value == "") | (F.trim(value) != ""))
    return kept.select(F.explode(tokens(value, lower)).alias("word"))


def message_parts(value: Column) -> Column:
    """Comma-separated fields; trailing empty fields do not count."""
    return F.split(F.regexp_replace(value, ",+$", ""), ",")


def parse_messages(
    lines: DataFrame, column: str = "value", trade_time: Column | None = None
) -> DataFrame:
    """Messages with exactly five fields and readable numbers; other lines are left out.

    ``trade_time``, epoch seconds such as the time of receipt, replaces the
    fifth field, which must be there all the same.
    """
    parts = F.col("_parts")
    own_time = F.when(parts[4].rlike("^[+-]?[0-9]+$"), parts[4].try_cast("long"))
    values = (parts[0], parts[1], parts[2], parts[3].try_cast("double"))
    stamped = lines.withColumn("_time", trade_time.cast("long")) if trade_time is not None else lines
    out = (
        stamped.withColumn("_parts", message_parts(F.col(column)))
        .where(F.size("_parts") == 5)
        .withColumns(dict(zip(MESSAGE_FIELDS, values)))
        .withColumn(MESSAGE_FIELDS[4], own_time if trade_time is None else F.col("_time"))
        .drop("_parts", *(["_time"] if trade_time is not None else []))
    )
    return out.where(F.col("price").isNotNull() & F.col("tradeTs").isNotNull())


def message_counts(lines: DataFrame, column: str = "value") -> DataFrame:
    """``(accepted, rejected)`` numbers of lines, in one pass."""
    parts = message_parts(F.col(column))
    good = (
        (F.size(parts) == 5)
        & F.get(parts, F.lit(3)).try_cast("double").isNotNull()
        & F.get(parts, F.lit(4)).rlike("^[+-]?[0-9]+$")
        & F.get(parts, F.lit(4)).try_cast("long").isNotNull()
    )
    good = F.coalesce(good, F.lit(False))
    return lines.agg(F.count_if(good).alias("accepted"), F.count_if(~good).alias("rejected"))


def parse_weblog(lines: DataFrame, column: str = "value") -> DataFrame:
    """Add ``key`` (text before the first blank) and ``log_time`` (text in the first brackets).

    A line without either, or with an unreadable time, has null ``log_time``
    or ``key``, so that it can be counted instead of ending the job.
    """
    line = F.col(column)
    key = F.regexp_extract(line, "^([^ ]*) ", 1)
    text = F.regexp_extract(line, r"^[^\[\]]*\[([^\]]*)\]", 1)
    return lines.withColumn(
        "key", F.when(F.instr(line, " ") > 0, key)
    ).withColumn("log_time", F.try_to_timestamp(text, F.lit(LOG_TIME_FORMAT)))


def rendered(*columns: Column) -> Column:
    """A record's fields as one upper-case text."""
    return F.upper(F.concat_ws(",", *[c.cast("string") for c in columns]))
