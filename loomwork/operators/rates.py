"""Rate reports: how often a flag is set, per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rate_by(df: DataFrame, flag: Column, key: Column, name: str, ordered: bool = False) -> DataFrame:
    """``(name, n_true, n_total, rate)`` per key; a null key is a group of its own."""
    out = (
        df.select(key.alias(name), flag.cast("long").alias("_flag"))
        .groupBy(name)
        .agg(F.sum("_flag").alias("n_true"), F.count(F.lit(1)).alias("n_total"))
        .withColumn("rate", F.col("n_true") / F.col("n_total"))
    )
    return out.orderBy(name) if ordered else out


def rate_total(df: DataFrame, flag: Column) -> DataFrame:
    """``(n_true, n_total)`` over all rows."""
    return df.agg(
        F.sum(flag.cast("long")).alias("n_true"), F.count(F.lit(1)).alias("n_total")
    )


def first_letter(col: Column) -> Column:
    return F.substring(col, 1, 1)


def int_bucket(col: Column, width: int = 10) -> Column:
    """Fraction cut off, divided by ``width``, rounded half up; text that is no number is null."""
    return F.round(col.try_cast("double").try_cast("int") / width)


def double_bucket(col: Column, width: int = 10) -> Column:
    """Divided by ``width``, rounded half up; text that is no number is null."""
    return F.round(col.try_cast("double") / width)
