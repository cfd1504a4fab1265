"""Spreading the rows of very frequent keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import cut_lineage

SALT = "_salt"
PIECES = 4  # pieces that a partition's worth of a hot key is cut into, so that hashing evens them out


def hot_keys(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """``(_hot, _salts)``: keys with more rows than a partition has on average.

    A key gets ``PIECES`` salts for every partition's worth of its rows, so what
    goes to one place together is a part of an average partition, at any size of
    the data.
    Null can be such a key.  There are fewer rows than ``partitions``, so the
    result may go to every task.  Counts are combined before they move.
    """
    counts = cut_lineage(df.groupBy(F.col(key).alias("_hot")).agg(F.count(F.lit(1)).alias("_n")))
    share = counts.agg((F.sum("_n") / F.lit(partitions)).alias("_share"))
    return cut_lineage(
        counts.join(F.broadcast(share))  # one row
        .where(F.col("_n") > F.col("_share"))
        .select("_hot", F.ceil(F.col("_n") * PIECES / F.col("_share")).cast("int").alias("_salts"))
    )


def _with_salts(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    marked = df.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col("_hot")), "left").drop("_hot")
    return marked.withColumn("_salts", F.coalesce("_salts", F.lit(1)))


def salt_of(row_id: Sequence[str], salts: Column) -> Column:
    """A salt in ``0..salts-1`` from the row's own values, so a retried task repeats it."""
    return F.pmod(F.xxhash64(*row_id), salts).cast("int")


def with_salt(df: DataFrame, key: str, hot: DataFrame, row_id: Sequence[str]) -> DataFrame:
    """Add ``_salt``: spread over as many values as the row's key has salts."""
    return _with_salts(df, key, hot).withColumn(SALT, salt_of(row_id, F.col("_salts"))).drop("_salts")


def with_all_salts(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Copy each row once for every salt of its key."""
    salts = F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))
    return _with_salts(df, key, hot).withColumn(SALT, salts).drop("_salts")
