"""Equi joins, plain and salted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.skew import SALT, hot_keys, with_all_salts, with_salt


def plain_join(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Inner equi join, physical strategy left to the optimizer."""
    return left.join(right, on)


def salted_join(
    left: DataFrame, right: DataFrame, on: str, row_id: Sequence[str], partitions: int | None = None
) -> DataFrame:
    """Inner equi join with the rows of frequent keys of ``right`` spread over tasks.

    A key with more rows than one of ``partitions`` (the shuffle setting if not
    given) gets salts in proportion, and its ``left`` rows are copied once per
    salt, so the result multiset is that of the plain join.  ``row_id`` names
    columns of ``right`` that differ between rows of one key.
    """
    partitions = partitions or int(right.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(right.where(F.col(on).isNotNull()), on, partitions)
    copied, spread = with_all_salts(left, on, hot), with_salt(right, on, hot, row_id)
    return copied.join(spread, [on, SALT]).drop(SALT)
