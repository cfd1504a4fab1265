"""Explicit data placement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.skew import SALT, hot_keys, with_salt


def partition_sorted(
    df: DataFrame,
    partitions: int,
    group_by: Sequence[str],
    order_by: Sequence[str],
    whole_groups: bool = False,
) -> DataFrame:
    """Rows placed by group and sorted by (group, order) inside each partition.

    By default partitions are ranges of the whole sort key, so a frequent group
    continues in the next partition.  ``whole_groups`` keeps every group in one
    partition, for consumers that need it and know their groups to be small.
    """
    if whole_groups:
        placed = df.repartition(partitions, *group_by)
    else:
        placed = df.repartitionByRange(partitions, *group_by, *order_by)
    return placed.sortWithinPartitions(*group_by, *order_by)


def skew_partition(df: DataFrame, partitions: int, key: str, row_id: Sequence[str]) -> DataFrame:
    """Hash placement by key, except that hot keys are spread in proportion to their rows.

    A key with more rows than an average partition is hot, null included.  The
    other keys stay together.  Aggregate in two steps afterwards: by (key,
    ``_salt``), then by key.
    """
    return with_salt(df, key, hot_keys(df, key, partitions), row_id).repartition(partitions, key, SALT)


def sum_by(
    df: DataFrame, keys: Sequence[str], value: Column, name: str, partitions: int | None = None
) -> DataFrame:
    """Sum of ``value`` per key; ``partitions`` places the sums by the first key.

    The number of places is applied to the sums and not to the raw rows, which
    would have to be moved before they are combined.
    """
    sums = df.groupBy(*keys).agg(F.sum(value).alias(name))
    return sums.repartition(partitions, keys[0]) if partitions else sums
