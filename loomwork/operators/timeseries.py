"""Lead/lag, peaks, sliding and tumbling statistics, differences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.ordered import ordered_frame


def lead_lag(
    df: DataFrame, group_by: Sequence[str], order_by: Sequence[str], value: str, **paging
) -> DataFrame:
    """Add ``v_after`` and ``v_before``, the neighbours' values inside the group."""
    return ordered_frame(
        df,
        group_by,
        order_by,
        {"v_after": lambda w: F.lead(value).over(w), "v_before": lambda w: F.lag(value).over(w)},
        reads=[value],
        preceding=1,
        following=1,
        **paging,
    )


def peak_valley(
    df: DataFrame, group_by: Sequence[str], order_by: Sequence[str], value: str, **paging
) -> DataFrame:
    """``lead_lag`` plus ``turn``: peak or valley when strictly beyond both neighbours, else n/a."""
    now, after, before = F.col(value), F.col("v_after"), F.col("v_before")
    turn = (
        F.when((now < after) & (now < before), "valley")
        .when((now > after) & (now > before), "peak")
        .otherwise("n/a")
    )
    return lead_lag(df, group_by, order_by, value, **paging).withColumn("turn", turn)


def sliding_stats(
    df: DataFrame,
    order_by: Sequence[str],
    value: str,
    preceding: int = 3,
    group_by: Sequence[str] = (),
    **paging,
) -> DataFrame:
    """Moving average, minimum and maximum over ``preceding`` rows and the current one."""
    return ordered_frame(
        df,
        group_by,
        order_by,
        {
            "v_moving_avg": lambda w: F.avg(value).over(w.rowsBetween(-preceding, 0)),
            "v_moving_min": lambda w: F.min(value).over(w.rowsBetween(-preceding, 0)),
            "v_moving_max": lambda w: F.max(value).over(w.rowsBetween(-preceding, 0)),
        },
        reads=[value],
        preceding=preceding,
        **paging,
    )


def diff_to_previous(
    df: DataFrame, order_by: Sequence[str], value: str, group_by: Sequence[str] = (), **paging
) -> DataFrame:
    """Add ``dif``: value minus the previous row's; a first row differs from 0."""
    return ordered_frame(
        df,
        group_by,
        order_by,
        {"dif": lambda w: F.col(value) - F.lag(value, 1, 0).over(w)},
        reads=[value],
        preceding=1,
        **paging,
    )


def tumbling_stats(df: DataFrame, group: str, bucket: Column, value: str) -> DataFrame:
    """Average, maximum and minimum per group and bucket."""
    return df.groupBy(group, bucket.alias("bucket")).agg(
        F.avg(value).alias("v_avg"), F.max(value).alias("v_max"), F.min(value).alias("v_min")
    )


def centred_bucket(ts: Column, width: int) -> Column:
    """Bucket number ``round(ts / width)``: bucket k is centred on k * width."""
    return F.round(ts / width)


def aligned_bucket(ts: Column, width: str) -> Column:
    """Start of the left-aligned time window holding ``ts``."""
    return F.window(ts, width)["start"]
