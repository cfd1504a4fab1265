"""Multiset difference and adjacent deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.ordered import ordered_frame


def multiset_diff(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose number of occurrences differs: ``net`` = count in left - count in right."""
    signed = left.select(*columns, F.lit(1).alias("_sign")).unionByName(
        right.select(*columns, F.lit(-1).alias("_sign"))
    )
    return signed.groupBy(*columns).agg(F.sum("_sign").alias("net")).where(F.col("net") != 0)


def page_firsts(
    df: DataFrame,
    page: str,
    order_by: Sequence[str],
    value: str,
    declared: DataFrame | None = None,
    if_empty: int = -1,
) -> DataFrame:
    """First value of each page; pages only named by ``declared`` give ``if_empty``."""
    first = F.min(F.struct(*order_by, F.col(value).alias("_v")))
    out = df.groupBy(page).agg(first.alias("_first")).select(page, F.col("_first._v").alias("first"))
    if declared is None:
        return out
    seen = out.withColumn("_seen", F.lit(True))
    return declared.select(page).join(seen, page, "left").select(
        page, F.when(F.col("_seen"), F.col("first")).otherwise(F.lit(if_empty)).alias("first")
    )


def dedup_adjacent(
    df: DataFrame, order_by: Sequence[str], value: str, page: str | None = None, **paging
) -> DataFrame:
    """Keep a row unless its value equals that of the row just before it.

    With ``page``, rows are compared inside their page only: pages follow each
    other in ``page`` order and a page's first row is always kept.  Either way
    the rows are split by position, so a page may be of any size.
    """
    compare = [value] if page is None else [page, value]
    order = [*order_by] if page is None else [page, *order_by]
    marked = ordered_frame(
        df,
        [],
        order,
        {"_prev": lambda w: F.lag(F.struct(*compare)).over(w)},
        reads=compare,
        preceding=1,
        **paging,
    )
    same = F.col("_prev").eqNullSafe(F.struct(*[F.col(c) for c in compare]))
    return marked.where(F.col("_prev").isNull() | ~same).drop("_prev")
