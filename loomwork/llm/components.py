"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import cut_lineage, drop_cut


def _state(links: DataFrame) -> tuple:
    row = links.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s"),
    ).first()
    return row.n, row.s


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return down.join(least, "a").select(
        F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
        F.col("m").alias("b"),
    )


def components(links: DataFrame) -> DataFrame:
    """``(a, b)`` links of longs to ``(a, root)``: each linked value but the root itself.

    Large-star and small-star steps alternate until nothing changes; every link
    then leads from a value to the smallest of its component.  Each round is
    written to the shared folder.  A hub's rows meet only one row per value in
    each join, so adaptive skew joins can split them; minima are combined before
    they move.  No links give no rows.  Links with a null are ignored.
    """
    now = cut_lineage(links.where("a <> b").select("a", "b").distinct())
    state = _state(now)
    while state[0]:
        old, now = now, cut_lineage(_small_star(_large_star(now).distinct()).where("a <> b").distinct())
        drop_cut(old)
        before, state = state, _state(now)
        if before == state:
            break
    return now.withColumnRenamed("b", "root")
