"""Counting which items occur together in a basket."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import cut_lineage, room_for

BLOCK_ITEMS = 2_000  # items of one basket that meet as many others in one task; any value gives equal results


def basket_rows(df: DataFrame, basket: str, array: str, field: str) -> DataFrame:
    """``(basket, item)`` rows from an array of structs."""
    item = F.explode(array)
    return df.select(basket, item.alias("_e")).select(basket, F.col(f"_e.{field}").alias("item"))


def pair_counts(
    df: DataFrame, basket: str, item: str, block_items: int = BLOCK_ITEMS, min_count: int = 1
) -> DataFrame:
    """``(a, b, n)`` for every ordered pair ``a < b`` that shares a basket, with multiplicity.

    The result, and so the work, is quadratic in the number of distinct items of
    a basket; that is the question asked.  ``min_count`` asks for pairs seen so
    often only: items that cannot reach it with all others of their baskets
    together are left out before pairs are formed.

    Repeated items are combined to counts first: an item seen x times beside
    one seen y times adds x * y.  A basket with more than ``block_items``
    distinct items is cut into blocks by item hash; each two blocks meet once,
    in a place of their own, so a huge basket is the work of many tasks.
    """
    items = cut_lineage(
        df.where(F.col(item).isNotNull())
        .groupBy(F.col(basket).alias("_k"), F.col(item).alias("_x"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    # pairs are counted by hash maps, so the number of pairs decides; by baskets' sizes, which is exact or more
    sizes = items.groupBy("_k").agg(F.count(F.lit(1)).cast("double").alias("_size"))
    room_for(items, sizes.agg(F.sum(F.col("_size") * F.col("_size") / 2)).first()[0] or 0)
    baskets = items.groupBy(F.col("_k").alias("_basket")).agg(F.sum("_n").alias("_all"), F.count(F.lit(1)).alias("_size"))
    whole = items.join(baskets, F.col("_k").eqNullSafe(F.col("_basket"))).drop("_basket")
    if min_count > 1:
        most = whole.groupBy("_x").agg(F.sum(F.col("_n") * (F.col("_all") - F.col("_n"))).alias("_most"))
        whole = whole.join(most.where(F.col("_most") >= min_count).select("_x"), "_x", "left_semi")
    blocks = F.ceil(F.col("_size") / block_items).cast("int")
    own = F.pmod(F.xxhash64("_x"), blocks).cast("int")
    placed = whole.select("_k", "_x", "_n", own.alias("_own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("_other"))
    # blocks i and j meet at (i, j) with i <= j only
    met = placed.select("_k", "_x", "_n", "_own", F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j"))
    far = met.select(*[F.col(c).alias(f"{c}2") for c in ("_k", "_i", "_j", "_own")], F.col("_x").alias("_y"), F.col("_n").alias("_m"))
    at = F.col("_k").eqNullSafe(F.col("_k2")) & (F.col("_i") == F.col("_i2")) & (F.col("_j") == F.col("_j2"))
    # items of one block meet where i = j, and not again beside every other block
    once = (met["_i"] == met["_j"]) | (F.col("_own") != F.col("_own2"))
    pairs = (
        met.join(far, at)
        .where(once & (F.col("_x") < F.col("_y")))
        .groupBy(F.col("_x").alias("a"), F.col("_y").alias("b"))
        .agg(F.sum(F.col("_n") * F.col("_m")).alias("n"))
    )
    return pairs.where(F.col("n") >= min_count) if min_count > 1 else pairs


def pair_counts_nested(
    df: DataFrame, basket: str, item: str, segments: int = 1, block_items: int = BLOCK_ITEMS
) -> DataFrame:
    """``(a, segment, partners)``: maps from each larger partner to its count.

    Partners of an item are split into ``segments`` maps by hash, so that no
    record need hold them all; segments without partners are left out, but items
    without any larger partner have an empty map as segment 0.
    """
    pairs = pair_counts(df, basket, item, block_items)
    number = F.conv(F.substring(F.md5(F.col("b").cast("string")), 1, 8), 16, 10).cast("long")
    maps = pairs.groupBy("a", F.pmod(number, F.lit(segments)).cast("int").alias("segment")).agg(
        F.map_from_entries(F.collect_list(F.struct("b", "n"))).alias("partners")
    )
    everyone = df.where(F.col(item).isNotNull()).select(F.col(item).alias("a")).distinct()
    empty = F.create_map().cast(maps.schema["partners"].dataType)
    return everyone.join(maps, "a", "left").select(
        "a", F.coalesce("segment", F.lit(0)).alias("segment"), F.coalesce("partners", empty).alias("partners")
    )
