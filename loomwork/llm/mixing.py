"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    """Sources in code point order, null last, weigh ``weights``, repeating.

    They share ``percent`` per cent of all words, none more than ``max_epochs``
    times its own.  ``seed`` decides which documents have the fractional
    repetition.  ``bin_docs`` is how many documents are put in order together.
    """

    weights: tuple[int, ...] = (3, 1, 2)
    percent: int = 150
    max_epochs: int = 2
    seed: int = 42
    bin_docs: int = 1024


def n_words(text: str) -> Column:
    """Words between ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``, a row per source.

    Clamping sources at their cap and sharing the excess among the others by
    weight, until none is above, ends at one level for all that are not clamped,
    and the clamped ones are those with least room for their weight.  So sources
    are put in order of cap by weight; ``level`` is what a unit of weight gets if
    all before a source are clamped; the first source that has room at its own
    level sets it for all.  One row per source, so one task suffices.
    """
    every = Window.partitionBy(F.lit(0))
    by_name = every.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*map(F.lit, mix.weights))
    cap = (F.col("source_size") * mix.max_epochs).alias("cap")
    weighed = sizes.select(
        "source", "source_size", cap,
        F.element_at(weights, (F.row_number().over(by_name) - 1) % len(mix.weights) + 1).alias("w"),
        (F.sum("source_size").over(every) * mix.percent / F.lit(100.0)).alias("total"),
    )
    room = F.col("cap") / F.col("w").cast("double")
    by_room = every.orderBy("room", F.col("source").asc_nulls_last())
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    levels = weighed.withColumn("room", room).withColumn(
        "level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("w").over(onward)
    )
    fits = F.when(F.col("level") < F.col("room"), F.col("room"))
    level = F.min_by(F.when(fits.isNotNull(), F.col("level")), fits).over(every)
    full = F.col("cap").cast("double")
    target = F.coalesce(F.least(full, F.col("w") * level), full)
    return levels.select("source", "source_size", target.alias("target"))


_SIZE, _HASH = "__size", "__hash"  # beside all columns of a caller's table
_KEY = ("__name", "__none", "__bin")  # source, whether it is null, and bin


def _key(source: Column, number: Column, more: str = "") -> list[Column]:
    parts = F.coalesce(source.cast("string"), F.lit("")), source.isNull(), number
    return [c.alias(name + more) for c, name in zip(parts, _KEY)]


def plan(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", mix: Mix = Mix()) -> DataFrame:
    """All columns of ``docs`` but the text if it isn't wanted, with ``__size, __source_size,
    __target, __taken``: see ``mixture`` and ``sample``."""
    hashed = F.md5(F.concat(F.lit(f"{mix.seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    rows = docs.withColumn(_SIZE, n_words(text_col)).withColumn(_HASH, hashed)
    slim = cut_lineage(rows.select(F.col(source_col).alias("source"), F.col(_SIZE).alias("size"), F.col(_HASH).alias("h")))
    bins = slim.count() // mix.bin_docs + 1

    def bin_of(hash_col: str) -> Column:
        head = F.conv(F.substring(hash_col, 1, 8), 16, 10).cast("long")
        return F.floor(head * bins / F.lit(float(1 << 32)))

    # sizes by bin of the hash: the hashes order bins, and documents only within the bin in question
    summed = cut_lineage(slim.groupBy("source", bin_of("h").alias("bin")).agg(F.sum("size").alias("bin_size")))
    sources = targets(summed.groupBy("source").agg(F.sum("bin_size").alias("source_size")), mix)
    before = Window.partitionBy("s.source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    whole = F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size"))), F.lit(0))
    placed = summed.alias("s").join(sources.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source"))).select(
        *_key(F.col("s.source"), F.col("bin"), "2"), F.col("source_size").alias("__source_size"),
        F.col("target").alias("__target"), whole.alias("__whole"),
        F.round(F.col("target") - whole * F.col("source_size")).cast("long").alias("__extra"),
        F.coalesce(F.sum("bin_size").over(before), F.lit(0)).alias("__before"),
    )
    rows = rows.select("*", *_key(F.col(source_col), bin_of(_HASH)))
    # by the very columns of the window, so that the rows move once for both
    joined = rows.join(placed, [rows[c] == placed[f"{c}2"] for c in _KEY])
    inside = Window.partitionBy(*_KEY).orderBy(_HASH, _SIZE).rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("__extra") - F.col("__before") - F.coalesce(F.sum(_SIZE).over(inside), F.lit(0))
    part = F.greatest(F.lit(0), F.least(left, F.col(_SIZE)))
    return joined.withColumn("__part", part).withColumn("__taken", F.col("__whole") * F.col(_SIZE) + F.col("__part"))


def mixture(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", mix: Mix = Mix()) -> DataFrame:
    """``id_col, size, source_size, target, taken`` for every row.

    Every document has as many whole repetitions as its source's target allows;
    documents in the order of a seeded hash have one more until the target is
    reached, the last of them in part.  A source's words taken are its target
    rounded to a word.  Null texts have no words, null sources are one source,
    null ids and repeated rows share a hash and are put in order by size, so
    reruns agree.  Sources without words have target 0, and no rows give none.
    """
    planned = plan(docs.select(id_col, source_col, text_col), id_col, source_col, text_col, mix)
    return planned.select(
        id_col, F.col(_SIZE).alias("size"), F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"), F.col("__taken").alias("taken"),
    )


def sample(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
    length_col: str | None = "n_chars", mix: Mix = Mix(),
) -> DataFrame:
    """The mix itself: a row for each repetition, with the columns of ``docs``.

    A repetition in part has the first words of the text, one space apart, and
    ``length_col``, where there is one, their characters.  Documents without
    words have as many rows as their source has whole repetitions.
    """
    planned = plan(docs, id_col, source_col, text_col, mix)
    copies = F.col("__whole") + (F.col("__part") > 0).cast("int")
    rows = planned.where(copies > 0).withColumn("__copy", F.explode(F.sequence(F.lit(1), copies.cast("int"))))
    cut = (F.col("__copy") > F.col("__whole")) & (F.col("__part") < F.col(_SIZE))
    words = F.filter(F.split(text_col, r"[ \t-\r]+"), lambda w: w != "")
    text = F.when(cut, F.array_join(F.slice(words, F.lit(1), F.col("__part").cast("int")), " ")).otherwise(F.col(text_col))
    rows = rows.withColumn(text_col, text)
    if length_col in docs.columns:
        length = F.when(cut, F.length(text_col)).otherwise(F.col(length_col))
        rows = rows.withColumn(length_col, length.cast(docs.schema[length_col].dataType))
    return rows.select(*[f"`{c}`" for c in docs.columns])
