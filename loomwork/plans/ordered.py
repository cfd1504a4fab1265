"""Ordered windows that split by position instead of by key.

A window with no partition column, or with one very frequent group, puts an
unbounded number of rows into one task.  The functions here cut the *sorted*
input into pages of similar size (the group columns are simply the first sort
columns, so a frequent group spans many pages) and run the window per page.
Rows just outside a page that a frame still needs are added to it as ghosts
and removed afterwards, so the results equal those of the plain window.

The sort key (group columns + order columns) must be unique, as for any window
whose result is to be determined.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..storage import cut_lineage

PAGE = "_page"
GHOST = "_ghost"
KEYS_PER_PAGE = 20  # keys read per page to place its border
ROWS_PER_PAGE = 100_000  # rows that one task sorts
RANGES = 1_024  # ranges of the whole order; borders of pages within them are a table
RANGE = "_range"

MakeColumn = Callable[[WindowSpec], Column]


def page_count(rows: DataFrame, pages: int | None, rows_per_page: int) -> int:
    """Number of pages: as asked, else so many that each has about ``rows_per_page`` rows."""
    return pages or max(1, -(-rows.count() // rows_per_page))


def _picked(df: DataFrame, key: Sequence[str], pages: int) -> DataFrame:
    """About ``KEYS_PER_PAGE`` keys for each page, picked by hash: pages are even however the values cluster.

    Which keys are picked affects the sizes of the pages only, never a result.
    """
    keys = df.select(*key)
    step = keys.agg(
        F.greatest(F.lit(1), F.floor(F.count(F.lit(1)) / (pages * KEYS_PER_PAGE)))
    ).scalar()
    return keys.where(F.pmod(F.xxhash64(*key), step) == 0).distinct()


def _cut_keys(picked: DataFrame, key: Sequence[str], tiles: int, within: Sequence[str] = ()) -> DataFrame:
    """The least keys of all tiles but the first, where the picked keys are cut into even tiles, in each group of ``within``."""
    tile = F.ntile(tiles).over(Window.partitionBy(*within).orderBy(*key))
    return (
        picked.withColumn("_tile", tile)
        .groupBy(*within, "_tile")
        .agg(F.min(F.struct(*key)).alias("_k"))
        .where(F.col("_tile") > 1)
    )


def _place(df: DataFrame, key: Sequence[str], borders: Column, most: int, name: str) -> DataFrame:
    """Add ``name``, the number of ``borders``, at most ``most`` in a sorted array, at or below the row's key."""
    out, place = df.withColumn(name, F.lit(0)), F.struct(*[F.col(c) for c in key])
    step = 1 << (most.bit_length() - 1) if most else 0
    while step:  # binary search, one halving per projection
        found = F.get(borders, F.col(name) + (step - 1)) <= place
        out = out.withColumn(name, F.col(name) + F.when(found, step).otherwise(0))
        step >>= 1
    return out


def whole_ranges(pages: int) -> int:
    """The number of pages, or where there are more than ranges the next that all ranges share evenly."""
    return pages if pages <= RANGES else -(-pages // RANGES) * RANGES


def with_page(df: DataFrame, key: Sequence[str], pages: int) -> DataFrame:
    """Add ``_page``, the number of page borders at or below the row's key.

    Borders are quantiles of picked keys, on two levels.  At most ``RANGES`` keys
    cut the whole order into ranges, and every task has these.  If there are to
    be more pages, each range is cut by itself, in a task of its own, and rows
    meet the borders of their range in a join.  Borders are kept in the shared
    folder, so every later reading of them, retries included, is the same.
    Each border is the key of a row, so no page but perhaps the first is empty.
    """
    if pages == 1:
        return df.withColumn(PAGE, F.lit(0))
    coarse = min(pages, RANGES)
    firsts = cut_lineage(_cut_keys(_picked(df, key, coarse), key, coarse).select("_k").coalesce(1))
    borders = firsts.agg(F.array_sort(F.collect_list("_k"))).scalar()
    if coarse == pages:
        return _place(df, key, borders, pages - 1, PAGE)
    fine = -(-pages // coarse)
    picked = _place(_picked(df, key, pages), key, borders, coarse - 1, RANGE)
    within = _cut_keys(picked, key, fine, [RANGE]).groupBy(RANGE).agg(F.array_sort(F.collect_list("_k")).alias("_within"))
    numbers = df.sparkSession.range(coarse).select(F.col("id").cast("int").alias(RANGE))
    cuts = numbers.join(within, RANGE, "left")
    before = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    n = F.coalesce(F.size("_within"), F.lit(0)) + 1
    cuts = cut_lineage(cuts.withColumn("_from", F.coalesce(F.sum(n).over(before), F.lit(0)).cast("int")))
    placed = _place(df, key, borders, coarse - 1, RANGE).join(cuts, RANGE)
    paged = _place(placed, key, F.col("_within"), fine - 1, "_fine")
    # without borders there is nothing to find, and a search in null finds nothing
    return paged.withColumn(PAGE, F.col("_from") + F.col("_fine")).drop(RANGE, "_within", "_from", "_fine")


def _edge_rows(
    paged: DataFrame, key: Sequence[str], reads: Sequence[str], rows: int, last: bool, pages: int
) -> DataFrame:
    """The last (or first) ``rows`` rows of each page, addressed to the pages that see them.

    Every border is the key of a row, so each page but perhaps the first holds
    a row, and the ``rows`` rows before a page lie in the ``rows`` pages before.
    Spark applies the row-number limit before the shuffle, so little moves.
    """
    order = [F.col(c).desc() if last else F.col(c).asc() for c in key]
    near = (
        paged.select(PAGE, *dict.fromkeys([*key, *reads]))
        .withColumn("_rn", F.row_number().over(Window.partitionBy(PAGE).orderBy(*order)))
        .where(F.col("_rn") <= rows)
        .drop("_rn")
    )
    sign = 1 if last else -1
    targets = F.array(*[F.col(PAGE) + sign * i for i in range(1, rows + 1)])
    return (
        near.withColumn(PAGE, F.explode(targets))
        .where(F.col(PAGE).between(0, pages - 1))
        .withColumn(GHOST, F.lit(True))
    )


def _paged_rows(
    df: DataFrame,
    key: Sequence[str],
    reads: Sequence[str],
    preceding: int,
    following: int,
    pages: int,
) -> DataFrame:
    """All rows plus ghosts, page ``i`` in partition ``i``; ``df`` is a written table."""
    paged = with_page(df, key, pages)
    out = paged.withColumn(GHOST, F.lit(False))
    for rows, last in ((preceding, True), (following, False)):
        if rows and pages > 1:
            edge = _edge_rows(paged, key, reads, rows, last, pages)
            out = out.unionByName(edge, allowMissingColumns=True)
    return out.repartitionById(pages, F.col(PAGE))


def ordered_frame(
    df: DataFrame,
    group_by: Sequence[str],
    order_by: Sequence[str],
    columns: dict[str, MakeColumn],
    reads: Sequence[str],
    preceding: int = 0,
    following: int = 0,
    pages: int | None = None,
    rows_per_page: int = ROWS_PER_PAGE,
    split_groups: bool = True,
) -> DataFrame:
    """Add window columns whose frames reach a fixed number of rows.

    ``columns`` maps a name to a function from the window (partitioned by
    ``group_by``, ordered by ``order_by``) to a column.  Frames may look back
    ``preceding`` rows and ahead ``following`` rows; ``reads`` names the
    columns they look at.  ``group_by`` may be empty.

    The input is read once and written to the shared folder; borders, edge rows
    and rows come from there, so an input that differs from reading to reading
    does no harm.  ``split_groups=False`` asks for the plain window instead, for
    groups known to fit a task.
    """
    if group_by and not split_groups:
        window = Window.partitionBy(*group_by).orderBy(*order_by)
        return df.select("*", *[make(window).alias(name) for name, make in columns.items()])
    df = cut_lineage(df)
    n = whole_ranges(page_count(df, pages, rows_per_page))
    rows = _paged_rows(df, [*group_by, *order_by], reads, preceding, following, n)
    window = Window.partitionBy(PAGE, *group_by).orderBy(*order_by)
    out = rows.select("*", *[make(window).alias(name) for name, make in columns.items()])
    return out.where(~F.col(GHOST)).drop(PAGE, GHOST)


def carry_last(
    df: DataFrame,
    group_by: Sequence[str],
    order_by: Sequence[str],
    name: str,
    value: MakeColumn,
    reads: Sequence[str],
    preceding: int = 0,
    pages: int | None = None,
    rows_per_page: int = ROWS_PER_PAGE,
    split_groups: bool = True,
) -> DataFrame:
    """Add ``name``: the latest non-null ``value`` at or before each row in its group.

    ``value`` is a window column as in ``ordered_frame`` that is non-null at the
    first row of every group.  That makes the latest value before a page the
    right one for the page's leading rows whatever their group, so one row per
    page is all that passes from page to page.
    """
    so_far = (Window.unboundedPreceding, Window.currentRow)
    if group_by and not split_groups:
        window = Window.partitionBy(*group_by).orderBy(*order_by)
        latest = F.last("_v", ignorenulls=True).over(window.rowsBetween(*so_far))
        return df.withColumn("_v", value(window)).withColumn(name, latest).drop("_v")
    df = cut_lineage(df)
    n = whole_ranges(page_count(df, pages, rows_per_page))
    key = [*group_by, *order_by]
    rows = _paged_rows(df, key, reads, preceding, 0, n)
    window = Window.partitionBy(PAGE, *group_by).orderBy(*order_by)
    marked = rows.withColumn("_v", value(window)).where(~F.col(GHOST)).drop(GHOST)
    local = F.last("_v", ignorenulls=True).over(window.rowsBetween(*so_far))
    tops = (
        marked.where(F.col("_v").isNotNull())
        .groupBy(PAGE)
        .agg(F.max(F.struct(*key, "_v")).alias("_top"))
    )
    # at most one row per page reaches the unpartitioned window; a page without
    # a value of its own passes on what it was handed
    numbers = df.sparkSession.range(n).select(F.col("id").cast("int").alias(PAGE))
    before = Window.orderBy(PAGE).rowsBetween(Window.unboundedPreceding, -1)
    carried = numbers.join(tops, PAGE, "left").select(
        PAGE, F.last("_top._v", ignorenulls=True).over(before).alias("_carried")
    )
    return (
        marked.withColumn("_local", local)
        .drop("_v")
        .join(carried, PAGE, "left")
        .withColumn(name, F.coalesce("_local", "_carried"))
        .drop(PAGE, "_local", "_carried")
    )
