"""Sums along weighted links, with vertices in blocks and one array for the values of a block.

Vertices are dealt to blocks by a hash of their ids and have a place in their block.  The links from one
block to another are a cell: places and weights as arrays, put together once.  A round sends the values of a
block to the cells of its links, and each cell sends on one sum for every vertex that it reaches, so what
moves is bounded by the vertices of blocks and by the links of cells, whichever are fewer.  A vertex with very
many links has them in the cells of all blocks, in each at most one link to a vertex.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import bucketed, cut_lineage, drop_cut, release_shuffles

BLOCK = 1 << 20  # vertices of a block
FULL = 4  # cells get so many times the links asked for where that leaves as many cells a core
ROWS = 1 << 16  # rows of a batch given back

Batches = Iterator[pa.RecordBatch]


class Blocks:
    """Links ``(src, dst, w)`` of a cut table, each from the vertices that pass a value on to those that get it.

    A link passes on its weight's share of all weights that leave its source.  Links from no vertex (null) count for
    nothing but the vertices that they name.  A table of values has rows ``(block, m, x, most)``: the values of a block's
    vertices, the same by the weight that leaves each, and the largest without its sign.
    """

    def __init__(self, links: DataFrame, cell_links: int) -> None:
        kind = links.select(F.array("src", "dst")[0].alias("id")).schema["id"].dataType
        name, spark = kind.simpleString(), links.sparkSession
        seen = links.agg(F.count(F.lit(1)), F.approx_count_distinct("src"), F.approx_count_distinct("dst")).first()
        by = lambda a_cell: math.ceil(math.sqrt(seen[0] / a_cell))
        few = max(by(FULL * cell_links), math.ceil(math.sqrt(FULL * spark.sparkContext.defaultParallelism)))
        self.blocks = n = max(1, math.ceil(max(seen[1:]) / BLOCK), min(by(cell_links), few))
        of = lambda c: F.pmod(F.xxhash64(F.col(c).cast(kind)), F.lit(n)).cast("int")
        cells = cut_lineage(
            links.select(F.col("src").cast(kind), F.col("dst").cast(kind), "w", (of("src") * n + of("dst")).alias("k"))
            .groupBy("k")
            .applyInArrow(cell, f"k int, src array<{name}>, dst array<{name}>, s binary, d binary, w binary, out binary")
        )
        drop_cut(links)
        named = cells.select("k", F.inline(F.array(
            F.struct((F.col("k") / n).cast("int").alias("block"), F.lit(True).alias("out_of"), F.col("src").alias("ids"), "out"),
            F.struct((F.col("k") % n).alias("block"), F.lit(False).alias("out_of"), F.col("dst").alias("ids"), F.lit(None).cast("binary").alias("out")),
        )))
        numbered = cut_lineage(named.repartition("block").mapInArrow(
            numbers, f"block int, k int, out_of boolean, at binary, ids array<{name}>, out binary, none int"
        ))
        self.vertices = cut_lineage(numbered.where("k is null").select("block", "ids", "out", "none"))
        at = lambda out_of, c: numbered.where(F.col("out_of") == out_of).select("k", F.col("at").alias(c))
        placed = cells.select("k", "s", "d", "w").join(at(True, "of"), "k").join(at(False, "at"), "k")
        # of a few cells each should be a task of its own
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * n * n)
        self.links = bucketed(placed.mapInArrow(in_place, "k int, s binary, d binary, w binary, at binary"), "k", buckets=buckets, placed=True)
        for done in (cells, numbered):
            drop_cut(done)
        del cells, numbered, named, placed, at
        release_shuffles(spark)

    def ones(self) -> DataFrame:
        """The value 1 of every vertex."""
        return cut_lineage(self.vertices.select("block", "out").mapInArrow(_ones, VALUES))

    def passed_on(self, values: DataFrame, factor: float, base: float = 0.0, to_none: bool = True) -> DataFrame:
        """``base`` and ``factor`` times the values that come in by the links; null gets any only ``to_none``."""
        n = self.blocks
        to = F.explode(F.sequence(F.col("block") * n, F.col("block") * n + (n - 1))).alias("k")
        sent = values.select(to, "x")
        sums = self.links.join(sent, "k").mapInArrow(cell_sums, "k int, at binary, y binary")
        sums = sums.select((F.col("k") % n).alias("block"), "at", "y", F.lit(None).cast("binary").alias("out"), F.lit(None).cast("int").alias("none"))
        empty = F.lit(b"")
        own = self.vertices.select("block", empty.alias("at"), empty.alias("y"), "out", "none")
        return cut_lineage(sums.unionByName(own).repartition("block").mapInArrow(lambda b: add_up(b, factor, base, to_none), VALUES))

    def rows(self, values: DataFrame, name: str) -> DataFrame:
        """``(id, <name>)``, a row for every vertex."""
        kind = self.vertices.schema["ids"].dataType.elementType.simpleString()
        return self.vertices.select("block", "ids").join(values.select("block", "m"), "block").mapInArrow(
            lambda batches: _rows(batches, name), f"id {kind}, {name} double"
        )

    def wide(self, columns: dict[str, DataFrame]) -> DataFrame:
        """``(block, out, <names>)`` of the values ``m`` of several tables."""
        tables = {"out": self.vertices.select("block", F.col("out").alias("m")), **columns}
        every = None
        for name, table in tables.items():
            one = table.select("block", "m", F.lit(name).alias("of"))
            every = one if every is None else every.unionByName(one)
        of = lambda c: F.first(F.when(F.col("of") == c, F.col("m")), ignorenulls=True).alias(c)
        return cut_lineage(every.groupBy("block").agg(*map(of, tables)))


VALUES = "block int, m binary, x binary, most double"


def floats(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), "f8")


def places(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), "i4")


def batch_of(**columns: list) -> pa.RecordBatch:
    """Of lists of values; arrays of numbers become their bytes."""
    plain = lambda v: v.tobytes() if isinstance(v, np.ndarray) else v
    types = {"block": pa.int32(), "k": pa.int32(), "none": pa.int32(), "most": pa.float64(), "out_of": pa.bool_()}
    arrays = [c if isinstance(c, pa.Array) else pa.array([plain(v) for v in c], types.get(name, pa.binary())) for name, c in columns.items()]
    return pa.RecordBatch.from_arrays(arrays, list(columns))


def value_row(block: int, m: np.ndarray, out: np.ndarray) -> pa.RecordBatch:
    x = np.divide(m, out, out=np.zeros(len(m)), where=out > 0)
    return batch_of(block=[block], m=[m], x=[x], most=[float(np.abs(m).max(initial=0.0))])


def by_row(batches: Batches, make: Callable[[dict], pa.RecordBatch]) -> Batches:
    """What ``make`` gives for the values of each row, by their columns."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield make({c: batch.column(c)[i] for c in batch.schema.names})


def cell(rows: pa.Table) -> pa.Table:
    """The links between two blocks: their ends as two lists of ids, and for each link a place in both."""
    rows = rows.combine_chunks()
    src, dst = (rows[c].chunk(0).dictionary_encode(null_encoding="encode") for c in ("src", "dst"))
    known = src.dictionary.is_valid().to_numpy(zero_copy_only=False)
    s, d = (c.indices.to_numpy(zero_copy_only=False).astype("i4") for c in (src, dst))
    w = rows["w"].to_numpy().astype("f8")
    out = np.bincount(s, w, len(known))
    real = known[s]
    s, d, w = s[real], d[real], w[real]
    one_list = lambda ids: pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
    return pa.Table.from_batches([batch_of(
        k=[rows["k"][0].as_py()], src=one_list(src.dictionary), dst=one_list(dst.dictionary),
        s=[s], d=[d], w=[None if (w == 1).all() else w], out=[out],
    )])


def numbers(batches: Batches) -> Batches:
    """The place of each id of a list in its block, and at the end of all the ids of each block in their places."""
    blocks: dict = {}
    for batch in batches:
        kind = batch.schema.field("ids").type
        for i in range(batch.num_rows):
            block, k, out_of, weights = (batch.column(c)[i] for c in ("block", "k", "out_of", "out"))
            ids = batch.column("ids").slice(i, 1).flatten()
            known, out = blocks.get(block.as_py(), (ids.slice(0, 0), np.zeros(0)))
            at = pc.index_in(ids, value_set=known).fill_null(-1).to_numpy(zero_copy_only=False).astype("i4")
            new = at < 0
            at[new] = len(known) + np.arange(new.sum())
            known = pa.concat_arrays([known, ids.filter(pa.array(new))])
            out = np.concatenate([out, np.zeros(new.sum())])
            if weights.is_valid:
                out[at] += floats(weights)
            blocks[block.as_py()] = known, out
            yield batch_of(block=[block.as_py()], k=[k.as_py()], out_of=[out_of.as_py()], at=[at], ids=pa.nulls(1, kind), out=[None], none=[None])
    for block, (known, out) in blocks.items():
        none = np.flatnonzero(known.is_null().to_numpy(zero_copy_only=False))
        ids = pa.ListArray.from_arrays(pa.array([0, len(known)], pa.int32()), known).cast(kind)
        yield batch_of(block=[block], k=[None], out_of=[None], at=[None], ids=ids, out=[out], none=[int(none[0]) if len(none) else None])


def in_place(batches: Batches) -> Batches:
    """Cells with the places of their ends in the blocks; where a cell reaches few of a block, those of what it reaches."""

    def cell_of(r: dict) -> pa.RecordBatch:
        d, at = places(r["d"]), places(r["at"])
        if len(at) and at.max() < 1.5 * len(at):
            d, at = at[d], b""
        return batch_of(k=[r["k"].as_py()], s=[places(r["of"])[places(r["s"])]], d=[d], w=[r["w"].as_py()], at=[at])

    return by_row(batches, cell_of)


def cell_sums(batches: Batches) -> Batches:
    """What the vertices that a cell reaches get by it; without their places, the first of the block."""

    def sums(r: dict) -> pa.RecordBatch:
        y, at = floats(r["x"])[places(r["s"])], places(r["at"])
        if r["w"].is_valid:
            y *= floats(r["w"])
        return batch_of(k=[r["k"].as_py()], at=[at], y=[np.bincount(places(r["d"]), y, len(at))])

    return by_row(batches, sums)


def add_up(batches: Batches, factor: float, base: float, to_none: bool) -> Batches:
    """The sums of all cells that reach a block."""
    totals, own = {}, {}
    for batch in batches:
        for i in range(batch.num_rows):
            block, at, y, out, none = (batch.column(c)[i] for c in ("block", "at", "y", "out", "none"))
            block, at, y = block.as_py(), places(at), floats(y)
            if out.is_valid:
                own[block] = floats(out), none.as_py()
            total = totals.get(block, np.zeros(0))
            if (short := (at.max() + 1 if len(at) else len(y)) - len(total)) > 0:
                total = np.concatenate([total, np.zeros(short)])
            if len(at):
                total[at] += y  # no place comes twice in a cell
            else:
                total[: len(y)] += y
            totals[block] = total
    for block, (out, none) in own.items():
        m = np.zeros(len(out))
        m[: len(totals[block])] = totals[block]
        if none is not None and not to_none:
            m[none] = 0
        yield value_row(block, base + factor * m, out)


def _ones(batches: Batches) -> Batches:
    return by_row(batches, lambda r: value_row(r["block"].as_py(), np.ones(len(floats(r["out"]))), floats(r["out"])))


def _rows(batches: Batches, name: str) -> Batches:
    for batch in batches:
        for i in range(batch.num_rows):
            ids, m = batch.column("ids").slice(i, 1).flatten(), floats(batch.column("m")[i])
            for start in range(0, len(ids), ROWS):
                yield pa.RecordBatch.from_arrays([ids.slice(start, ROWS), pa.array(m[start : start + ROWS])], ["id", name])
