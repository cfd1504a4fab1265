"""Near-duplicates by SimHash fingerprints, found with vantage-point trees."""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..storage import cut_lineage
from .components import components
from .texts import as_bytes, give_back, map_batches

BITS = 64
SEED = 42


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Bits set in over half of the hashes of the text's word shingles; zero without words."""
    words = text.lower().split()  # of bytes: A-Z only, and the six ASCII white spaces only
    if not words:
        return 0
    runs = [words] if len(words) < shingle else zip(*(words[i:] for i in range(shingle)))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(b" ".join(r), SEED) for r in runs), "<u8")
    ones = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 1 << 16):
        block = hashes[start : start + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(id_col, fp long)`` for every row; null text counts as empty."""

    rows = _with_fingerprint(docs.select(id_col, text_col), text_col, shingle)
    return rows.select(id_col, F.col(_FP).alias("fp"))


_FP = "__fingerprint"  # beside all columns of a caller's table


def _with_fingerprint(docs: DataFrame, text_col: str, shingle: int = 3) -> DataFrame:
    """All columns of ``docs`` and the fingerprint."""
    at = docs.columns.index(text_col)

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(t, shingle) for t in as_bytes(batch.column(at))], np.uint64)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(fps.view(np.int64))], [*batch.schema.names, _FP])

    return map_batches(docs, of, StructType([*docs.schema.fields, StructField(_FP, LongType())]))


class Metric(NamedTuple):
    """Hamming distance over the bits of ``mask``, and how far apart partners may be there."""

    mask: int
    radius: int

    def distance(self, x: np.ndarray, v: np.uint64) -> np.ndarray:
        return np.bitwise_count((x ^ v) & np.uint64(self.mask)).astype(np.int16)


def metrics(blocks: int, max_bits: int) -> list[Metric]:
    """Two values at most ``max_bits`` apart are at most ``max_bits // blocks`` apart in some block."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    return [
        Metric(((1 << (hi - lo)) - 1) << lo, max_bits // blocks)
        for lo, hi in zip(edges, edges[1:])
    ]


class Split(NamedTuple):
    """Values at most ``border`` from ``vantage`` lie inside."""

    vantage: np.uint64
    border: int


def choose_split(sample: np.ndarray, metric: Metric, rng: np.random.Generator, tries: int = 8) -> Split | None:
    """The vantage point and border, of some tries, with fewest values near the border.

    Each side keeps a quarter of the sample at least where that is possible.
    None if no try divides the sample.
    """
    best, best_cost = None, math.inf
    for v in rng.choice(sample, min(tries, len(sample)), replace=False):
        count = np.bincount(metric.distance(sample, v), minlength=BITS + 1)
        inside = np.cumsum(count)
        for border in range(BITS):
            least = min(inside[border], len(sample) - inside[border])
            if least:
                near = inside[min(border + metric.radius, BITS)] - inside[border]
                cost = near / len(sample) + max(0.0, 0.25 - least / len(sample)) * 4
                if cost < best_cost:
                    best, best_cost = Split(np.uint64(v), border), cost
    return best


class Tree(NamedTuple):
    """A node is a split with two nodes, or the number of a shard."""

    metric: Metric
    nodes: list  # (Split, inside, outside), or an int
    shards: int


def build_tree(sample: np.ndarray, metric: Metric, per_shard: int, seed: int = SEED) -> Tree:
    """Divide the sample until a shard has at most ``per_shard`` of it."""
    rng, nodes, shards = np.random.default_rng(seed), [None], 0
    todo = [(0, np.unique(sample))]
    while todo:
        at, part = todo.pop()
        split = choose_split(part, metric, rng) if len(part) > per_shard else None
        if split is None:
            nodes[at], shards = shards, shards + 1
            continue
        inside = metric.distance(part, split.vantage) <= split.border
        nodes[at] = (split, len(nodes), len(nodes) + 1)
        todo += [(len(nodes), part[inside]), (len(nodes) + 1, part[~inside])]
        nodes += [None, None]
    return Tree(metric, nodes, shards)


def sides(x: np.ndarray, home: np.ndarray, split: Split, metric: Metric):
    """For both sides: the positions that go there, and whether it is their home.

    By the triangle inequality a partner of an inside value is at most
    ``border + radius`` away from the vantage point.  Home values go to their
    own side, and from outside also visit the inside if near enough; one
    direction is enough, as every value meets home values only.  Visitors go
    wherever partners of theirs can be.
    """
    d = metric.distance(x, split.vantage)
    within = d <= split.border
    reach_in = d - metric.radius <= split.border
    reach_out = d + metric.radius > split.border
    yield np.flatnonzero(reach_in), (home & within)[reach_in]
    out = np.where(home, ~within, reach_out)
    yield np.flatnonzero(out), home[out]


def route(tree: Tree, x: np.ndarray):
    """Yield (shard, positions in x, whether the shard is their home)."""
    todo = [(0, np.arange(len(x)), np.ones(len(x), bool))]
    while todo:
        at, rows, home = todo.pop()
        node = tree.nodes[at]
        if not isinstance(node, tuple):
            yield node, rows, home
            continue
        for child, (part, own) in zip(node[1:], sides(x[rows], home, node[0], tree.metric)):
            if len(part):
                todo.append((child, rows[part], own))


def _join_labels(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Give linked positions the smallest label of their component, in place."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up := label[label], label):
            label[:] = up


def _compare(x: np.ndarray, label: np.ndarray, home: np.ndarray, other: np.ndarray, max_bits: int) -> None:
    for a in range(0, len(home), 256):
        left = home[a : a + 256]
        for b in range(0, len(other), 4096):
            right = other[b : b + 4096]
            i, j = np.nonzero(np.bitwise_count(x[left][:, None] ^ x[right][None, :]) <= max_bits)
            _join_labels(label, left[i], right[j])


def shard_links(x: np.ndarray, home: np.ndarray, metric: Metric, max_bits: int, small: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the pairs in one shard that differ in at most ``max_bits`` bits.

    The tree goes on within the shard; where the block's distances no longer
    divide the values, those over all bits do.  Linked values are joined at
    once, so a dense group costs one link per value and not one per pair.
    """
    rng = np.random.default_rng(SEED)
    label = np.arange(len(x))
    todo = [(np.arange(len(x)), home, metric)]
    while todo:
        rows, own, by = todo.pop()
        if not own.any():
            continue
        split = None
        if len(rows) > small:
            some = rng.choice(x[rows], min(len(rows), 256), replace=False)
            split = choose_split(np.unique(some), by, rng)
            if split is None and by.radius < max_bits:
                by = Metric((1 << BITS) - 1, max_bits)
                split = choose_split(np.unique(some), by, rng)
        if split is not None:
            parts = [(rows[p], h, by) for p, h in sides(x[rows], own, split, by) if len(p)]
            if all(len(p[0]) < 0.9 * len(rows) for p in parts):
                todo += parts
                continue
        _compare(x, label, rows[own], rows, max_bits)
    moved = np.flatnonzero(label != np.arange(len(x)))
    return x[moved], x[label[moved]]


def close_links(fps: DataFrame, max_bits: int = 3, blocks: int = 2, shard_rows: int = 16_384, sample_per_shard: int = 64) -> DataFrame:
    """``(a, b)`` links that connect all distinct ``fp`` values within ``max_bits`` bits.

    One vantage-point tree per block of bits.  Its upper part is built on the
    driver from a sample of ``sample_per_shard`` values for each shard of
    ``shard_rows`` values (no more than one value in 256 reaches the driver; the
    sample decides how even the shards are, never which links are found), and
    sends every value to its home shard and to the shards whose border it is
    near.  Each shard is searched by itself, exactly.
    """
    spark, total = fps.sparkSession, fps.count()
    share = min(1.0, sample_per_shard / shard_rows) if total > shard_rows else 0.0
    sample = np.array([r[0] for r in fps.sample(share, SEED).collect()] if share else [], np.int64).view(np.uint64)
    trees = [build_tree(sample, m, sample_per_shard) for m in metrics(blocks, max_bits)]
    shared = spark.sparkContext.broadcast(trees)

    def send(batches):
        for batch in batches:
            x = np.asarray(batch.column(0)).view(np.uint64)
            for t, tree in enumerate(shared.value):
                for shard, rows, home in route(tree, x):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), t, np.int32)), pa.array(np.full(len(rows), shard, np.int32)),
                         pa.array(x[rows].view(np.int64)), pa.array(home)],
                        ["tree", "shard", "fp", "home"],
                    )

    def search(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        metric = shared.value[key[0]].metric
        x = rows["fp"].to_numpy().view(np.uint64)
        a, b = shard_links(x, rows["home"].to_numpy(), metric, max_bits)
        give_back()
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    sent = fps.select("fp").mapInArrow(send, "tree int, shard int, fp long, home boolean")
    return sent.groupBy("tree", "shard").applyInPandas(search, "a long, b long")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = 3, shingle: int = 3) -> DataFrame:
    """``(id_col, fp, component_id)`` for every row of ``docs``.

    Rows whose fingerprints differ in at most ``max_bits`` bits are linked;
    ``component_id`` is the smallest id reachable over links.  Null or empty
    texts have fingerprint zero, linked like any other.  Repeated rows share a
    component.  A null id never names a component; one of null ids alone has a
    null name.  No rows give no rows.  Other columns are not looked at.
    """
    rows = cut_lineage(fingerprints(docs, id_col, text_col, shingle))
    # equal fingerprints are one value from here on, counted before they move
    fps = cut_lineage(rows.groupBy("fp").agg(F.min(id_col).alias("least")))
    root = components(close_links(fps, max_bits)).withColumnRenamed("a", "fp")
    placed = fps.join(root, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    names = placed.join(named, "root").select("fp", "root", "component_id")
    return rows.join(names, "fp").select(id_col, "fp", "component_id", "root")


def hex_fingerprint(column: str = "fp"):
    """16 lowercase hexadecimal digits."""
    return F.lpad(F.lower(F.hex(column)), 16, "0")
