"""Near copies by Jaccard similarity of word shingles, one row of each group kept.

MinHash bands and the vantage-point trees of ``simhash`` retrieve pairs, the
texts decide.  Within what shares a band, texts are held against one of them and
not against each other; groups grow from the links found, and only where a band
still joins texts of different groups is there another round, with other texts
to be held against, as long as rounds find links for what they compare.  So the number
of rounds does not depend on the length of chains or the size of groups.

What bands miss, or hold against no text that is like it, is found last and
exactly: of the first shingles of a text, in any order of all shingles, a near
copy lacks at most a fifth of the text's.  A text of whose first shingles more
are in no other group has no near copy there; the others are few, and are
compared with all texts that share one of their rarest first shingles, unless
parities of their shingles differ in more places than two near copies' shingles can.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql.window import Window

from ..storage import bucketed, cut_lineage, drop_cut, release_shuffles
from .components import components
from .licenses import bands_for, shingle_hashes
from .simhash import close_links
from .texts import SPACED_LOWER, as_bytes, give_back, slices, words_of


@dataclass(frozen=True)
class Likeness:
    """Texts are near copies if ``least`` of their distinct shingles, of both together, are
    in both.  Bands are as many as retrieve such a pair with probability ``at_least`` or more;
    pairs whose fingerprints over the same shingles differ in ``max_bits`` bits are retrieved too."""

    shingle: int = 5
    least: float = 0.8
    rows: int = 5
    at_least: float = 0.999
    max_bits: int = 3
    seed: int = 42

    @property
    def bands(self) -> int:
        return bands_for(self.least, self.rows, self.at_least)


def shingles(text: bytes, n: int) -> set[tuple[bytes, ...]]:
    """Runs of ``n`` words, A-Z lowered; all words of a shorter text are one; none without words."""
    words = text.lower().split()
    if len(words) < n:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(n))))


def jaccard(a: set, b: set) -> float:
    both = len(a & b)
    return both / (len(a) + len(b) - both) if a or b else 1.0


class Sketcher:
    """Of texts: a hash of the set of shingles, a key for each band of its MinHash values, and a fingerprint.

    ``common`` are hashes of frequent shingles, the most frequent last, which come last in ``first``.
    """

    def __init__(self, like: Likeness, common: np.ndarray = np.array([], np.uint64)):
        self.like = like
        self.rank = np.argsort(common)
        self.common = common[self.rank]
        rng = np.random.default_rng(like.seed)
        n = like.bands * like.rows
        self.odd = rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)
        self.add = rng.integers(0, 1 << 63, n, np.uint64)

    def hashes(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """The distinct hashes of each text's shingles."""
        n, digest = self.like.shingle, xxhash.xxh64_intdigest
        words = words_of(texts, SPACED_LOWER)
        every, bounds = shingle_hashes(words, n), words.bounds.tolist()
        for text, a, b in zip(texts, bounds, bounds[1:]):
            if b - a >= n:
                yield np.unique(every[a : b - n + 1])
            else:
                yield np.array([digest(b" ".join(text.lower().split()), self.like.seed)] if b > a else [], np.uint64)

    def first(self, hashes: np.ndarray) -> tuple[np.ndarray, int, int]:
        """The first hashes by one order of all, how many of them are at least in a near copy, and their end.

        A set's hashes up to its end are all among its first.  Ends are in the order of hashes, so of
        two near copies that with the smaller end, or either, has that many of its first in both.
        """
        k = len(hashes)
        if not k:
            return hashes, 0, 0
        at = np.searchsorted(self.common, hashes)
        known = at < len(self.common)
        known[known] = self.common[at[known]] == hashes[known]
        often = hashes[known][np.argsort(self.rank[at[known]])]
        lacking = k - math.ceil(self.like.least * k - 1e-9)
        n, rare = min(k, lacking + 1 + (lacking + 1) // 2), k - len(often)
        if n == k:
            end = (1 << 63) - 1
        elif n <= rare:
            end = int(hashes[~known][n - 1]) >> 2
        else:
            end = (1 << 62) + int(self.rank[np.searchsorted(self.common, often[n - rare - 1])])
        return np.concatenate([hashes[~known], often])[:n], n - lacking, end

    def parity(self, hashes: np.ndarray) -> np.ndarray:
        """Whether the hashes dealt to each of ``PARITIES`` places are odd in number, as longs.

        Of two sets each hash that only one of them has changes one place, so sets
        differ in as many hashes as places, or more.
        """
        at = (hashes * self.odd[0]) >> np.uint64(64 - (PARITIES - 1).bit_length())
        return np.packbits(np.bincount(at.astype(np.int64), minlength=PARITIES) & 1, bitorder="little").view("<i8")

    def __call__(self, hashes: np.ndarray) -> tuple[bytes, np.ndarray, int]:
        if not len(hashes):
            return bytes(16), np.zeros(self.like.bands, np.uint64), 0
        minima, ones = np.full(len(self.odd), np.iinfo(np.uint64).max), np.zeros(64, np.int64)
        for start in range(0, len(hashes), 1 << 12):
            some = hashes[start : start + (1 << 12)]
            np.minimum(minima, ((some ^ self.add[:, None]) * self.odd[:, None]).min(axis=1), out=minima)
            ones += np.unpackbits(some.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        keys = [xxhash.xxh64_intdigest(k.tobytes()) for k in minima.reshape(self.like.bands, self.like.rows)]
        fingerprint = int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])
        return xxhash.xxh3_128_digest(hashes.tobytes()), np.array(keys, np.uint64), fingerprint


PARITIES = 1024  # a power of two; with more places long texts are told apart, by more bytes a text
FEWEST = 0.05  # of its pairs that a round finds alike, if there is to be another

_TEXT, _ROW = "__text_key", "__row"  # beside all columns of a caller's table


def _different_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Of each text the row with the smallest id, with a key of the text, placed by that key.

    A null id counts as largest; of rows with one id the first by all columns.
    Copies are combined before they move, so a text that a third of all rows
    have is a few rows.
    """
    rest = [c for c in docs.columns if c not in (id_col, text_col)]
    kinds = dict(docs.dtypes)
    of = lambda c: F.col(f"`{c}`")
    order = F.struct(of(id_col).isNull(), of(id_col), *(of(c).cast("string") if kinds[c].startswith("map") else of(c) for c in rest), of(text_col).isNull())
    key = F.substring(F.unhex(F.sha2(F.coalesce(of(text_col), F.lit("")).cast("binary"), 256)), 1, 16)
    rows = docs.select(key.alias(_TEXT), F.struct(*(of(c) for c in docs.columns)).alias(_ROW), order.alias("__order"))
    first = rows.groupBy(_TEXT).agg(F.min_by(_ROW, "__order").alias(_ROW))
    return bucketed(first.select(_TEXT, f"{_ROW}.*"), _TEXT, placed=True)


SAMPLE, OFTEN, COMMON = 20_000, 8, 50_000  # texts looked at, uses in them that make a shingle frequent, most of these


def _common(rows: DataFrame, text_col: str, like: Likeness) -> np.ndarray:
    """Hashes of shingles that a sample of texts uses often, the most frequent last; they decide an order, no result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = Sketcher(like)
        for batch in batches:
            for part in slices(batch, 0, 512, 4 << 20):
                every = np.concatenate(list(sketch.hashes(as_bytes(part.column(0)))))
                yield pa.RecordBatch.from_arrays([pa.array(every.view(np.int64))], ["h"])
        give_back()

    n = rows.count()
    some = rows.sample(min(1.0, SAMPLE / n), like.seed) if n else rows
    hashes = some.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(run, "h long")
    found = hashes.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= OFTEN).orderBy(F.desc("n"), "h").limit(COMMON)
    return np.array([r.h for r in found.select("h").collect()][::-1], np.int64).view(np.uint64)


def _sketches(rows: DataFrame, id_col: str, text_col: str, like: Likeness) -> DataFrame:
    """``(id, t, s, keys, fp, size, first, need, end, parity)``: id and key of a text, hash of its set of shingles,
    bands' keys, fingerprint, number of shingles, the first of them, what ``Sketcher.first`` says of these, and parities."""
    common = _common(rows, text_col, like)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = Sketcher(like, common)
        for batch in batches:
            for part in slices(batch, 2, 512, 4 << 20):
                hashes = list(sketch.hashes(as_bytes(part.column(2))))
                sets, keys, prints = zip(*map(sketch, hashes))
                firsts, needs, last = zip(*map(sketch.first, hashes))
                ends = pa.array(np.cumsum([0, *map(len, firsts)]), pa.int32())
                first = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(firsts).astype(np.uint64).view(np.int64)))
                flat = pa.array(np.concatenate(keys).view(np.int64))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * like.bands, pa.int32()), flat)
                odd = pa.array(np.concatenate([sketch.parity(h) for h in hashes]))
                parities = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * (PARITIES // 64), pa.int32()), odd)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(sets, pa.binary()), lists, pa.array(np.array(prints, np.uint64).view(np.int64)),
                     pa.array([len(h) for h in hashes], pa.int32()), first, pa.array(needs, pa.int32()), pa.array(last, pa.int64()), parities],
                    ["id", "t", "s", "keys", "fp", "size", "first", "need", "end", "parity"],
                )
        give_back()

    given = rows.select(F.col(f"`{id_col}`").alias("id"), F.col(_TEXT).alias("t"), F.col(f"`{text_col}`").alias("text"))
    kind = given.schema[0].dataType.simpleString()
    return given.mapInArrow(run, f"id {kind}, t binary, s binary, keys array<long>, fp long, size int, first array<long>, need int, end long, parity array<long>")


def _alike(pairs: DataFrame, sets: DataFrame, texts: DataFrame, like: Likeness) -> DataFrame:
    """Of ``(n, other)`` pairs of sets those that are near copies.

    Texts lie by key, so they don't move to meet their pairs; then each ``n``'s
    text goes to its ``other``, of which there are few.
    """
    keys = sets.select("n", "t")
    given = pairs.join(keys, "n").join(texts, "t").select("n", "other", F.col("text").alias("a"))
    others = pairs.select(F.col("other").alias("n")).distinct().join(keys, "n").join(texts, "t")
    both = given.join(others.select(F.col("n").alias("other"), F.col("text").alias("b")), "other").select("n", "other", "a", "b")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = None, set()
        for batch in batches:
            for part in slices(batch, 2, 256, 4 << 20):
                numbers, others, same = part.column(0).to_pylist(), part.column(1).to_pylist(), []
                for other, a, b in zip(others, as_bytes(part.column(2)), as_bytes(part.column(3))):
                    if other != last:
                        last, known = other, shingles(b, like.shingle)
                    same.append(jaccard(shingles(a, like.shingle), known) >= like.least - 1e-12)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], ["n", "other"]).filter(pa.array(same, pa.bool_()))
                del numbers
        give_back()

    return both.mapInArrow(judge, "n long, other long")


def _to_hold(active: DataFrame, seed: int, first: bool) -> DataFrame:
    """``(n, other)``: in each bucket all sets of other groups than one of its sets, and that one.

    In the first round a set is the one in all of its buckets or in none, so
    copies are held against few sets; what is left then meets another one in each band.
    """
    order = F.xxhash64(F.lit(seed), "n") if first else F.xxhash64(F.lit(seed), "band", "n")
    least = F.min(F.struct(order.alias("order"), "n", "label")).alias("one")
    # written first, so that Spark can split the rows of a frequent key in the join
    one = cut_lineage(active.groupBy("band", "key").agg(least).select("band", "key", F.col("one.n").alias("other"), F.col("one.label").alias("group")))
    return active.join(one, ["band", "key"]).where(F.col("label") != F.col("group")).select("n", "other").distinct()


def _mixed(active: DataFrame) -> DataFrame:
    """The rows of buckets that hold sets of more than one group."""
    mixed = active.groupBy("band", "key").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b")
    return active.join(cut_lineage(mixed.select("band", "key")), ["band", "key"], "left_semi")


def _by_fingerprint(sets: DataFrame, like: Likeness) -> DataFrame:
    """``(n, other)`` of sets with equal or close fingerprints, found by vantage-point trees."""
    prints = cut_lineage(sets.groupBy("fp").agg(F.min("n").alias("first")))
    a, b = (prints.select(F.col("fp").alias(c), F.col("first").alias(f"n_{c}")) for c in ("a", "b"))
    close = close_links(prints, like.max_bits).join(a, "a").join(b, "b").select(F.col("n_a").alias("n"), F.col("n_b").alias("other"))
    equal = sets.select("n", "fp").join(prints, "fp").where("n <> first").select("n", F.col("first").alias("other"))
    return close.unionByName(equal).distinct()


def _by_first(sets: DataFrame, labels: DataFrame | None, like: Likeness) -> DataFrame:
    """``(n, other)``: all sets of different groups that may be near copies.

    A set that has ``need`` of its first shingles in other groups' first, at least, is an ``other``.  All but
    ``need - 1`` of these shingles, those that fewest sets have, lead to the sets that it is held against.
    Near copies lack few of each other's shingles, so few of their parities differ, whatever passage they share.
    """
    told = sets.select("n", "size", "need", "end", "first", "parity", F.col("n").alias("label"))
    if labels is not None:
        told = told.drop("label").join(labels, "n", "left").withColumn("label", F.coalesce("label", "n"))
    each = told.select("n", "label", F.posexplode("first").alias("place", "key"))
    uses = each.groupBy("key").agg(F.min("label").alias("a"), F.max("label").alias("b"), F.count(F.lit(1)).alias("uses"))
    mixed = cut_lineage(uses.where("a <> b").select("key", "uses"))
    release_shuffles(sets.sparkSession)
    shared = cut_lineage(each.select("n", "key", "place").join(mixed, "key"))
    drop_cut(mixed)
    release_shuffles(sets.sparkSession)
    enough = shared.groupBy("n").agg(F.count(F.lit(1)).alias("m")).join(told.drop("first"), "n").where("m >= need")
    rarest = F.row_number().over(Window.partitionBy("n").orderBy("uses", "key"))
    asked = shared.join(enough, "n").withColumn("nth", rarest).where("nth <= m - need + 1")
    # written first, so that Spark can split the rows of a frequent key in the join
    a = cut_lineage(asked.select("key", *(F.col(c).alias(f"{c}_a") for c in ("n", "size", "label", "place", "end", "parity"))))
    keys = cut_lineage(a.select("key").distinct())
    asked_for = shared.join(keys, "key", "left_semi").join(told.drop("first", "need"), "n")
    b = cut_lineage(asked_for.select("key", *(F.col(c).alias(f"{c}_b") for c in ("n", "size", "label", "place", "end", "parity"))))
    both = (F.least("place_a", "place_b") + F.least(F.col("size_a") - F.col("place_a"), F.col("size_b") - F.col("place_b"))).cast("double")
    may = both >= (F.col("size_a") + F.col("size_b")) * like.least / (1 + like.least) - 1e-6
    apart = reduce(add, (F.bit_count(F.col("parity_a")[i].bitwiseXOR(F.col("parity_b")[i])) for i in range(PARITIES // 64)))
    few = apart <= (F.col("size_a") + F.col("size_b")) * (1 - like.least) / (1 + like.least) + 1e-6
    pairs = a.join(b, "key").where((F.col("label_a") != F.col("label_b")) & (F.col("end_a") <= F.col("end_b")) & may & few)
    out = cut_lineage(pairs.select(F.col("n_b").alias("n"), F.col("n_a").alias("other")).distinct())
    for done in (shared, a, b, keys):
        drop_cut(done)
    return out


def _merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """``labels`` with groups joined that links connect."""
    if labels is not None:  # links between groups
        known = labels.withColumnRenamed("label", "l")
        to = known.withColumnsRenamed({"n": "other", "l": "m"})
        links = links.join(known, "n", "left").join(to, "other", "left").select(F.coalesce("l", "n").alias("n"), F.coalesce("m", "other").alias("other"))
    roots = components(links.select(F.col("n").alias("a"), F.col("other").alias("b"))).select(F.col("a").alias("label"), "root")
    if labels is None:
        return roots.withColumnsRenamed({"label": "n", "root": "label"})
    moved = labels.join(roots, "label", "left").select("n", F.coalesce("root", "label").alias("label"))
    fresh = roots.join(labels, roots["label"] == labels["n"], "left_anti").withColumnsRenamed({"label": "n", "root": "label"})
    merged = cut_lineage(moved.unionByName(fresh))
    drop_cut(roots)
    drop_cut(labels)
    return merged


def _grouped(sets: DataFrame, texts: DataFrame, like: Likeness) -> DataFrame:
    """``(n, label)`` of the sets that are in a group with others; the label is one of the group's ``n``."""
    keys = sets.select("n", F.posexplode("keys").alias("band", "key"), F.col("n").alias("label"))
    active = cut_lineage(_mixed(keys))
    more, labels, seed = _by_fingerprint(sets, like), None, like.seed
    while True:
        held = _to_hold(active, seed, labels is None)
        pairs = cut_lineage(held if more is None else held.unionByName(more).distinct())
        links = cut_lineage(_alike(pairs, sets, texts, like))
        compared, found = pairs.count(), links.count()
        drop_cut(pairs)
        if found:
            labels = _merged(labels, links)
        drop_cut(links)
        if found <= FEWEST * compared:  # the few links that are left are found below, with all others
            break
        before = active
        told = active.drop("label").join(labels, "n", "left").withColumn("label", F.coalesce("label", "n"))
        active = cut_lineage(_mixed(told.select("n", "band", "key", "label")))
        drop_cut(before)
        more, seed = None, seed + 1
        del held, pairs, told, before
        release_shuffles(sets.sparkSession)
    drop_cut(active)
    pairs = _by_first(sets, labels, like)
    links = cut_lineage(_alike(pairs, sets, texts, like))
    drop_cut(pairs)
    if links.isEmpty():
        return labels if labels is not None else links.select("n", F.col("other").alias("label"))
    return _merged(labels, links)


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", like: Likeness = Likeness()) -> DataFrame:
    """One row of each group of near copies, with all columns: that with the smallest id.

    A group is what links between near copies connect.  Texts with the same
    shingles are near copies, texts without words among them; null text counts
    as empty.  A null id counts as largest, and then the hash of the text
    decides; of rows with one id and text the first by all columns stays.  An
    empty table gives no rows.

    Bands and fingerprints make the groups in few comparisons, and pairs of
    different groups that share enough of their first shingles are then compared
    all, so no link is left out (but by equal 64-bit hashes of different shingles).
    """
    rows = _different_texts(docs, id_col, text_col)
    sketches = cut_lineage(_sketches(rows, id_col, text_col, like))
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "t")).alias("least")
    merged = sketches.groupBy("s").agg(least, *(F.first(c).alias(c) for c in ("keys", "fp", "size", "first", "need", "end", "parity")))
    sets = cut_lineage(merged.select(F.monotonically_increasing_id().alias("n"), "least", F.col("least.t").alias("t"), "keys", "fp", "size", "first", "need", "end", "parity"))
    drop_cut(sketches)
    del sketches, merged
    release_shuffles(docs.sparkSession)
    labels = _grouped(sets, rows.select(F.col(_TEXT).alias("t"), F.col(f"`{text_col}`").alias("text")), like)
    placed = sets.select("n", "least").join(labels, "n", "left")
    first = placed.groupBy(F.coalesce("label", "n").alias("label")).agg(F.min("least").alias("least"))
    first = cut_lineage(first.select(F.col("least.t").alias(_TEXT)))
    drop_cut(sets)
    drop_cut(labels)
    del sets, placed, labels
    release_shuffles(docs.sparkSession)
    return rows.join(first, _TEXT, "left_semi").select(*(F.col(f"`{c}`") for c in docs.columns))
