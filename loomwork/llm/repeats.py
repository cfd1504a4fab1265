"""Repeated byte strings over all texts, by enhanced suffix arrays and their common-prefix interval trees.

A repeat is a string of ``window`` bytes that starts at more than one place.
Which texts share one is not known beforehand, so texts are cut into segments:
runs of neighbouring windows that have the same anchor, the place of the least
hash of the runs of ``k`` bytes in a window.  Equal windows have equal anchors, so
they are in segments of one key, wherever they occur, and keys that occur once
hold no repeat.  Equal segments are one segment with a number of copies.

Segments of one key come together in a shard, which has a suffix array with its
table of longest common prefixes.  A scan with a stack gives all intervals of
suffixes that share a prefix, which is the tree of the array; an interval whose
suffixes all follow the same byte is part of a longer repeat one place to the
left, and the others are the maximal repeats.  All occurrences of these are
given, not just neighbours in the array.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import bucketed, cut_lineage, drop_cut
from .texts import give_back, slices


@dataclass(frozen=True)
class Repeats:
    """Keys are hashes of ``anchors[0]`` bytes.  Segments of one key that together have more than
    ``key_bytes`` are cut again by keys of the next number of bytes; the last number is the window
    itself, where a key has one segment only.  ``shard_bytes`` is about what a shard holds."""

    window: int = 200
    anchors: tuple[int, ...] = (48, 128, 200)
    key_bytes: int = 1 << 20
    shard_bytes: int = 2 << 20
    seed: int = 42

    def __post_init__(self):
        if self.anchors[-1] != self.window or list(self.anchors) != sorted(set(self.anchors)):
            raise ValueError("anchors grow up to the window")


# --- segments ----------------------------------------------------------------------------------


class Segments(NamedTuple):
    """Where each segment begins and ends in the joined texts, its text, and its key."""

    begin: np.ndarray
    end: np.ndarray
    owner: np.ndarray
    key: np.ndarray


_MIX = np.uint64(0xBF58476D1CE4E5B9)


def run_hashes(data: np.ndarray, k: int, seed: int) -> np.ndarray:
    """A hash of the ``k`` bytes from each place on; fewer places than bytes by ``k - 1``."""
    rng = np.random.default_rng(seed)
    table = rng.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
    base = int(rng.integers(0, 1 << 62)) * 2 + 1
    power, out, done, step = table[data], None, 0, 1
    while True:  # power: hashes of ``step`` bytes; out: of the first ``done`` of the k bytes
        if k & step:
            if out is None:
                out = power.copy()
            else:
                n = len(data) - done - step + 1
                out = out[:n] * np.uint64(pow(base, step, 1 << 64)) + power[done : done + n]
            done += step
        if done == k:
            break
        power = power[:-step] * np.uint64(pow(base, step, 1 << 64)) + power[step:]
        step *= 2
    out ^= out >> np.uint64(29)
    out *= _MIX
    out ^= out >> np.uint64(32)
    return out


def sliding_min(values: np.ndarray, w: int) -> np.ndarray:
    """The least of each ``w`` neighbours."""
    size, out = 1, values
    while size * 2 <= w:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    return np.minimum(out[: len(values) - w + 1], out[w - size :]) if size < w else out


def cut_segments(texts: list, k: int, rule: Repeats) -> tuple[np.ndarray, Segments]:
    """The joined texts, and the segments of those of a window's length or more."""
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum(sizes)
    if not (sizes >= rule.window).any():
        none = np.zeros(0, np.int64)
        return data, Segments(none, none, none, none)
    hashes = run_hashes(data, k, rule.seed)
    # the leftmost of equal hashes is the least, as the place is in the lower half
    ranked = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    anchor = (sliding_min(ranked, rule.window - k + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    inside = np.zeros(len(data) + 1, np.int8)
    long = sizes >= rule.window
    np.add.at(inside, (ends - sizes)[long], 1)
    np.add.at(inside, (ends - rule.window + 1)[long], -1)
    places = np.flatnonzero(np.cumsum(inside[:-1], dtype=np.int8))
    anchor = anchor[places]
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (places[1:] != places[:-1] + 1)]))
    begin, last = places[new], places[np.concatenate([new[1:], [len(places)]]) - 1]
    owner = np.searchsorted(ends, begin, side="right")
    return data, Segments(begin, last + rule.window, owner, hashes[anchor[new]].view(np.int64))


# --- the enhanced suffix array -----------------------------------------------------------------

_BASE, _SYMBOL_BITS = 7, 9  # a word holds 7 bytes, each as a symbol from 1 on; 0 stands behind a segment


class SuffixArray:
    """Suffixes of several segments, each up to its segment's end, with ranks at doubling depths."""

    def __init__(self, segments: list[bytes]):
        sizes = np.array([len(s) for s in segments], np.int64)
        self.data = np.frombuffer(b"".join(segments), np.uint8)
        self.begins = np.cumsum(sizes) - sizes
        self.owner = np.repeat(np.arange(len(segments)), sizes)
        self.end = np.repeat(self.begins + sizes, sizes)
        self.n = len(self.data)
        self.depths: list[int] = []
        self.ranks: list[np.ndarray] = []
        self._sort(int(sizes.max(initial=0)))

    def _words(self) -> np.ndarray:
        place, symbols = np.arange(self.n), np.append(self.data.astype(np.uint64) + np.uint64(1), np.zeros(_BASE, np.uint64))
        words = np.zeros(self.n, np.uint64)
        for j in range(_BASE):
            here = np.where(place + j < self.end, symbols[j : j + self.n], np.uint64(0))
            words = (words << np.uint64(_SYMBOL_BITS)) | here
        return words

    def _sort(self, longest: int) -> None:
        """Ranks are places of a group's first in the array, so groups are refined each by itself."""
        open_, key, depth = np.arange(self.n), self._words(), _BASE
        first, rank = np.zeros(self.n, np.int64), np.zeros(self.n, np.int32)
        while True:
            order = np.argsort(first * (self.n + 1) + key if self.ranks else key)
            open_, key, first = open_[order], key[order], first[order]
            new = np.concatenate([[True], (key[1:] != key[:-1]) | (first[1:] != first[:-1])]) if len(key) else np.zeros(0, bool)
            at = np.flatnonzero(new)
            group = np.cumsum(new) - 1
            # within the old group, the number of entries before this one's new group
            old = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]])) if len(key) else at
            old_at = old[np.searchsorted(old, at, side="right") - 1]
            rank = rank.copy()
            rank[open_] = (first[at] + at - old_at)[group]
            self.depths.append(depth)
            self.ranks.append(rank)
            several = np.diff(np.append(at, len(key)))[group] > 1
            open_ = open_[several & (self.end[open_] - open_ >= depth)]  # equal ones that ended before stay equal
            if depth >= longest or not len(open_):
                return
            first = rank[open_].astype(np.int64)
            after = open_ + depth
            key = np.where(after < self.end[open_], rank[np.minimum(after, self.n - 1)].astype(np.int64) + 1, 0)
            depth *= 2

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the longest common prefixes of pairs of suffixes."""
        out = np.zeros(len(a), np.int64)
        most = np.minimum(self.end[a] - a, self.end[b] - b)
        for depth, rank in zip(reversed(self.depths), reversed(self.ranks)):
            active = np.flatnonzero(out < most)
            x, y = a[active] + out[active], b[active] + out[active]
            out[active[rank[x] == rank[y]]] += depth
        out = np.minimum(out, most)
        for _ in range(_BASE):
            active = np.flatnonzero(out < most)
            same = self.data[a[active] + out[active]] == self.data[b[active] + out[active]]
            out[active[same]] += 1
        return out


class Interval(NamedTuple):
    """Suffixes ``first`` to ``last`` of the array share ``length`` bytes, and no more of them do."""

    length: int
    first: int
    last: int


def intervals(common: list[int], least: int, start: int = 0) -> Iterator[Interval]:
    """The intervals of ``least`` bytes and more, inner ones first; ``common[i]`` is what suffixes
    ``i`` and ``i + 1`` share."""
    stack: list[tuple[int, int]] = []
    for i, length in enumerate([*common, 0], start):
        begin = i
        while stack and stack[-1][0] > length:
            shared, begin = stack.pop()
            yield Interval(shared, begin, i)
        if length >= least and (not stack or stack[-1][0] < length):
            stack.append((length, begin))


class Tree(NamedTuple):
    """The diverse intervals of some segments' suffixes of a window's length and more."""

    array: SuffixArray
    places: np.ndarray  # where each suffix begins, in the order of the array
    length: np.ndarray
    first: np.ndarray
    last: np.ndarray

    def spans(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Segment, first and last byte (excluded) of all that a maximal repeat covers; these meet nowhere."""
        reach = np.zeros(len(self.places), np.int64)
        for i in np.argsort(self.length, kind="stable").tolist():  # intervals within others are longer
            reach[self.first[i] : self.last[i] + 1] = self.length[i]
        some = np.flatnonzero(reach)
        change = np.zeros(self.array.n + 1, np.int32)
        np.add.at(change, self.places[some], 1)
        np.add.at(change, self.places[some] + reach[some], -1)
        hit = np.cumsum(change[:-1]) > 0
        border = np.zeros(self.array.n, bool)
        border[self.array.begins[self.array.begins < self.array.n]] = True
        begin = np.flatnonzero(hit & (border | ~np.concatenate([[False], hit[:-1]])))
        end = np.flatnonzero(hit & np.concatenate([border[1:] | ~hit[1:], [True]])) + 1 if len(hit) else begin
        owner = self.array.owner[begin]
        return owner, begin - self.array.begins[owner], end - self.array.begins[owner]

    def occurrences(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Of each maximal repeat the length, and segment and first byte of all its occurrences."""
        for length, first, last in zip(self.length.tolist(), self.first.tolist(), self.last.tolist()):
            place = self.places[first : last + 1]
            owner = self.array.owner[place]
            yield length, owner, place - self.array.begins[owner]


def maximal_repeats(segments: list[bytes], window: int) -> Tree:
    """The strings of ``window`` bytes or more that are found twice in the segments and that are not
    always part of the same longer one."""
    array = SuffixArray(segments)
    none = np.zeros(0, np.int64)
    places = np.flatnonzero(array.end - np.arange(array.n) >= window) if array.n else none
    places = places[np.argsort(array.ranks[-1][places], kind="stable")]
    if len(places) < 2:
        return Tree(array, places, none, none, none)
    common = array.common(places[:-1], places[1:])
    # what stands before each suffix; before a segment's first byte anything may
    left = array.data[np.maximum(places - 1, 0)].astype(np.int64)
    at_start = array.begins[array.owner[places]] == places
    left[at_start] = 256 + np.arange(int(at_start.sum()))
    changes = np.concatenate([[0], np.cumsum(left[1:] != left[:-1])])
    repeated = np.concatenate([[False], common >= window, [False]])
    edges = np.flatnonzero(repeated[1:] != repeated[:-1])
    found: list[Interval] = []
    for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist()):
        if changes[hi] > changes[lo]:  # else no interval within is diverse
            found += [i for i in intervals(common[lo:hi].tolist(), window, lo) if changes[i.last] > changes[i.first]]
    length, first, last = (np.array(x, np.int64) for x in zip(*found)) if found else (none, none, none)
    return Tree(array, places, length, first, last)


# --- Spark -------------------------------------------------------------------------------------

_PIECE = "g binary, n long, off long, len int, m long, s binary"
_SPAN = "s binary, lo long, hi long"


def text_key(text: Column) -> Column:
    """16 bytes of a hash that tell texts apart."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def distinct_texts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(g, n, data)``: key, number of rows and bytes of each different text, placed by key.

    Copies are combined before they move; joins on the key don't move the texts again.
    """
    data = docs.select(F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("data"))
    groups = data.withColumn("g", text_key(F.col("data"))).groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.first("data").alias("data"))
    return bucketed(groups, "g", placed=True)


def _cuts(batch: pa.RecordBatch, k: int, rule: Repeats, size: int = 4 << 20) -> Iterator[tuple]:
    """The segments of the rows ``(g, n, data)``: joined texts, segments, row and place of each.

    A long text is taken in parts that overlap by all but one byte of a window,
    so every window is in one part, and memory is bounded.
    """
    for part in slices(batch, 2, size=size):
        row, start, texts = [], [], []
        for i, text in enumerate(part.column(2).to_pylist()):
            for at in range(0, max(1, len(text) - rule.window + 1), size):
                row.append(i)
                start.append(at)
                texts.append(text[at : at + size + rule.window - 1])
                if len(text) > size:
                    yield part, *_placed(row, start, texts, k, rule)
                    row, start, texts = [], [], []
        if texts:
            yield part, *_placed(row, start, texts, k, rule)


def _placed(row: list[int], start: list[int], texts: list[bytes], k: int, rule: Repeats) -> tuple:
    data, cut = cut_segments(texts, k, rule)
    begins = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    return data, cut, np.array(row)[cut.owner], cut.begin - begins[cut.owner] + np.array(start)[cut.owner]


def _keys(texts: DataFrame, k: int, rule: Repeats) -> DataFrame:
    """``(m, n)``: keys of the segments with their numbers, those of a batch added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _, cut, row, _ in _cuts(batch, k, rule):
                keys, at = np.unique(cut.key, return_inverse=True)
                n = np.bincount(at, np.asarray(part.column(1))[row], len(keys)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], ["m", "n"])
        give_back()

    return texts.select("g", "n", "data").mapInArrow(run, "m long, n long")


def _pieces(texts: DataFrame, k: int, rule: Repeats) -> DataFrame:
    """The segments of all texts: text, its copies, place, size, key, and 16 bytes of a hash of its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            for part, data, cut, row, off in _cuts(batch, k, rule):
                view, rows = memoryview(data), pa.array(row)
                hashes = [digest(view[a:b]) for a, b in zip(cut.begin.tolist(), cut.end.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(rows), part.column(1).take(rows), pa.array(off),
                        pa.array((cut.end - cut.begin).astype(np.int32)), pa.array(cut.key), pa.array(hashes, pa.binary()),
                    ],
                    ["g", "n", "off", "len", "m", "s"],
                )
        give_back()

    return texts.select("g", "n", "data").mapInArrow(run, _PIECE)


def _fetch(segments: DataFrame, texts: DataFrame) -> DataFrame:
    """``(s, n, data, m)`` of segments, each from one text that has it; a text is read once for all."""
    wanted = segments.groupBy("at.g").agg(F.collect_list(F.struct("s", "n", "m", "at.off", "at.len")).alias("all"))
    cut = F.transform("all", lambda x: F.struct(x.s.alias("s"), x.n.alias("n"), x.m.alias("m"), F.substring(F.col("data"), (x.off + 1).cast("int"), x.len).alias("data")))
    return texts.select("g", "data").join(wanted, "g").select(F.explode(cut).alias("x")).select("x.s", "x.n", "x.data", "x.m")


def _in_shards(segments: DataFrame, shards: int, rule: Repeats, groups: bool) -> DataFrame:
    """What maximal repeats cover in segments that are placed together by their keys; with ``groups``
    each occurrence of each by itself, and 16 bytes of a hash of the repeated string."""

    def run(table: pa.Table) -> pa.Table:
        names, data = table.column("s").combine_chunks(), table.column("data").to_pylist()
        copied = np.flatnonzero(np.asarray(table.column("n")) > 1)  # all of a segment that has copies is a repeat
        sizes = np.array([len(d) for d in data], np.int64)[copied]
        tree = maximal_repeats(data, rule.window)
        if groups:
            found = [(length, s, a) for length, owner, at in tree.occurrences() for s, a in zip(owner.tolist(), at.tolist())]
            segment, lo = np.array([s for _, s, _ in found], np.int64), np.array([a for *_, a in found], np.int64)
            hi = lo + np.array([length for length, *_ in found], np.int64)
        else:
            segment, lo, hi = tree.spans()
        columns = [
            names.take(pa.array(np.concatenate([segment, copied]))), pa.array(np.concatenate([lo, np.zeros_like(copied)])),
            pa.array(np.concatenate([hi, sizes])),
        ]
        if not groups:
            return pa.Table.from_arrays(columns, ["s", "lo", "hi"])
        strings = [xxhash.xxh3_128_digest(data[s][a:b]) for s, a, b in zip(segment.tolist(), lo.tolist(), hi.tolist())]
        return pa.Table.from_arrays([*columns, pa.array(strings + names.take(pa.array(copied)).to_pylist(), pa.binary())], ["s", "lo", "hi", "repeat"])

    shard = F.pmod(F.xxhash64("m"), F.lit(shards)).alias("shard")
    return segments.select("s", "n", "data", shard).groupBy("shard").applyInArrow(run, _SPAN + ", repeat binary" * groups)


def occurrences(texts: DataFrame, rule: Repeats = Repeats(), groups: bool = False, level: int = 0) -> DataFrame:
    """``(g, lo, hi)``: what repeats cover in the texts of ``distinct_texts``; with ``groups`` also
    ``repeat``, 16 bytes of a hash of each repeated string, and a row for each occurrence of each,
    which among n texts that differ here and there can be as many as n².

    Long repeats are cut at the borders of segments; neighbouring parts overlap
    by all but one byte of a window.  Keys are counted before segments move, only
    segments of keys that occur again go on, and the bytes of a segment are sent
    once, however many texts have it.  A key with very many different segments is
    cut again by longer runs of bytes, so no shard grows with the input.  What is
    joined with rows of a frequent key is written first, so that Spark can split
    these rows.
    """
    last = level + 1 == len(rule.anchors)
    again = cut_lineage(_keys(texts, rule.anchors[level], rule).groupBy("m").agg(F.sum("n").alias("n")).where("n > 1").select("m"))
    shared = cut_lineage(_pieces(texts, rule.anchors[level], rule).join(again, "m", "left_semi"))
    drop_cut(again)
    kinds = cut_lineage(shared.groupBy("m", "s").agg(F.sum("n").alias("n"), F.min(F.struct("g", "off", "len")).alias("at")))
    sizes = cut_lineage(kinds.groupBy("m").agg(F.count(F.lit(1)).alias("kinds"), F.sum("at.len").alias("bytes")))
    told = cut_lineage(kinds.join(sizes, "m"))
    drop_cut(kinds)
    drop_cut(sizes)

    size = F.col("at.len").cast("long")
    copies = told.where("kinds = 1").select("s", F.lit(0).cast("long").alias("lo"), size.alias("hi"), *[F.col("s").alias("repeat")] * groups)
    large = (F.col("bytes") > rule.key_bytes) & F.lit(not last)
    several = told.where("kinds > 1")
    n = several.agg(*(F.coalesce(F.sum(F.when(c, size)), F.lit(0)).alias(x) for c, x in ((~large, "small"), (large, "large")))).first()
    found = copies
    if n.small:
        found = found.unionByName(_in_shards(_fetch(several.where(~large), texts), n.small // rule.shard_bytes + 1, rule, groups))
    if n.large:
        again_texts = cut_lineage(_fetch(several.where(large), texts).select(F.col("s").alias("g"), "n", "data"))
        found = found.unionByName(occurrences(again_texts, rule, groups, level + 1).withColumnRenamed("g", "s"))
    return shared.select("g", "off", "s").join(found, "s").select(
        "g", (F.col("off") + F.col("lo")).alias("lo"), (F.col("off") + F.col("hi")).alias("hi"), *["repeat"] * groups
    )


_STRIPPED = "g binary, n_bytes long, n_removed long, n_spans long, spans array<struct<lo:bigint,hi:bigint>>, kept binary"


def merged(spans: np.ndarray) -> np.ndarray:
    """Spans that meet or overlap as one; in order."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    first = np.flatnonzero(np.concatenate([[True], spans[1:, 0] > reach[:-1]]))
    return np.stack([spans[first, 0], reach[np.concatenate([first[1:], [len(spans)]]) - 1]], axis=1)


def strip(texts: DataFrame, found: DataFrame) -> DataFrame:
    """Each text without the bytes of its repeats: ``g, n_bytes, n_removed, n_spans, spans, kept``."""
    spans = found.groupBy("g").agg(F.collect_list(F.struct("lo", "hi")).alias("found"))
    rows = texts.select("g", "data").join(spans, "g", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, size=8 << 20):
                out: list[tuple] = []
                lists = part.column(2)
                for i, data in enumerate(part.column(1).to_pylist()):
                    if not lists[i].is_valid:
                        out.append((len(data), 0, 0, [], data))
                        continue
                    both = lists[i].values
                    runs = merged(np.stack([np.asarray(both.field(0)), np.asarray(both.field(1))], axis=1)).tolist()
                    kept = b"".join(data[a:b] for a, b in zip([0, *(hi for _, hi in runs)], [*(lo for lo, _ in runs), len(data)]))
                    out.append((len(data), len(data) - len(kept), len(runs), [{"lo": lo, "hi": hi} for lo, hi in runs], kept))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])), pa.binary())
                arrays = [pa.array(v, t) for v, t in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays([part.column(0), *arrays], ["g", "n_bytes", "n_removed", "n_spans", "spans", "kept"])
        give_back()

    return rows.mapInArrow(run, _STRIPPED)


def stripped_texts(docs: DataFrame, text_col: str = "text", rule: Repeats = Repeats()) -> DataFrame:
    """``strip`` over the different texts of a table."""
    texts = distinct_texts(docs, text_col)
    return strip(texts, occurrences(texts, rule))


_KEY = "__text_key"


def with_stripped(docs: DataFrame, stripped: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the columns of ``stripped`` in the place of its text; extra columns whose names
    clash with these go.

    What a text loses depends on the whole table and not on its row, so copies
    get equal results.  Null text counts as empty; a text shorter than the window
    loses nothing; rows are kept whatever they lose.
    """
    keyed = docs.withColumn(_KEY, text_key(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))
    keyed = keyed.drop(text_col, *(c for c in stripped.columns if c in keyed.columns))
    return keyed.join(stripped.withColumnRenamed("g", _KEY), _KEY).drop(_KEY)


def remove_repeats(docs: DataFrame, text_col: str = "text", rule: Repeats = Repeats()) -> DataFrame:
    """``docs`` with ``n_bytes, n_removed, n_spans, spans`` and ``kept``, the bytes left, which may cut a
    character; see ``with_stripped``.  An empty table gives no rows."""
    return with_stripped(docs, stripped_texts(docs, text_col, rule), text_col)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Repeats = Repeats()) -> DataFrame:
    """``id_col, n_bytes, n_removed, n_spans, kept_sha256``."""
    kept = stripped_texts(docs, text_col, rule).select("g", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    return with_stripped(docs.select(id_col, text_col), kept, text_col)


def repeat_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Repeats = Repeats()) -> DataFrame:
    """``(repeat, id_col, lo, hi)``: all rows and places where each maximal repeat occurs."""
    texts = distinct_texts(docs, text_col)
    keyed = docs.select(id_col, text_key(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("g"))
    return keyed.join(occurrences(texts, rule, groups=True).distinct(), "g").select("repeat", id_col, "lo", "hi")
