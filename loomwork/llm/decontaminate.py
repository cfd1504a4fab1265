"""Benchmark decontamination with suffix arrays over shards of the training text."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from ..storage import new_path
from .texts import as_bytes, byte_table, map_batches, slices, words_of

# Bytes that separate words, before A-Z are lowered.
_SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
WORDS = byte_table(_SEPARATORS, lower=True)
SHARD_BYTES = 1 << 20  # of text in a shard, if the benchmark isn't larger
MOST_SHARD_BYTES = 4 << 20


@dataclass(frozen=True)
class Rule:
    """A document word in an occurrence of ``window`` consecutive item words is hit; shorter items
    are one window.  With at least one hit, and hits of one word in ``share`` or more, the document
    is contaminated."""

    window: int = 13
    share: int = 20


class Patterns(NamedTuple):
    """Distinct windows of a block of items, as rows of word codes (0 beyond the end)."""

    vocabulary: pa.Array  # code i + 1
    rows: np.ndarray
    sizes: np.ndarray
    windows: np.ndarray  # pattern and item of each pair of the two
    owners: np.ndarray
    item_ids: list


def patterns_of(item_ids: list, texts: list[bytes], window: int) -> Patterns:
    words = words_of(texts, WORDS)
    rows, owners = [], []
    for i, n in enumerate(words.lengths):
        codes = words.codes[words.bounds[i] : words.bounds[i + 1]] + 1
        if n:
            size = min(n, window)
            view = np.lib.stride_tricks.sliding_window_view(codes, size)
            padded = np.zeros((len(view), window), np.int64)
            padded[:, :size] = view
            rows.append(padded)
            owners.append(np.full(len(view), i))
    if not rows:
        empty = np.zeros(0, np.int64)
        return Patterns(words.types, np.zeros((0, window), np.int64), empty, empty, empty, item_ids)
    unique, place = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
    pairs = np.unique(np.stack([place.ravel(), np.concatenate(owners)], axis=1), axis=0)
    return Patterns(words.types, unique, (unique > 0).sum(axis=1), pairs[:, 0], pairs[:, 1], item_ids)


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``codes`` in the order of the ``depth`` or more codes from there on.

    Codes of 0 end a suffix, and suffixes that begin with one are left out: such
    a word is in no item, so no match can hold it.  The first key packs several
    codes; each later round doubles the length that is in order.
    """
    bits = max(1, int(codes.max(initial=1)).bit_length())
    reach = max(1, min(63 // bits, depth))
    n = len(codes)
    padded = np.concatenate([codes.astype(np.int64), np.zeros(reach, np.int64)])
    key = np.zeros(n, np.int64)
    alive = np.ones(n, bool)
    for i in range(reach):  # what follows a 0 doesn't count
        alive &= padded[i : i + n] > 0
        key = (key << bits) | np.where(alive, padded[i : i + n], 0)
    at = np.flatnonzero(codes)
    while True:
        order = at[np.argsort(key[at])]
        if reach >= depth:
            return order
        step = np.concatenate([[1], key[order[1:]] != key[order[:-1]]]) if len(order) else np.zeros(0, np.int64)
        rank = np.zeros(n, np.int64)
        rank[order] = np.cumsum(step)
        follow = np.concatenate([rank[reach:], np.zeros(min(reach, n), np.int64)])[:n]
        # a suffix cut off by a 0 has rank 0 there only if the 0 is right at its end
        cut = np.zeros(n + 1, np.int64)
        cut[1:] = np.cumsum(codes == 0)
        whole = cut[np.minimum(np.arange(n) + reach, n)] == cut[:n]
        key = (rank << 32) | np.where(whole, follow, 0)
        reach *= 2


def search(codes: np.ndarray, order: np.ndarray, rows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every row the range of ``order`` whose suffixes begin with it, by binary search."""
    width = rows.shape[1]
    padded = np.concatenate([codes, np.zeros(width, codes.dtype)])

    def bound(after: bool) -> np.ndarray:
        lo, hi = np.zeros(len(rows), np.int64), np.full(len(rows), len(order), np.int64)
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo
            mid = (lo[open_] + hi[open_]) // 2
            start, size, row = order[mid], sizes[open_], rows[open_]
            sign = np.zeros(len(open_), np.int64)  # of suffix against row
            ended = np.zeros(len(open_), bool)
            for k in range(width):
                got = np.where(ended, 0, padded[start + k])
                ended |= got == 0
                sign = np.where((sign == 0) & (k < size), np.sign(got - row[:, k]), sign)
            right = sign < 0 if not after else sign <= 0
            lo[open_] = np.where(right, mid + 1, lo[open_])
            hi[open_] = np.where(right, hi[open_], mid)

    return bound(False), bound(True)


class Found(NamedTuple):
    """Occurrences of patterns in a shard: word position, pattern."""

    position: np.ndarray
    pattern: np.ndarray


def occurrences(codes: np.ndarray, patterns: Patterns) -> Found:
    order = suffix_array(codes, patterns.rows.shape[1])
    first, last = search(codes, order, patterns.rows, patterns.sizes)
    n = last - first
    pattern = np.repeat(np.arange(len(n)), n)
    ends = np.cumsum(n)
    return Found(order[np.repeat(first - (ends - n), n) + np.arange(n.sum())], pattern)


def _longest(found: Found, patterns: Patterns, words) -> tuple[np.ndarray, np.ndarray]:
    """Longest run of hit words made of windows that begin one after the other, and its beginning.

    Such windows overlap in all but one word, so a run of them is a passage of
    the document of which every window is verbatim in the benchmark.
    """
    n_docs = len(words.bounds) - 1
    length, begin = np.zeros(n_docs, np.int64), np.full(n_docs, -1, np.int64)
    at, where = np.unique(found.position, return_inverse=True)
    if not len(at):
        return length, begin
    size = np.zeros(len(at), np.int64)
    np.maximum.at(size, where, patterns.sizes[found.pattern])
    owner = np.searchsorted(words.bounds, at, side="right") - 1
    fresh = np.concatenate([[True], (np.diff(at) != 1) | (np.diff(owner) != 0)])
    run = np.cumsum(fresh) - 1
    ends = np.zeros(run[-1] + 1, np.int64)
    np.maximum.at(ends, run, at + size)
    starts, docs = at[fresh], owner[fresh]
    by_doc = np.lexsort((starts, starts - ends, docs))  # the longest of each document, then the earliest
    best = by_doc[np.unique(docs[by_doc], return_index=True)[1]]
    length[docs[best]], begin[docs[best]] = (ends - starts)[best], starts[best] - words.bounds[docs[best]]
    return length, begin


FIELDS = (
    StructField("n_words", LongType()), StructField("n_hit", LongType()), StructField("n_items", LongType()),
    StructField("items_sha256", StringType()), StructField("contaminated", BooleanType()),
    StructField("longest_match", LongType()), StructField("longest_at", LongType()),
)


class Index:
    """The benchmark in blocks, as files that every task can read one at a time."""

    def __init__(self, items: DataFrame, id_col: str, text_col: str, rule: Rule, block_bytes: int):
        self.rule = rule
        self.folder = new_path(items.sparkSession, "benchmark")
        rows = items.select(F.col(id_col).cast("string").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n
        blocks = -(-size // block_bytes) or 1
        # a shard's arrays take some 40 times its bytes; with one much smaller than the benchmark, searches cost more than the sort
        self.shard_bytes = min(max(size, SHARD_BYTES), MOST_SHARD_BYTES)
        rows.repartition(blocks, F.xxhash64("id", "text")).write.parquet(self.folder)
        self._cache: tuple[str, Patterns] | None = None

    def __getstate__(self):
        return {"rule": self.rule, "folder": self.folder, "shard_bytes": self.shard_bytes, "_cache": None}

    def blocks(self) -> Iterator[Patterns]:
        """One block is in memory at a time."""
        fs, base = pafs.FileSystem.from_uri(self.folder)
        files = sorted(f.path for f in fs.get_file_info(pafs.FileSelector(base)) if f.path.endswith(".parquet"))
        for path in files:
            if self._cache is None or self._cache[0] != path:
                with fs.open_input_file(path) as file:
                    table = pq.read_table(file)
                ids = table.column("id").to_pylist()
                texts = as_bytes(table.column("text").combine_chunks())
                self._cache = path, patterns_of(ids, texts, self.rule.window)
            yield self._cache[1]


def _inspect(column: pa.Array, index: Index) -> list[list]:
    """The values of ``FIELDS`` for a column of texts, one shard of it after the other."""
    rows = pa.RecordBatch.from_arrays([column], ["text"])
    shards = [_inspect_shard(as_bytes(part.column(0)), index) for part in slices(rows, 0, size=index.shard_bytes)]
    return [[v for shard in shards for v in shard[i]] for i in range(len(FIELDS))]


def _inspect_shard(texts: list[bytes], index: Index) -> list[list]:
    words = words_of(texts, WORDS)
    n_docs, n_words = len(texts), len(words.codes)
    hit = np.zeros(n_words + 1, bool)
    items: list[set] = [set() for _ in texts]
    longest, longest_at = np.zeros(n_docs, np.int64), np.full(n_docs, -1, np.int64)
    # one place after every document keeps matches within it
    place = np.arange(n_words) + words.owner
    for patterns in index.blocks():
        if not len(patterns.rows):
            continue
        known = pc.fill_null(pc.index_in(words.types, value_set=patterns.vocabulary), -1)
        codes = np.zeros(n_words + n_docs, np.int64)
        codes[place] = (np.asarray(known).astype(np.int64) + 1)[words.codes]
        found = occurrences(codes, patterns)
        owner = np.searchsorted(words.bounds + np.arange(n_docs + 1), found.position, side="right") - 1
        found = Found(found.position - owner, found.pattern)
        change = np.zeros(n_words + 1, np.int64)
        np.add.at(change, found.position, 1)
        np.add.at(change, found.position + patterns.sizes[found.pattern], -1)
        hit |= np.cumsum(change) > 0
        pairs = np.unique(np.stack([owner, found.pattern], axis=1), axis=0)
        lo, hi = np.searchsorted(patterns.windows, pairs[:, 1]), np.searchsorted(patterns.windows, pairs[:, 1], side="right")
        for doc, a, b in zip(pairs[:, 0].tolist(), lo.tolist(), hi.tolist()):
            items[doc].update(patterns.item_ids[o] for o in patterns.owners[a:b].tolist())
        length, begin = _longest(found, patterns, words)
        better = length > longest
        longest[better], longest_at[better] = length[better], begin[better]
    hits = np.concatenate([[0], np.cumsum(hit[:n_words])])
    n_hit = hits[words.bounds[1:]] - hits[words.bounds[:-1]]
    share = index.rule.share
    return [
        words.lengths.tolist(), n_hit.tolist(), [len(s) for s in items],
        [hashlib.sha256(",".join(sorted(i for i in s if i is not None)).encode()).hexdigest() for s in items],
        ((n_hit > 0) & (share * n_hit >= words.lengths)).tolist(), longest.tolist(), longest_at.tolist(),
    ]


_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.int64())


def inspect(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text", rule: Rule = Rule(), block_bytes: int = 4 << 20,
) -> DataFrame:
    """Per row of ``docs``: words, hit words, items found, verdict, and the longest verbatim match.

    Each Arrow batch of documents is cut into shards with suffix arrays of their
    own, in which every suffix of every item is searched for; nothing is shuffled.
    The benchmark is read in blocks of ``block_bytes``, whatever its size, and a
    shard is of ``SHARD_BYTES`` or, if that is more, of the benchmark's size up to ``MOST_SHARD_BYTES``.
    ``items_sha256`` is of the item ids in string order, joined by commas; items
    without an id count together as one and are not in it.  ``longest_match`` is
    in words and ``longest_at`` is the word it begins at (-1 without a match).
    Null or empty texts have no words and are not contaminated; empty items have
    no windows; repeated rows get equal results.
    """
    index = Index(items, item_id, item_text, rule, block_bytes)
    rows = docs.select(id_col, text_col)

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = _inspect(batch.column(1), index)
        arrays = [pa.array(v, t) for v, t in zip(values, _TYPES)]
        return pa.RecordBatch.from_arrays([batch.column(0), *arrays], [id_col, *(f.name for f in FIELDS)])

    return map_batches(rows, of, StructType([rows.schema[0], *FIELDS]))


def drop_contaminated(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
    item_text: str = "text", rule: Rule = Rule(), block_bytes: int = 4 << 20,
) -> DataFrame:
    """The rows that ``inspect`` doesn't call contaminated, with all columns."""
    index = Index(items, item_id, item_text, rule, block_bytes)
    at, verdict = docs.columns.index(text_col), [f.name for f in FIELDS].index("contaminated")

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        bad = _inspect(batch.column(at), index)[verdict]
        return batch.filter(pa.array([not b for b in bad], pa.bool_()))

    return map_batches(docs, of, docs.schema)
