"""Fill-in-the-middle texts, cut at counted units with memoized content-defined chunks.

A unit is a run of the letters A-Z and a-z, or any other single character.  A
rolling hash over the last bytes cuts texts into chunks whose borders follow
from their content, so passages that many documents share fall into equal
chunks.  A summary of each chunk (units, characters, whether letters stand at
its ends) is remembered under the chunk's hash and used only if the remembered
content is the same.  Sums of summaries, less one unit for every run of letters
that goes on over a border, count a text's units and say which chunk a cut is
in; only that chunk is looked into.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .texts import as_bytes, give_back, slices

# The marks of the parts, and the shares of the forms in percent.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))


@dataclass(frozen=True)
class Form:
    """``plain_from`` and up of a hundred stay plain; below ``spm_below`` of a hundred the suffix stands first."""

    salt: str = "1"
    plain_from: int = 90
    spm_below: int = 20


@dataclass(frozen=True)
class Chunking:
    """A border follows a byte where the rolling hash begins with ``bits`` zeros; chunks are ``least`` to
    ``most`` bytes long but for a text's last.  Neither changes any result."""

    bits: int = 9
    least: int = 64
    most: int = 4096
    remember_bytes: int = 64 << 20


class Summary(NamedTuple):
    units: int
    chars: int
    letter_first: bool
    letter_last: bool


# --- counting ----------------------------------------------------------------------------------

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_BEGINS = np.array([b & 0xC0 != 0x80 for b in range(256)])  # not the second or later byte of a character
_ALONE = _BEGINS & ~_LETTER  # first bytes of characters that are units of their own


def unit_starts(data: np.ndarray) -> np.ndarray:
    """Whether a unit starts at each byte."""
    letter = _LETTER[data]
    first = letter.copy()
    first[1:] &= ~letter[:-1]
    return first | _ALONE[data]


def summarize(chunk: bytes) -> Summary:
    data = np.frombuffer(chunk, np.uint8)
    return Summary(
        int(unit_starts(data).sum()), int(_BEGINS[data].sum()), bool(_LETTER[data[0]]), bool(_LETTER[data[-1]])
    )


def gear_table(seed: int = 7) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 32, 256, np.uint32)


_GEAR = gear_table()


def rolling(data: np.ndarray) -> np.ndarray:
    """At each byte the sum of table values of the last 32 bytes, each shifted by its age."""
    h = _GEAR[data]
    for age in (1, 2, 4, 8, 16):
        if len(h) > age:
            h[age:] = h[age:] + (h[:-age] << np.uint32(age))  # the right side is computed first
    return h


def borders(data: np.ndarray, chunking: Chunking) -> list[int]:
    """Where chunks end, the end of the text among them; none for an empty text."""
    if not len(data):
        return []
    mask = np.uint32(((1 << chunking.bits) - 1) << (32 - chunking.bits))
    out, at = [], 0
    for border in (np.flatnonzero((rolling(data) & mask) == 0) + 1).tolist():
        if border - at < chunking.least:
            continue
        while border - at > chunking.most:
            at += chunking.most
            out.append(at)
        if border - at >= chunking.least or border == len(data):
            out.append(border)
            at = border
    while len(data) - at > chunking.most:
        at += chunking.most
        out.append(at)
    if at < len(data):
        out.append(len(data))
    return out


class Memo:
    """Summaries of chunks seen, under their hash, with the content that each was made from."""

    def __init__(self, chunking: Chunking):
        self.chunking, self.known, self.held = chunking, {}, 0
        self.hits = self.misses = 0

    def summary(self, chunk: bytes) -> Summary:
        key = xxhash.xxh3_64_intdigest(chunk)
        found = self.known.get(key)
        if found is not None and found[0] == chunk:
            self.hits += 1
            return found[1]
        self.misses += 1
        made = summarize(chunk)
        if self.held > self.chunking.remember_bytes:  # starts afresh; what is remembered changes no result
            self.known, self.held = {}, 0
        self.known[key] = chunk, made
        self.held += len(chunk) + 200
        return made


class Counted(NamedTuple):
    """A text's chunks: where each begins and ends, and units and characters before each border."""

    edges: np.ndarray
    units: np.ndarray
    chars: np.ndarray
    joined: np.ndarray  # whether a chunk's first letters go on from the chunk before

    @property
    def n(self) -> int:
        return int(self.units[-1])


def count_units(text: bytes, memo: Memo) -> Counted:
    edges = [0, *borders(np.frombuffer(text, np.uint8), memo.chunking)]
    found = [memo.summary(text[a:b]) for a, b in zip(edges, edges[1:])]
    units = np.array([s.units for s in found], np.int64)
    joined = np.zeros(len(found), bool)
    if found:
        joined[1:] = [a.letter_last and b.letter_first for a, b in zip(found, found[1:])]
    total = lambda x: np.concatenate([[0], np.cumsum(x)]).astype(np.int64)
    return Counted(np.array(edges), total(units - joined), total([s.chars for s in found]), joined)


def locate(text: bytes, counted: Counted, cut: int) -> tuple[int, int]:
    """Bytes and characters before the unit numbered ``cut`` from 0; the whole text's for its end."""
    if cut >= counted.n:
        return len(text), int(counted.chars[-1])
    at = int(np.searchsorted(counted.units, cut, side="right")) - 1
    begin = int(counted.edges[at])
    data = np.frombuffer(text[begin : counted.edges[at + 1]], np.uint8)
    starts = np.flatnonzero(unit_starts(data))
    place = int(starts[cut - int(counted.units[at]) + int(counted.joined[at])])
    return begin + place, int(counted.chars[at]) + int(_BEGINS[data[:place]].sum())


# --- Spark -------------------------------------------------------------------------------------

_H = "__draws"  # beside all columns of a caller's table
FIELDS = [
    StructField("n", LongType()), StructField("form", StringType()), StructField("prefix_chars", LongType()),
    StructField("middle_chars", LongType()), StructField("output", StringType()),
]
_TYPES = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]


@lru_cache(maxsize=1)
def _memo(chunking: Chunking) -> Memo:
    """One for all tasks that a worker runs."""
    return Memo(chunking)


def _draws(id_col: str, form: Form) -> Column:
    """Four numbers from the hash of a row's id; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{form.salt}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)])


def rearrange(text: bytes, draws: list[int], memo: Memo, form: Form = Form()) -> tuple:
    """The values of ``FIELDS`` for one text."""
    counted = count_units(text, memo)
    n = counted.n
    if not text or any(mark in text for mark in MARKS) or draws[2] % 100 >= form.plain_from:
        return n, "plain", None, None, text
    first, last = sorted(h % (n + 1) for h in draws[:2])
    (a, chars_a), (b, chars_b) = locate(text, counted, first), locate(text, counted, last)
    p, s, m = MARKS
    if draws[3] % 100 < form.spm_below:
        return n, "spm", chars_a, chars_b - chars_a, b"".join((s, text[b:], p, text[:a], m, text[a:b]))
    return n, "psm", chars_a, chars_b - chars_a, b"".join((p, text[:a], s, text[b:], m, text[a:b]))


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", form: Form = Form(), chunking: Chunking = Chunking()
) -> DataFrame:
    """``id_col`` with ``n`` units, ``form``, lengths of prefix and middle in characters, and ``output``.

    Null text counts as empty and stays plain, as do texts that hold a mark.
    Rows with one id are cut by the same draws; repeated rows give equal rows; an
    empty table gives none.  Nothing moves between tasks, and a task holds some
    rows of one Arrow batch and a bounded memory of chunks, whatever texts it
    meets.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), _draws(id_col, form).alias(_H))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _memo(chunking)
        for batch in batches:
            for part in slices(batch, 1):
                made = [rearrange(t, h, memo, form) for t, h in zip(as_bytes(part.column(1)), part.column(2).to_pylist())]
                values = [list(v) for v in zip(*made)]
                values[4] = pa.array(values[4], pa.binary()).cast(pa.string())
                arrays = [part.column(0), *(pa.array(v, t) if isinstance(v, list) else v for v, t in zip(values, _TYPES))]
                yield pa.RecordBatch.from_arrays(arrays, ["id", *(f.name for f in FIELDS)])
        give_back()

    out = rows.mapInArrow(run, StructType([rows.schema[0], *FIELDS]))
    return out.withColumnRenamed("id", id_col) if id_col != "id" else out


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from.

    No part holds a mark, and a mark cannot begin inside another, so each ends
    where the next mark is first found.
    """
    size = len(PREFIX)

    def parts(one: str, other: str) -> tuple[Column, Column, Column]:
        rest = F.substr(output, F.lit(size + 1))
        first = F.substring_index(rest, one, 1)
        rest = F.substr(rest, F.length(first) + size + 1)
        second = F.substring_index(rest, other, 1)
        return first, second, F.substr(rest, F.length(second) + size + 1)

    prefix, suffix, middle = parts(SUFFIX, MIDDLE)
    suffix_spm, prefix_spm, middle_spm = parts(PREFIX, MIDDLE)
    return (
        F.when(form == "psm", F.concat(prefix, middle, suffix))
        .when(form == "spm", F.concat(prefix_spm, middle_spm, suffix_spm))
        .otherwise(output)
    )


def digests(docs: DataFrame, **options) -> DataFrame:
    """``fill_in_middle`` with hashes of the output and of the text restored from it, in their place."""
    out = fill_in_middle(docs, **options)
    back = restored(F.col("output"), F.col("form"))
    return out.withColumns({
        "output_sha256": F.sha2(F.col("output").cast("binary"), 256), "restored_sha256": F.sha2(back.cast("binary"), 256),
    }).drop("output")
