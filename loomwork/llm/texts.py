"""Words of whole texts in Arrow batches, as integer arrays."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

_LIBC = ctypes.CDLL(None)
_UPPER = bytes(range(ord("A"), ord("Z") + 1))


def byte_table(separators: Iterable[int], lower: bool) -> bytes:
    """A ``bytes.translate`` table: separators become spaces, A-Z are lowered if asked for.

    Bytes of 0x80 and above, so all of a non-ASCII character, stay as they are.
    """
    table = bytearray(range(256))
    if lower:
        for b in _UPPER:
            table[b] = b + 32
    for b in separators:
        table[b] = 0x20
    return bytes(table)


WHITE = (0x20, *range(0x09, 0x0E))
SPACED = byte_table(WHITE, lower=False)
SPACED_LOWER = byte_table(WHITE, lower=True)


class Words(NamedTuple):
    """The words of several texts, one after the other."""

    codes: np.ndarray  # position of each word in ``types``
    types: pa.Array  # distinct words, as binary
    bounds: np.ndarray  # text i has codes[bounds[i]:bounds[i + 1]]

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def owner(self) -> np.ndarray:
        """The text that each word is in."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.lengths)


def words_of(texts: list[bytes], table: bytes) -> Words:
    """Split texts at the separators of ``table``."""
    spaced = pa.array([t.translate(table) for t in texts], pa.large_binary())
    lists = pc.split_pattern(spaced, b" ")
    flat = lists.flatten()
    real = np.asarray(pc.greater(pc.binary_length(flat), 0))
    before = np.concatenate([[0], np.cumsum(real)])
    encoded = pc.dictionary_encode(flat.filter(pa.array(real)))
    return Words(
        np.asarray(encoded.indices), encoded.dictionary, before[np.asarray(lists.offsets)]
    )


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null counts as empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def map_batches(
    df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema
) -> DataFrame:
    """Apply ``fn`` to each Arrow batch, a few thousand rows at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                out = fn(part)
                if out is not None:
                    yield out
        give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return memory that is free to the system: Python workers live on after a task, for other operators."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(_LIBC, "malloc_trim", None):
        trim(0)


def pieces(batch: pa.RecordBatch, rows: int = 2048) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``rows`` rows, which bounds memory; no row is left out."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def slices(batch: pa.RecordBatch, column: int, rows: int = 2048, size: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``rows`` rows and ``size`` bytes of a string column; a longer
    text is a slice of its own.  No row is left out."""
    lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0))
    ends, start = np.cumsum(lengths, dtype=np.int64), 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = int(np.searchsorted(ends, before + size, side="right"))
        stop = min(max(stop, start + 1), start + rows, batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def bound_batches(spark, size: int = 8 << 20) -> None:
    """Have Spark send texts to Python in Arrow batches of about ``size`` bytes, from now on in the session."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
