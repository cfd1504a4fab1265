"""Lists of whole numbers as bytes, and what two of them have in common.

A list is sorted and kept as the gaps between its numbers, seven bits a byte, the first from 0, so a
number takes as many bytes as its gap needs.  All of a batch is handled at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

LONGEST = 10  # bytes of a gap of 64 bits
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], "u8")


def pack(lists: pa.ListArray) -> pa.BinaryArray:
    """Each list of distinct whole numbers as bytes."""
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype("i8")
    numbers = lists.flatten().to_numpy(zero_copy_only=False).astype("i8")
    row = np.repeat(np.arange(len(sizes)), sizes)
    least, most = (int(numbers.min()), int(numbers.max())) if len(numbers) else (0, 0)
    if (span := most - least + 1) * len(sizes) < 2**63:  # as one number, which sorts faster than two
        numbers = np.sort(row * span + (numbers - least)) - row * span + least
    else:
        numbers = numbers[np.lexsort((numbers, row))]
    numbers = numbers.view("u8")
    borders = np.concatenate([[0], np.cumsum(sizes)])
    gaps = numbers.copy()
    gaps[1:] -= numbers[:-1]  # of 64 bits without a sign, so a gap never overflows
    first = borders[:-1][sizes > 0]
    gaps[first] = numbers[first]
    length = np.ones(len(gaps), "i8")
    for k in range(1, LONGEST):
        length += gaps >> np.uint64(7 * k) > 0
    ends = np.concatenate([[0], np.cumsum(length)])
    data = np.empty(ends[-1], "u1")
    for k in range(length.max(initial=0)):
        some = np.flatnonzero(length > k)
        data[ends[some] + k] = (gaps[some] >> np.uint64(7 * k)).astype("u1") & 127 | (length[some] > k + 1).astype("u1") << 7
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(sizes), [None, pa.py_buffer(ends[borders].astype("i4")), pa.py_buffer(data)]
    )


def unpack(packed: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all lists, one list after the other, and how many each has."""
    if not len(packed):
        return np.empty(0, "i8"), np.empty(0, "i8")
    offsets = np.frombuffer(packed.buffers()[1], "i4")[packed.offset : packed.offset + len(packed) + 1]
    data = np.frombuffer(packed.buffers()[2] or b"", "u1")[offsets[0] : offsets[-1]]
    last = data < 128
    ends = np.flatnonzero(last)
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(ends)]
    gaps = (data[starts] & 127).astype("u8")
    some = np.arange(len(ends))
    for k in range(1, LONGEST):
        some = some[starts[some] + k <= ends[some]]
        if not len(some):
            break
        gaps[some] |= (data[starts[some] + k] & 127).astype("u8") << np.uint64(7 * k)
    before = np.concatenate([[0], np.cumsum(last)])[offsets - offsets[0]]
    sizes = np.diff(before)
    sums = np.cumsum(gaps, dtype="u8")
    sums -= np.repeat(np.concatenate([[np.uint64(0)], sums])[before[:-1]], sizes)
    return sums.view("i8"), sizes


def pack_column(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Batches with the lists of one column packed."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        yield batch.set_column(at, column, pack(batch.column(at)))


def common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(id, n)``: how many triangles each number is in, of rows ``(a, b, cs, own)``.

    Every number that ``cs`` and ``own`` have in common is the third corner of a triangle of ``a`` and ``b``.
    """
    for batch in batches:
        own = batch.column("own").dictionary_encode()
        mine, sizes = unpack(own.dictionary)
        mine_of = np.repeat(np.arange(len(sizes)), sizes)
        numbers, sizes = unpack(batch.column("cs"))
        row = np.repeat(np.arange(len(sizes)), sizes)
        of = own.indices.to_numpy(zero_copy_only=False).astype("i8")[row]
        # a table of hashes leaves few for the exact comparison
        bits = np.uint64(64 - min(24, 5 + len(mine).bit_length()))
        place = lambda x, y: (x.view("u8") + y.view("u8") * MIX[0]) * MIX[1] >> bits
        seen = np.zeros(1 << (64 - int(bits)), bool)
        seen[place(mine, mine_of)] = True
        likely = np.flatnonzero(seen[place(numbers, of)])
        different = np.unique(mine)
        key = lambda x, y: y * len(different) + np.searchsorted(different, x)
        likely = likely[np.isin(numbers[likely], different)]
        likely = likely[np.isin(key(numbers[likely], of[likely]), key(mine, mine_of))]
        a, b = (batch.column(c).to_numpy(zero_copy_only=False)[row[likely]] for c in ("a", "b"))
        ids, n = np.unique(np.concatenate([a, b, numbers[likely]]), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64())], ["id", "n"])
