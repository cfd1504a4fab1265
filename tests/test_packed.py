"""Packed lists against plain ones."""

import random

import pyarrow as pa
import pytest

from loomwork.operators import packed


@pytest.mark.parametrize("draw", [
    lambda r: r.randrange(300), lambda r: r.randrange(-500, 10**6), lambda r: r.choice([r.randrange(9), r.randrange(-(2**63), 2**63)])
])
def test_lists_come_back_sorted(draw):
    r = random.Random(1)
    lists = [list({draw(r) for _ in range(r.randrange(40))}) for _ in range(300)] + [[2**63 - 1, -(2**63)], [], [0, -1]]
    column = packed.pack(pa.array(lists, pa.list_(pa.int64())))
    for some in (column, column.slice(7, 50), column.slice(0, 0)):
        numbers, sizes = packed.unpack(some)
        want = lists[some.offset : some.offset + len(some)]
        assert numbers.tolist() == [n for x in want for n in sorted(x)] and sizes.tolist() == [len(x) for x in want]


def test_a_list_takes_as_many_bytes_as_its_gaps_need():
    column = packed.pack(pa.array([list(range(10**9, 10**9 + 6000, 60))], pa.list_(pa.int64())))
    assert len(column[0].as_py()) == 5 + 99


def test_common_numbers_make_triangles():
    lists = [[5, 900, 2**40], [5, 7, 2**40, -3], [900, 6]]
    column = packed.pack(pa.array(lists, pa.list_(pa.int64())))
    rows = pa.RecordBatch.from_arrays(
        [pa.array([1, 2, 1]), pa.array([3, 3, 4]), column.take(pa.array([0, 1, 2])), column.take(pa.array([1, 1, 0]))], ["a", "b", "cs", "own"]
    )
    got = [(r["id"], r["n"]) for b in packed.common(iter([rows])) for r in b.to_pylist()]
    assert sorted(got) == [(-3, 1), (1, 3), (2, 4), (3, 6), (4, 1), (5, 2), (7, 1), (900, 1), (2**40, 2)]
