"""Vector codes against exact rounds in plain Python."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from loomwork.llm import vector_codes
from loomwork.llm.vector_codes import Bounds, Coding, History, nearest, reassign, whole


def slow(rows, parts=8, entries=16, rounds=6):
    """(vec_id, code, error, label_error, hash) of (vec_id, vector, label)."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = []
    for _, v, _ in kept:
        ints, w = [math.floor(4096 * x) for x in v], len(v) // parts
        cut.append([ints[i * w : (i + 1) * w] for i in range(parts)])
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def assign():
        out = []
        for c in cut:
            near = [min((sum((a - b) ** 2 for a, b in zip(c[p], e)), j) for j, e in enumerate(books[p])) for p in range(parts)]
            out.append(([j for _, j in near], sum(d for d, _ in near)))
        return out

    for _ in range(rounds):
        codes = assign()
        for p in range(parts):
            for j in range(len(books[p])):
                mine = [c[p] for c, (code, _) in zip(cut, codes) if code[p] == j]
                if mine:
                    books[p][j] = [sum(x) // len(mine) for x in zip(*mine)]
    done = assign()
    per = Counter()
    for (_, _, label), (_, e) in zip(kept, done):
        per[label] += e
    flat = [x for book in books for e in book for x in e]
    sha = hashlib.sha256(",".join(map(str, flat)).encode()).hexdigest()
    return [(i, "".join(f"{j:02x}" for j in code), e, per[label], sha) for (i, _, label), (code, e) in zip(kept, done)]


def run(spark, rows, **names):
    df = spark.createDataFrame([(i, v, lab, "x") for i, v, lab in rows], "vec_id long, embedding array<float>, label int, code string")
    return vector_codes.coded(df.repartition(3))


def random_rows(n, width, seed, scale=1.0):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(20, width))
    return [(i, (scale * (middles[i % 20] + rng.normal(size=width) * 0.3)).astype(np.float32).tolist(), [1, 2, None][i % 3]) for i in range(n)]


@pytest.mark.parametrize("n, width, scale", [(400, 16, 1.0), (60, 8, 0.001), (40, 24, 1e9), (30, 8, 1e30), (5, 8, 1.0), (1, 16, 1.0)])
def test_against_exact_rounds(spark, n, width, scale):
    rows = random_rows(n, width, n, scale)
    want = sorted(r if r[2] < 1 << 63 else (*r[:2], None, None, r[4]) for r in slow(rows))
    got = sorted(map(tuple, run(spark, rows).collect()))
    assert [r[:3] + r[4:] for r in got] == [r[:3] + r[4:] for r in want]
    if scale < 1e9:
        assert got == want


def test_odd_rows(spark):
    rows = random_rows(50, 16, 4)
    nan, inf = float("nan"), float("inf")
    odd = [(100, None, 1), (101, [nan] * 16, 1), (102, [inf] + [0.0] * 15, 1), (103, [None] + [0.0] * 15, 1), (104, [-inf] * 16, None)]
    more = [rows[3], rows[3], (None, rows[5][1], 2), (None, rows[6][1], 2), (7, [0.0] * 16, None), (-5, [-0.0] * 16, None)]
    got = run(spark, [*rows, *odd, *more]).collect()
    assert Counter(map(tuple, got)) == Counter(slow([*rows, *more]))


def test_other_lengths(spark):
    rows = random_rows(40, 16, 4)
    odd = [(200, [1.0] * 8, 1), (201, [], 1), (202, [1.0] * 15, 1)]
    got = {r.vec_id: r for r in run(spark, [*rows, *odd]).collect()}
    assert {i: (r.code, r.error) for i, r in got.items() if i < 200} == {r[0]: (r[1], r[2]) for r in slow(rows)}
    assert all(got[i].code is None and got[i].error is None for i, _, _ in odd)


def test_empty(spark):
    assert run(spark, []).count() == 0
    assert run(spark, [(1, None, 1)]).count() == 0
    only = run(spark, [(1, [], 1)]).collect()
    assert [r.code for r in only] == [None]


def test_ties_go_to_the_lower_entry():
    x = np.array([[0, 0], [2, 0]])
    code, own, other = nearest(x, np.array([[1, 0], [-1, 0], [1, 0]]))
    assert code.tolist() == [0, 0] and own.tolist() == [1, 1] and other.tolist() == [1, 1]


def test_whole():
    assert whole(np.array([[-0.00001, 0.5, 1.0]]), 4096).tolist() == [[-1, 2048, 4096]]
    assert whole(np.array([[1e308, -1e-9]]), 4096).tolist() == [[int(1e308) * 4096, -1]]


def test_net_moves_need_fewer_distances_than_drifts():
    """Entries that go back and forth: accumulated drifts fail where net displacement does not."""
    rng = np.random.default_rng(3)
    x = whole(rng.normal(size=(3000, 1, 4)) + rng.integers(0, 8, (3000, 1, 1)) * 6, 4096)
    base = whole(np.arange(8)[:, None] * 6.0 + np.zeros((8, 4)), 4096)[None]
    swing = [base + (3000 if r % 2 else 0) for r in range(7)]

    def computed(drift: bool) -> list[int]:
        history, bounds, out = History([]), Bounds.first(len(x), 1), []
        if drift:
            def moved(part):
                steps = np.stack([np.sqrt(((b[part] - a[part]) ** 2).sum(axis=1)) for a, b in zip(history.books, history.books[1:])] + [np.zeros(8)])
                far = np.cumsum(steps[::-1], axis=0)[::-1]
                return far, np.stack([np.stack([np.delete(f, j).max() for j in range(8)]) for f in far])
            history.moved = moved
        for book in swing:
            history.books.append(book)
            out.append(reassign(x, bounds, history))
            want = ((x[:, 0, None] - book[0][None]) ** 2).sum(axis=2).argmin(axis=1)
            assert (bounds.code[:, 0] == want).all()
        return out

    net, drifts = computed(False), computed(True)
    assert sum(net) < sum(drifts) and sum(net) < 3000 * 8 * 3


def test_rounds_save_distances(spark):
    rows = random_rows(2000, 32, 9)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    codes = vector_codes.encode(df)
    assert codes.computed[0] == 2000 * 8 * 16 and len(codes.computed) == 7
    assert sum(codes.computed[3:]) < 0.6 * 4 * codes.computed[0]
    assert set(codes.rows.columns) == {"vec_id", "embedding", "label", "code", "error"}
