"""Targets against step-by-step clamping, and what is taken against the targets."""

import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from loomwork.llm import mixing


def slow_targets(sizes, mix):
    """Share by weight, clamp those above, share the excess among the others, and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: mix.weights[i % len(mix.weights)] for i, s in enumerate(names)}
    total, clamped = Fraction(sum(sizes.values()) * mix.percent, 100), {}
    while True:
        free = [s for s in names if s not in clamped]
        rest = total - sum(clamped.values())
        share = {s: rest * weight[s] / sum(weight[t] for t in free) for s in free}
        over = {s: Fraction(mix.max_epochs * sizes[s]) for s in free if share[s] > mix.max_epochs * sizes[s]}
        if not over:
            return {s: float(v) for s, v in (clamped | share).items()}
        clamped |= over


def check(rows, sources, mix):
    """``rows``: (id, size, source_size, target, taken); ``sources``: id -> source."""
    sizes, taken, target = Counter(), Counter(), {}
    for i, size, _, t, n in rows:
        sizes[sources[i]] += size
        taken[sources[i]] += n
        target[sources[i]] = t
        assert 0 <= n <= mix.max_epochs * size
    want = slow_targets(dict(sizes), mix)
    for s in sizes:
        assert target[s] == pytest.approx(want[s], abs=1e-6)
        assert abs(taken[s] - want[s]) <= 0.5 + 1e-6
    assert all(r[2] == sizes[sources[r[0]]] for r in rows)


@pytest.mark.parametrize("seed", range(4))
def test_mixture(spark, seed):
    r = random.Random(seed)
    names = ["a", "b", "B", "é", "z", None, "none"]
    rows = []
    for i in range(300):
        s = "a" if r.random() < 0.5 else r.choice(names)
        text = None if r.random() < 0.05 else " ".join(["w"] * r.choice([0, 1, 5, 50, 500]))
        rows.append((i, None if s == "none" and seed else text, s, i))
    mix = mixing.Mix(seed=seed, bin_docs=16, percent=r.choice([20, 100, 150, 199, 200]))
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size long")
    got = list(map(tuple, mixing.mixture(df, mix=mix).collect()))
    assert Counter((i, s) for i, s, *_ in got) == Counter((i, len((t or "").split())) for i, t, *_ in rows)
    check(got, {i: s for i, _, s, _ in rows}, mix)
    assert sorted(got) == sorted(map(tuple, mixing.mixture(df.repartition(5), mix=mix).collect()))


def test_sample_has_what_the_plan_says(spark):
    rows = [(i, "  word\tother " * (i % 7) + "end", "ab"[i % 5 == 0], 0) for i in range(100)] + [(None, None, None, 0), (5, "", "a", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int")
    taken, found = Counter(), Counter()
    for r in mixing.mixture(df).collect():
        taken[r.doc_id] += r.taken
    out = mixing.sample(df)
    assert out.columns == df.columns and out.dtypes == df.dtypes
    texts = defaultdict(set)
    for r in out.collect():
        found[r.doc_id] += len(re.findall(mixing.WORD, r.text or ""))
        texts[r.doc_id].add(r.text)
    assert +found == +taken
    assert sum(len(t) > 1 for t in texts.values()) <= 4  # at most one document of a source in part


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mixture(df).count() == 0 and mixing.sample(df).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (1, None, "a")], df.schema)
    assert [tuple(r) for r in mixing.mixture(blank).collect()] == [(1, 0, 0, 0.0, 0)] * 2


def test_query(spark, sf_dir):
    from loomwork.llm.queries import op3_mixing

    sources = {r.doc_id: r.source for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    check(list(map(tuple, op3_mixing(spark, sf_dir).collect())), sources, mixing.Mix())
