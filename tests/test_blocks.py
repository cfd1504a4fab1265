"""Sums along links, blocks against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from loomwork.operators import blocks, graph
from loomwork.storage import cut_lineage


def links_of(spark, pairs, kind):
    edges = spark.createDataFrame(pairs, "src long, dst long").select(F.col("src").cast(kind), F.col("dst").cast(kind))
    return cut_lineage(edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("w")))


def sums_of(pairs, factor, base, to_none):
    ids = {i for p in pairs for i in p}
    out = {i: sum(s == i for s, _ in pairs) for i in ids}
    got = dict.fromkeys(ids, 0.0)
    for s, d in pairs:
        if s is not None and (d is not None or to_none):
            got[d] += 1 / out[s]
    return {i: base + factor * x for i, x in got.items()}


@pytest.mark.parametrize("kind", ["long", "string"])
@pytest.mark.parametrize("cell_links", [2, 10**6])
def test_values_passed_on(spark, kind, cell_links):
    r = random.Random(3)
    pairs = [(r.randrange(40), r.randrange(40) // r.choice([1, 9])) for _ in range(150)] * 2 + [(50, i) for i in range(60)]
    pairs += [(None, 5), (None, 70), (4, None), (5, None), (5, None)]
    vertices = blocks.Blocks(links_of(spark, pairs, kind), cell_links)
    assert (vertices.blocks > 1) == (cell_links == 2)
    for to_none in (False, True):
        values = vertices.passed_on(vertices.ones(), 0.5, 0.25, to_none)
        got = {row.id and int(row.id): row.x for row in vertices.rows(values, "x").collect()}
        want = sums_of(pairs, 0.5, 0.25, to_none)
        assert got == pytest.approx(want)
        assert values.agg(F.max("most")).first()[0] == pytest.approx(max(want.values()))


def test_rounds_move_values_of_cells_not_of_links(spark, monkeypatch):
    """Each vertex links to each: a round gives one sum for a vertex from each cell."""
    pairs, rows, sums = [(i, j) for i in range(60) for j in range(60)], [], blocks.Blocks.passed_on
    vertices = blocks.Blocks(links_of(spark, pairs, "long"), 400)
    assert vertices.blocks > 1
    links = vertices.links.collect()
    assert len(links) <= vertices.blocks**2
    assert sum(len(r.s) for r in links) == 4 * 3600 and not any(r.w or r.at for r in links)
    monkeypatch.setattr(blocks.Blocks, "passed_on", lambda self, *a, **b: rows.append(1) or sums(self, *a, **b))
    got = graph.pagerank(spark.createDataFrame(pairs, "src long, dst long")).collect()
    assert {round(r["rank"], 9) for r in got} == {1.0} and len(rows) <= 6


def test_moves_in_circles_take_few_rounds(spark, monkeypatch):
    r, n, made, sums = random.Random(1), 60, [], blocks.Blocks.passed_on
    pairs = [(3 * r.randrange(n) + k, 3 * r.randrange(n if k < 2 else 2 * n) % (3 * n) + (k + 1) % 3) for k in range(3) for _ in range(900)]
    monkeypatch.setattr(blocks.Blocks, "passed_on", lambda self, *a, **b: made.append(1) or sums(self, *a, **b))
    graph.pagerank(spark.createDataFrame(pairs, "src long, dst long")).collect()
    assert 6 <= len(made) <= 26
