"""Graph queries on the trade graph of all line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graph
from .tables import TRADE_SQL, table, trade_edges

ROUNDS = 10
SPREAD_ROUNDS = 30  # who is reached within so many rounds is what the query asks
SEED = 3  # customer 1


def _vertices(spark, sf_dir):
    kinds = (("customer", "c_custkey"), ("part", "p_partkey"), ("supplier", "s_suppkey"))
    ids = [
        table(spark, sf_dir, name).select((F.col(key) * 3 + i).alias("id"))
        for i, (name, key) in enumerate(kinds)
    ]
    return ids[0].unionByName(ids[1]).unionByName(ids[2])


VERTICES_SQL = """ids as (select c_custkey * 3 as id from customer
  union all select p_partkey * 3 + 1 from part union all select s_suppkey * 3 + 2 from supplier),
v as (select id from ids union select src from e union select dst from e)"""


def graph_vertices(spark, sf_dir):
    known = table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") * 3).alias("id"), F.col("c_nationkey").alias("nation")
    )
    return graph.graph_vertices(trade_edges(spark, sf_dir), known, {"nation": -1})


def triangle_count(spark, sf_dir):
    return graph.triangle_count(trade_edges(spark, sf_dir), _vertices(spark, sf_dir)).orderBy("id")


def pagerank(spark, sf_dir):
    out = graph.pagerank(trade_edges(spark, sf_dir), rounds=ROUNDS)
    return out.withColumn("rank", F.round("rank", 6))


def pagerank_converged(spark, sf_dir):
    """Ranks at the operator's own tolerance; tests/test_graph.py compares them with the solved equations."""
    return graph.pagerank(trade_edges(spark, sf_dir))


def infection_spread(spark, sf_dir):
    vertices = _vertices(spark, sf_dir).select(
        "id", (F.col("id") == SEED).alias("reached"), F.lit(0).cast("long").alias("time")
    )
    return graph.spread(vertices, trade_edges(spark, sf_dir), max_rounds=SPREAD_ROUNDS)


QUERIES = {
    "graph_vertices": graph_vertices,
    "triangle_count": triangle_count,
    "pagerank": pagerank,
    "pagerank_converged": pagerank_converged,
    "infection_spread": infection_spread,
}


def _rounds_sql(rounds: int) -> str:
    """Tables r0 to r<rounds> of ranks."""
    later = [
        f"""r{i} as materialized (select v.id, 0.15 + 0.85 * coalesce(m.m, 0) as r from v left join (
  select e.dst, sum(x.r / o.n) as m from e join o on o.src = e.src join r{i - 1} x on x.id = e.src
  group by e.dst) m on m.dst = v.id)"""
        for i in range(1, rounds + 1)
    ]
    return ",\n".join(
        [f"{TRADE_SQL}, v as (select src as id from e union select dst from e)",
         "o as (select src, count(*) as n from e group by 1), r0 as (select id, 1.0::double as r from v)", *later]
    )


ORACLES = {
    "graph_vertices": f"""with {TRADE_SQL}
select id, case when c_custkey is null then -1 else c_nationkey end as nation
from (select src as id from e union select dst from e union select c_custkey * 3 from customer)
left join customer on id = c_custkey * 3""",
    "triangle_count": f"""with {TRADE_SQL}, {VERTICES_SQL},
cp as (select distinct c, p from trade), ps as (select distinct p, s from trade),
cs as (select distinct c, s from trade),
t as (select cp.c, cp.p, ps.s from cp join ps on cp.p = ps.p join cs on cs.c = cp.c and cs.s = ps.s),
n as (select id, count(*) as n from (select c as id from t union all select p from t
  union all select s from t) group by 1)
select v.id, coalesce(n.n, 0) as triangles from v left join n on n.id = v.id""",
    "pagerank": f"with {_rounds_sql(ROUNDS)} select id, round(r, 6) as rank from r{ROUNDS}",
    "infection_spread": f"""with recursive {TRADE_SQL}, {VERTICES_SQL},
y as (select src as a, dst as b from e union select dst, src from e),
r(id, t) as (select {SEED}::bigint, 0::bigint union select y.b, r.t + 1 from r join y on y.a = r.id where r.t < {SPREAD_ROUNDS}),
m as (select id, min(t) as t from r group by id)
select v.id, m.t is not null as reached, coalesce(m.t, 0) as time from v left join m on m.id = v.id""",
}
