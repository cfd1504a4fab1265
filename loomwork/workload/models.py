"""Model queries on features of all orders; the label is whether the order is finished."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.features import flag, with_vector
from ..operators import ml
from .tables import table

FEATURES = ("price", "month", "year", "urgent", "high", "low")
WHOLE = ("month", "year", "urgent", "high", "low")
SPREAD = 7919  # a prime: scatters neighbouring keys over the training and test parts


def _orders(spark, sf_dir, columns=FEATURES):
    priority = F.col("o_orderpriority")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        flag(F.col("o_orderstatus") == "F").alias("label"),
        F.col("o_totalprice").alias("price"),
        F.month("o_orderdate").cast("double").alias("month"),
        F.year("o_orderdate").cast("double").alias("year"),
        flag(priority.startswith("1")).alias("urgent"),
        flag(priority.startswith("2")).alias("high"),
        flag(priority.startswith("5")).alias("low"),
    )
    return with_vector(rows, columns, ("o_orderkey", "label"))


def _compared(spark, sf_dir, models, columns=FEATURES):
    place = F.pmod(F.col("o_orderkey") * SPREAD, F.lit(ml.PLACES))
    out = ml.compare(_orders(spark, sf_dir, columns), place, 0.7, models)
    return out.withColumn("baseline", F.round("baseline", 9))


def _query(*models):
    """What each model reaches on the test rows, beside what needs no model.  SQL cannot train these:
    tests hold trees against a search of all splits, sizes and baselines against SQL, and ask
    that every model learns what can be learnt."""
    return lambda spark, sf_dir: _compared(spark, sf_dir, models)


def _naive_bayes(spark, sf_dir):
    return _compared(spark, sf_dir, ["naive_bayes"]).select("model", "metric", "value")


def _stump(name):
    """A tree of one split over whole numbers, which SQL finds by trying all."""
    return lambda spark, sf_dir: _compared(spark, sf_dir, [name], WHOLE).withColumn("value", F.round("value", 9))


QUERIES = {f"ml_{name}": _query(name) for name in ml.MODELS}
QUERIES["ml_naive_bayes"] = _naive_bayes
QUERIES["ml_compare"] = _query(*ml.MODELS)
QUERIES |= {f"ml_{name}": _stump(name) for name in ml.STUMPS}

_PARTS_SQL = f"""f as (select o_orderkey * {SPREAD} % 10000 < 7000 as train, cast(o_orderstatus = 'F' as int) as label from orders),
c as (select label, count(*) as n from f where train group by label),
common as (select label as most from c order by n desc, label limit 1),
mean as (select sum(label * n) / sum(n)::double as m from c),
base as (select (select count(*) from f where train) as n_train, (select count(*) from f where not train) as n_test,
  round((select avg(cast(label = most as int)) from f, common where not train), 9) as accuracy,
  round((select sqrt(avg((label - m) ** 2)) from f, mean where not train), 9) as rmse)"""


_IMPURITY = {
    "gini": "1 - ({a} / {n}::double) ** 2 - ({b} / {n}::double) ** 2",
    "entropy": "-(case when {a} > 0 then {a} / {n}::double * log2({a} / {n}::double) else 0 end"
    " + case when {b} > 0 then {b} / {n}::double * log2({b} / {n}::double) else 0 end)",
}


def _stump_sql(name: str) -> str:
    """All splits of all features; the first of the best is taken, if it gains anything."""
    impure = lambda a, b, n: "(" + _IMPURITY[name.split("_")[1]].format(a=a, b=b, n=n) + ")"
    return f"""with {_PARTS_SQL},
w as (select o_orderkey * {SPREAD} % 10000 < 7000 as train, cast(o_orderstatus = 'F' as int) as label, month(o_orderdate) as month,
  year(o_orderdate) as year, cast(starts_with(o_orderpriority, '1') as int) as urgent,
  cast(starts_with(o_orderpriority, '2') as int) as high, cast(starts_with(o_orderpriority, '5') as int) as low from orders),
long as (select train, label, u.f as f, u.x as x from w,
  lateral (select unnest(range({len(WHOLE)})) as f, unnest([{", ".join(WHOLE)}]) as x) u),
per as (select f, x, count(*) as n, sum(label) as pos from long where train group by f, x),
split as (select f, (x + lead(x) over (partition by f order by x)) / 2.0 as t,
  sum(n) over (partition by f order by x) as ln, sum(pos) over (partition by f order by x) as lp,
  sum(n) over (partition by f) as n, sum(pos) over (partition by f) as p from per),
gain as (select *, {impure("p", "(n - p)", "n")} - ln / n::double * {impure("lp", "(ln - lp)", "ln")}
  - (n - ln) / n::double * {impure("(p - lp)", "(n - ln - p + lp)", "(n - ln)")} as gain from split where t is not null),
best as (select * from gain order by gain desc, f, t limit 1),
right_ as (select avg(cast(label = case when gain <= 0 then cast(2 * p > n as int)
    when x <= t then cast(2 * lp > ln as int) else cast(2 * (p - lp) > n - ln as int) end as int)) as value
  from long, best where not train and long.f = best.f)
select '{name}' as model, 'accuracy' as metric, round(value, 9) as value, n_train, n_test, accuracy as baseline,
  value > (select avg(cast(label = most as int)) from f, common where not train) as beats_baseline from base, right_"""


# Multinomial naive Bayes with smoothing 1, written out: class priors and feature
# weights from the training rows, then the likelier class of each test row.
_NAIVE_BAYES = f"""with f as (select o_orderkey, o_orderkey * {SPREAD} % 10000 < 7000 as train,
    cast(o_orderstatus = 'F' as int) as label, o_totalprice as price,
    month(o_orderdate) as month, year(o_orderdate) as year,
    cast(starts_with(o_orderpriority, '1') as int) as urgent,
    cast(starts_with(o_orderpriority, '2') as int) as high,
    cast(starts_with(o_orderpriority, '5') as int) as low from orders),
long as (select o_orderkey, train, label, u.name as name, cast(u.x as double) as x
  from f, lateral (select unnest([{", ".join(f"'{c}'" for c in FEATURES)}]) as name,
    unnest([{", ".join(f"cast({c} as double)" for c in FEATURES)}]) as x) u),
prior as (select label, ln(count(*) + 1) - ln((select count(*) from f where train) + 2) as p
  from f where train group by label),
sums as (select label, name, sum(x) as s from long where train group by label, name),
weight as (select label, name, ln(s + 1) - ln(sum(s) over (partition by label) + {len(FEATURES)}) as w from sums),
score as (select o_orderkey, long.label as truth, prior.label as guess, any_value(prior.p) + sum(x * w) as score
  from long join weight using (name) join prior on prior.label = weight.label
  where not train group by 1, 2, 3),
best as (select o_orderkey, truth, arg_max(guess, score) as guess from score group by 1, 2)
select 'naive_bayes' as model, 'accuracy' as metric,
  sum(cast(truth = guess as int)) / count(*)::double as value from best"""

ORACLES = {"ml_naive_bayes": _NAIVE_BAYES, **{f"ml_{name}": _stump_sql(name) for name in ml.STUMPS}}
BASELINES_SQL = f"with {_PARTS_SQL} select n_train, n_test, accuracy, rmse from base"
