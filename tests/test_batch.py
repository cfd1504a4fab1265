"""Rates, pairs, joins, placement, sets, nested data, parsing, features."""

from collections import Counter
from itertools import product

import pytest
from fixtures import BASKETS, NESTED, SALTED, WEATHER
from pyspark.sql import functions as F

from loomwork.functions import features, parse
from loomwork.operators import joins, ml, nested, pairs, partition, rates, sessions, setops
from loomwork.plans import skew
from loomwork.sources import files


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ------------------------------------------------------------------ rates


def test_rates_on_text_columns(spark):
    data = [("male", "0", "34.5", "7.8292"), ("female", "1", "47", "7"), ("male", "0", None, None), ("female", "1", "8.9", "x")]
    df = spark.createDataFrame(data, "sex string, survived string, age string, fare string")
    flag = F.col("survived").try_cast("int")
    assert rows(rates.rate_by(df, flag, F.col("sex"), "k")) == [("female", 2, 2, 1.0), ("male", 0, 2, 0.0)]
    assert rows(rates.rate_by(df, flag, rates.int_bucket(F.col("age")), "k")) == [
        (1.0, 1, 1, 1.0), (3.0, 0, 1, 0.0), (5.0, 1, 1, 1.0), (None, 0, 1, 0.0),
    ]
    assert rows(rates.rate_by(df, flag, rates.double_bucket(F.col("fare")), "k")) == [(1.0, 1, 2, 0.5), (None, 1, 2, 0.5)]
    assert rows(rates.rate_total(df, flag)) == [(2, 4)]


def test_ordered_rates_keep_the_null_group_first(spark):
    df = spark.createDataFrame([("S", 1), (None, 0), ("C", 1)], "port string, f int")
    out = rates.rate_by(df, F.col("f"), F.col("port"), "port", ordered=True)
    assert [r["port"] for r in out.collect()] == [None, "C", "S"]


# ------------------------------------------------------------------ pairs


@pytest.fixture(scope="module")
def baskets(spark):
    data = [(i, g, [(a,) for a in items]) for i, (g, items) in enumerate(BASKETS)]
    df = spark.createDataFrame(data, "id long, group string, actions array<struct<action:long>>")
    return pairs.basket_rows(df, "id", "actions", "action")


def brute_pairs():
    want = Counter()
    for _, items in BASKETS:
        for a, b in product(items, items):
            if a < b:
                want[a, b] += 1
    return want


@pytest.mark.parametrize("block", [1, 2, 3, 2000])
def test_pair_counts(baskets, block):
    got = {(r["a"], r["b"]): r["n"] for r in pairs.pair_counts(baskets, "id", "item", block).collect()}
    assert got == brute_pairs()
    assert len(got) == 59 and sum(got.values()) == 89 and got[1, 2] == 5 and got[2, 12] == 3


def test_pairs_begin_with_partitions_by_their_number(spark, baskets, monkeypatch):
    from loomwork import storage

    before = spark.conf.get(storage.INITIAL, None)
    spark.conf.unset(storage.INITIAL)
    monkeypatch.setattr(storage, "ROWS_A_PARTITION", 3)
    out = pairs.pair_counts(baskets, "id", "item")
    assert int(spark.conf.get(storage.INITIAL)) >= 59 // 3
    assert {(r["a"], r["b"]): r["n"] for r in out.collect()} == brute_pairs()
    spark.conf.unset(storage.INITIAL) if before is None else spark.conf.set(storage.INITIAL, before)


@pytest.mark.parametrize("segments", [1, 3])
def test_nested_pair_counts(baskets, segments):
    out = pairs.pair_counts_nested(baskets, "id", "item", segments=segments, block_items=2).collect()
    got, empty = {}, set()
    for r in out:
        got.update({(r["a"], b): n for b, n in r["partners"].items()})
        if not r["partners"]:
            empty.add(r["a"])
    assert got == brute_pairs() and empty == {10, 13, 14}
    assert len({(r["a"], r["segment"]) for r in out}) == len(out)
    assert {r["segment"] for r in out} == set(range(segments))
    assert segments > 1 or len(out) == 14


@pytest.mark.parametrize("least", [1, 2, 3, 6])
def test_pairs_seen_often(baskets, least):
    got = {(r["a"], r["b"]): r["n"] for r in pairs.pair_counts(baskets, "id", "item", 2, min_count=least).collect()}
    assert got == {p: n for p, n in brute_pairs().items() if n >= least}


@pytest.mark.parametrize("names", [("b", "a"), ("a", "n"), ("_k", "_x"), ("n", "b"), ("segment", "partners")])
def test_pairs_with_any_column_names(spark, names):
    df = spark.createDataFrame([(1, 5), (1, 6), (None, 6), (None, 7), (2, None)], "x long, y long").toDF(*names)
    got = {tuple(r) for r in pairs.pair_counts(df, *names).collect()}
    assert got == {(5, 6, 1), (6, 7, 1)}
    assert pairs.pair_counts_nested(df, *names).count() == 3


# ------------------------------------------------------------------ joins and placement


@pytest.mark.parametrize("partitions", [1, 2, 9, None])
def test_salted_join(spark, partitions):
    left = spark.createDataFrame(SALTED, "group string, value long")
    right = left.withColumnRenamed("value", "other").union(spark.createDataFrame([(None, 1)], "group string, other long"))
    got = joins.salted_join(left, right, "group", ["other"], partitions)
    want = joins.plain_join(left, right, "group")
    assert rows(got.select("group", "value", "other")) == rows(want.select("group", "value", "other"))
    assert got.count() == 50


@pytest.fixture(scope="module")
def ticks(spark):
    key = F.when(F.col("id") % 3 == 0, "apple").otherwise(F.concat(F.lit("t"), (F.col("id") % 50).cast("string")))
    return spark.range(3000).select(key.alias("ticker"), F.col("id").alias("time"), (F.col("id") % 7).alias("value"))


def test_hot_keys(ticks):
    (key, salts), = rows(skew.hot_keys(ticks, "ticker", 9))  # a third of the rows, so three partitions
    assert key == "apple" and salts in (12, 13)
    assert rows(skew.hot_keys(ticks, "ticker", 2)) == []
    assert rows(skew.hot_keys(ticks.limit(0), "ticker", 2)) == []


def test_skew_partition_spreads_only_the_hot_keys(ticks):
    """Half of the rows have no key, a third has one key; no place gets over twice the mean."""
    third = ticks.where("ticker = 'apple'")
    nulls = third.withColumn("ticker", F.lit(None).cast("string")).withColumn("time", F.col("time") + 10_000)
    df = ticks.union(nulls).union(nulls.withColumn("time", F.col("time") + 10_000))
    n = 8
    out = partition.skew_partition(df, n, "ticker", ["time"]).withColumn("p", F.spark_partition_id())
    sizes = [r["n"] for r in out.groupBy("p").agg(F.count("*").alias("n")).collect()]
    assert max(sizes) <= 2 * sum(sizes) / n
    places = {r["ticker"]: r["n"] for r in out.groupBy("ticker").agg(F.countDistinct("p").alias("n")).collect()}
    assert places.pop("apple") > 1 and places.pop(None) > 2 and set(places.values()) == {1}
    assert rows(out.drop("p", "_salt")) == rows(df)


@pytest.mark.parametrize("whole", [True, False])
def test_partition_sorted(ticks, whole):
    out = partition.partition_sorted(ticks, 6, ["ticker"], ["time"], whole_groups=whole)
    placed = out.select(F.spark_partition_id().alias("p"), "ticker", "time").collect()
    by_place = {}
    for r in placed:
        by_place.setdefault(r["p"], []).append((r["ticker"], r["time"]))
    assert all(v == sorted(v) for v in by_place.values())
    if whole:
        assert len({(r["p"], r["ticker"]) for r in placed}) == len({r["ticker"] for r in placed})
    else:
        assert max(map(len, by_place.values())) < 3000 / 3


def test_sum_by(ticks):
    out = partition.sum_by(ticks, ["ticker", "time"], F.col("value"), "total", partitions=10)
    assert out.rdd.getNumPartitions() == 10 and out.agg(F.sum("total")).first()[0] == sum(i % 7 for i in range(3000))


# ------------------------------------------------------------------ sets


def test_multiset_diff(spark):
    a = spark.createDataFrame([("x",), ("x",), ("x",), ("y",), ("z",), (None,)], "value string")
    b = spark.createDataFrame([("x",), ("z",), ("w",), ("w",)], "value string")
    out = setops.multiset_diff(a, b, ["value"])
    assert rows(out) == [("w", -2), ("x", 2), ("y", 1), (None, 1)]
    positive = out.where("net > 0").select("value", F.explode(F.sequence(F.lit(1), F.col("net")))).select("value")
    assert rows(positive) == rows(a.exceptAll(b))
    assert out.agg(F.sum("net")).first()[0] == a.count() - b.count()


def test_page_firsts_and_adjacent_duplicates(spark):
    values = [1, 1, 2, 2, 3, 3, 3, 4, 4, 4, 5, 5, 5, 6, 6, 6, 7, 8, 8, 8]
    df = files.from_values(spark, values, 4)
    assert rows(df.select(F.spark_partition_id(), "page").distinct()) == [(i, i) for i in range(4)]
    firsts = setops.page_firsts(df, "page", ["pos"], "value")
    assert rows(firsts) == [(0, 1), (1, 3), (2, 5), (3, 6)]
    declared = spark.range(5).select(F.col("id").cast("int").alias("page"))
    assert rows(setops.page_firsts(df, "page", ["pos"], "value", declared))[-1] == (4, -1)
    inside = setops.dedup_adjacent(df, ["pos"], "value", page="page").orderBy("pos")
    assert [r["value"] for r in inside.collect()] == [1, 2, 3, 3, 4, 5, 6, 6, 7, 8]
    overall = setops.dedup_adjacent(df, ["pos"], "value").orderBy("pos")
    assert [r["value"] for r in overall.collect()] == [1, 2, 3, 4, 5, 6, 7, 8]


# ------------------------------------------------------------------ nested data


@pytest.fixture(scope="module")
def nested_df(spark):
    return spark.createDataFrame(NESTED, files.SCHEMAS["nested"])


def test_explode(nested_df):
    want = [(g, *pair) for g, _, _, items in NESTED for pair in items]
    assert rows(nested.explode_structs(nested_df, ["group"], "nested")) == sorted(want)
    assert rows(nested.explode_structs_sql(nested_df, "with_pairs", ["group"], "nested")) == sorted(want)


def test_flatten(nested_df):
    got = Counter(tuple(r) for r in nested.flatten_rows(nested_df.where("group = 'A'"), []).collect())
    assert got == Counter([
        ("group", "string", "A"), ("time", "bigint", "5"), ("value", "bigint", "3"),
        ("nested.col1", "double", "0.1"), ("nested.col1", "double", "1.1"),
        ("nested.col2", "double", "0.2"), ("nested.col2", "double", "1.2"),
    ])


def test_flatten_any_depth_nulls_and_empty(spark):
    schema = "id int, a array<struct<x:int,b:array<struct<y:string>>>>, s struct<t:string,u:array<int>>"
    data = [(1, [(1, [("p",), (None,)]), (2, [])], ("q", [7, 8])), (2, None, None), (3, [], (None, None))]
    got = rows(nested.flatten_rows(spark.createDataFrame(data, schema), ["id"]))
    want = [
        (1, "id", "int", "1"), (1, "a.x", "int", "1"), (1, "a.x", "int", "2"), (1, "a.b.y", "string", "p"),
        (1, "a.b.y", "string", None), (1, "s.t", "string", "q"), (1, "s.u", "int", "7"), (1, "s.u", "int", "8"),
        (2, "id", "int", "2"), (2, "s.t", "string", None), (3, "id", "int", "3"), (3, "s.t", "string", None),
    ]
    assert got == sorted(want, key=repr)


def test_table_roundtrip(spark, tmp_path):
    """Null and empty arrays, two levels, names with capitals."""
    ddl = "Key bigint, items array<struct<Name:string,tags:array<string>>>, note string"
    schema = nested.create_table_if_absent(spark, "shop_empty", ddl, str(tmp_path / "empty"))
    assert nested.create_table_if_absent(spark, "shop_empty", ddl, str(tmp_path / "empty")) == schema
    data = [(7, None, "none"), (8, [], None), (9, [("Lamp", ["old", None]), (None, None), ("Rug", [])], "three")]
    df = nested.rows_to_frame(spark, data * 10, schema)
    saved = nested.save_table(df, "shop_full", str(tmp_path / "full"), files=3)
    assert rows(saved) == rows(df)
    assert len(list((tmp_path / "full").glob("*.gz.parquet"))) == 3
    assert files.query_view(saved, "v", limit=2).count() == 2
    assert "Name: string" in files.schema_tree(saved)


# ------------------------------------------------------------------ files


def test_readers(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"group":"A", "time":5, "value":3}\n\n{"group":"B", "time":6}\n')
    path = str(tmp_path / "a.json")
    assert rows(files.read_json(spark, path, files.SCHEMAS["window"])) == [("A", 5, 3), ("B", 6, None)]
    assert set(files.read_json(spark, path).columns) == {"group", "time", "value"}
    (tmp_path / "p.csv").write_text('PassengerId,Name,Age\n892,"Kelly, Mr. James é",34.5\n893,"X",\n', encoding="utf-8")
    csv = files.read_csv(spark, str(tmp_path / "p.csv"))
    assert rows(csv) == [("892", "Kelly, Mr. James é", "34.5"), ("893", "X", None)]
    assert {t for _, t in csv.dtypes} == {"string"}
    (tmp_path / "d.tsv").write_text("overcast\t83\thot\t86\thigh\tFALSE\tyes\n")
    tsv = files.read_tsv(spark, str(tmp_path / "d.tsv"), schema=files.SCHEMAS["weather"])
    assert rows(tsv) == [("overcast", 83, "hot", 86, "high", False, "yes")]
    assert files.read_lines(spark, path).count() == 3


# ------------------------------------------------------------------ parsing


@pytest.mark.parametrize("line,words", [
    ("Hi there", ["hi", "there"]), ("a b ", ["a", "b"]), (" a", ["", "a"]), ("", [""]), ("   ", []), ("a  b", ["a", "", "b"]),
])
def test_tokens(spark, line, words):
    df = spark.createDataFrame([(line,)], "value string")
    assert [r["word"] for r in parse.explode_tokens(df).collect()] == words


def test_tokens_keep_case_on_request(spark):
    df = spark.createDataFrame([("Hi hi",)], "value string")
    assert [r["word"] for r in parse.explode_tokens(df, lower=False).collect()] == ["Hi", "hi"]


def test_messages(spark):
    lines = [
        "bob,tim,FB,10,123", "a,b,c,1,2,", "a,b,c,1,", "a,b,c,x,1", "a,b,c,1,1.5", "a,b,c,1,2,3", "", None, ",,,1,2",
    ]
    df = spark.createDataFrame([(s,) for s in lines], "value string")
    got = rows(parse.parse_messages(df).drop("value"))
    assert got == [("", "", "", 1.0, 2), ("a", "b", "c", 1.0, 2), ("bob", "tim", "FB", 10.0, 123)]
    assert rows(parse.message_counts(df)) == [(3, 6)]
    stamped = parse.parse_messages(df, trade_time=F.lit(99))
    assert {r["tradeTs"] for r in stamped.collect()} == {99} and stamped.count() == 4


def test_weblog(spark):
    good = '66.249.1.2 - - [10/Oct/2023 13:55:36 -0700] "GET /x HTTP/1.1" 200 11179 "-" "agent"'
    df = spark.createDataFrame([(good,), ("1.1.1.1 no time",), ("nothing",), ("k ]early[ x",), ("k [bad] x",)], "value string")
    out = parse.parse_weblog(df).collect()
    assert out[0]["key"] == "66.249.1.2" and str(out[0]["log_time"].timestamp()) == "1696971336.0"
    assert [r["log_time"] for r in out[1:]] == [None] * 4
    assert [r["key"] for r in out[1:]] == ["1.1.1.1", None, "k", "k"]


# ------------------------------------------------------------------ session metrics


def test_session_metrics(spark):
    as_of = 1_000_000
    data = [
        (as_of - 20_000, as_of - 5_000, 3, True),      # active, short, new
        (as_of - 100_000, as_of - 20_000, 4, True),    # active, middle, not recent
        (as_of - 700_000, as_of - 29_999, 5, False),   # active, long
        (as_of - 60_000, as_of - 30_000, 6, False),    # exactly at the timeout: neither active nor dead
        (as_of - 60_000, as_of - 35_000, 7, False),    # dead
        (as_of - 90_000, as_of - 41_000, 8, False),    # long dead
    ]
    df = spark.createDataFrame(data, "start_ms long, end_ms long, events long, is_new boolean")
    got = dict(rows(sessions.session_metrics(df, F.lit(as_of), is_new=F.col("is_new"))))
    assert got == {
        "TOTAL_SESSION_TIME": 15_000 + 80_000 + 670_001, "UNDER_A_MINUTE_COUNT": 1,
        "ONE_TO_TEN_MINUTE_COUNT": 1, "OVER_TEN_MINUTES_COUNT": 1, "NEW_SESSION_COUNTS": 1,
        "TOTAL_SESSION_COUNTS": 3, "TOTAL_SESSION_EVENT_COUNTS": 12, "EVENT_COUNTS": 33, "DEAD_SESSION_COUNTS": 1,
    }
    metrics = sessions.session_metrics(df, F.lit(as_of))
    record = sessions.metric_record(metrics, F.lit(as_of)).first().asDict()
    assert record["row_key"] == f"C.{2**63 - 1 - as_of}" and record["TOTAL_SESSION_COUNTS"] == 3
    none = dict(rows(sessions.session_metrics(df.where("events < 0"), F.lit(as_of))))
    assert set(none.values()) == {0}


# ------------------------------------------------------------------ features and models


def test_weather_features(spark):
    df = features.weather_features(spark.createDataFrame(WEATHER, files.SCHEMAS["weather"]))
    first = df.select(*features.WEATHER_FEATURES, "label").first()
    assert tuple(first) == (0, 0, 1, 83, 1, 0, 0, 1, 0, 0, 1)
    assert df.agg(F.sum("label")).first()[0] == 9 and df.agg(F.sum("windy")).first()[0] == 6


def test_passenger_features(spark):
    schema = "id int, sex string, age string, sibSp string, parch string, cabin string, embarked string, pclass string, fare string"
    data = [(1, "male", None, "1", "0", "B57 F63", "C", "1", "26.5"), (2, "female", "3", "0", "2", None, "S", "3", "7")]
    df = features.passenger_features(spark.createDataFrame(data, schema))
    one, two = (tuple(r) for r in df.select(*features.PASSENGER_FEATURES).collect())
    assert len(features.PASSENGER_FEATURES) == 22
    assert one == (1, 45, 1, 1, 0, 0, 1, 0, 1, 0, 1, 0, 0, 0, 1, 0, 0, 0, 1, 0, 1, 26.5)
    assert two == (0, 3, 0, 0, 1, 2, 1, 1, 0, 0, 0, 0, 0, 0, 0, 0, 0, 1, 0, 0, 3, 7)
    vector = features.with_vector(df, features.PASSENGER_FEATURES, ("id",)).first()["features"]
    assert vector.size == 22 and vector[21] == 26.5


def test_rows_with_missing_numbers_are_kept(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0), (2, None, 5.0)], "id int, x double, y double")
    filled = features.with_vector(df, ("x", "y"), ("id",), fill=-1.0).collect()
    assert {r["id"]: r["features"].toArray().tolist() for r in filled} == {1: [2, 3, 0, 0], 2: [-1, 5, 1, 0]}
    with pytest.raises(Exception, match="null"):
        features.with_vector(df, ("x", "y"), ("id",)).collect()


def test_models_learn(spark):
    rows_ = spark.range(600).select("id", (F.col("id") % 2).cast("double").alias("label"), (F.col("id") % 2 * 5).cast("double").alias("x"), (F.col("id") % 13).cast("double").alias("y"))
    df = features.with_vector(rows_, ("x", "y"), ("id", "label"))
    train, test = ml.split(df, 0.7, ml.hash_place("id"))
    assert train.count() + test.count() == 600 and 350 < train.count() < 490
    assert train.join(test, "id").count() == 0
    compared = ml.compare(df, ml.hash_place("id")).collect()
    got = {r["model"]: (r["metric"], r["value"]) for r in compared}
    assert set(got) == set(ml.MODELS)
    stumps = ml.compare(df, ml.hash_place("id"), models=tuple(ml.STUMPS)).collect()
    assert [r["value"] for r in stumps] == [1.0, 1.0]
    labels = [r["label"] for r in test.collect()]
    share = max(labels.count(0.0), labels.count(1.0)) / len(labels)
    for r in compared:
        assert (r["n_train"], r["n_test"]) == (train.count(), len(labels)) and r["beats_baseline"]
        assert r["metric"] == "rmse" or r["baseline"] in (pytest.approx(share), pytest.approx(1 - share))
    for name, (metric, value) in got.items():
        if metric == "accuracy":
            assert value > 0.95, name
        else:
            assert value < 0.2
    assert "If (feature 0" in ml.tree_text(ml.decision_tree().fit(train))


def best_tree(rows, depth, impurity):
    """The greedy tree of whole-number features by trying all splits, as a function of a row."""
    import math

    def impure(labels):
        shares = [labels.count(v) / len(labels) for v in (0, 1)]
        if impurity == "gini":
            return 1 - sum(p * p for p in shares)
        return -sum(p * math.log2(p) for p in shares if p)

    labels = [y for _, y in rows]
    guess = int(2 * sum(labels) > len(labels))
    best, gain = None, 0.0
    for f in range(len(rows[0][0]) if depth else 0):
        values = sorted({x[f] for x, _ in rows})
        for a, b in zip(values, values[1:]):
            parts = [[r for r in rows if (r[0][f] <= a) == side] for side in (True, False)]
            got = impure(labels) - sum(len(p) / len(rows) * impure([y for _, y in p]) for p in parts)
            if got > gain + 1e-12:
                best, gain = (f, (a + b) / 2, parts), got
    if best is None:
        return lambda x: guess
    f, at, parts = best
    low, high = (best_tree(p, depth - 1, impurity) for p in parts)
    return lambda x: (low if x[f] <= at else high)(x)


@pytest.mark.parametrize("impurity", ["gini", "entropy"])
@pytest.mark.parametrize("depth", [1, 3])
def test_trees_against_all_splits(spark, impurity, depth):
    import random

    r = random.Random(depth)
    data = []
    for i in range(400):
        x = (r.randrange(9), r.randrange(5), r.randrange(2))
        data.append((i, float(r.random() < 0.1 + 0.7 * (x[0] > 4) * (x[1] < 3) + 0.15 * x[2]), *map(float, x)))
    df = features.with_vector(spark.createDataFrame(data, "id int, label double, x double, y double, z double"), ("x", "y", "z"), ("id", "label"))
    tree = best_tree([(d[2:], int(d[1])) for d in data], depth, impurity)
    got = {p.id: p.prediction for p in ml.decision_tree(impurity, depth).fit(df).transform(df).collect()}
    assert got == {d[0]: float(tree(d[2:])) for d in data}


def test_model_queries_return_their_results(spark, sf_dir):
    from oracle import connect

    from loomwork.workload import models

    n_train, n_test, accuracy, rmse = connect(sf_dir).execute(models.BASELINES_SQL).fetchone()
    got = models.QUERIES["ml_compare"](spark, sf_dir).collect()
    assert [r.model for r in got] == list(ml.MODELS)
    for row in got:
        plain = rmse if row.metric == "rmse" else accuracy
        assert (row.n_train, row.n_test) == (n_train, n_test) and row.baseline == pytest.approx(plain, abs=1e-9)
        assert row.beats_baseline == (row.value < plain - 1e-12 if row.metric == "rmse" else row.value > plain + 1e-12)
    one = models.QUERIES["ml_tree_gini"](spark, sf_dir).first()
    assert tuple(one) == tuple(next(r for r in got if r.model == "tree_gini"))
