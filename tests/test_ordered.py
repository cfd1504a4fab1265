"""Paged windows equal plain windows, whatever the pages and groups."""

import datetime

import pytest
from fixtures import INFLECTIONS, LEAD_LAG, MULTI_GROUP, SESSION_TIMES
from pyspark.sql import Window
from pyspark.sql import functions as F

from loomwork.operators import sessions, setops, timeseries
from loomwork.plans import ordered


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def skewed(spark):
    """2,000 rows: a third in one group, ties in ts, nulls in value and group."""
    i = F.col("id")
    group = F.when(i % 3 == 0, F.lit("hot")).when(i % 17 == 0, F.lit(None)).otherwise(F.concat(F.lit("g"), (i % 97).cast("string")))
    return spark.range(2000).select(
        group.alias("g"),
        (F.xxhash64("id") % 500).alias("ts"),
        i.alias("tie"),
        F.when(i % 11 != 0, F.pmod(F.xxhash64(i + 1), F.lit(50))).alias("v"),
    ).cache()


FRAMES = {
    "lag": lambda w: F.lag("v").over(w),
    "lead": lambda w: F.lead("v").over(w),
    "avg": lambda w: F.avg("v").over(w.rowsBetween(-3, 0)),
    "max": lambda w: F.max("v").over(w.rowsBetween(-2, 3)),
    "n": lambda w: F.count(F.lit(1)).over(w.rowsBetween(-3, 3)),
}


@pytest.mark.parametrize("group_by", [[], ["g"]])
@pytest.mark.parametrize("pages", [1, 2, 7, 60])
def test_frames(skewed, group_by, pages):
    order = ["ts", "tie"]
    got = ordered.ordered_frame(
        skewed, group_by, order, FRAMES, ["v"], 3, 3, pages=pages
    )
    w = Window.partitionBy(*group_by).orderBy(*order)
    want = skewed.select("*", *[make(w).alias(k) for k, make in FRAMES.items()])
    assert rows(got) == rows(want)


def test_plain_window_on_request(skewed):
    order = ["ts", "tie"]
    plain = ordered.ordered_frame(skewed, ["g"], order, FRAMES, ["v"], 3, 3, split_groups=False)
    assert "_page" not in plain._jdf.queryExecution().executedPlan().toString()
    assert rows(plain) == rows(ordered.ordered_frame(skewed, ["g"], order, FRAMES, ["v"], 3, 3, pages=5))


def test_pages_follow_the_rows(skewed):
    assert ordered.page_count(skewed, None, 100) == 20
    assert ordered.page_count(skewed, None, 10**9) == 1
    assert ordered.page_count(skewed, None, 1) == 2000
    assert ordered.page_count(skewed, 20_000, 100) == 20_000
    got = ordered.ordered_frame(skewed, [], ["ts", "tie"], {"p": lambda w: F.lag("v").over(w)}, ["v"], 1, rows_per_page=100)
    want = skewed.withColumn("p", F.lag("v").over(Window.orderBy("ts", "tie")))
    assert rows(got) == rows(want)


def test_input_is_read_once(spark):
    """An input that differs at every reading still gives every row its true neighbour."""
    df = spark.range(3000).select(F.col("id").alias("tie"), (F.rand() * 1e6).cast("long").alias("ts"))
    df = df.withColumn("v", F.col("ts") * 2)
    out = ordered.ordered_frame(df, [], ["ts", "tie"], {"p": lambda w: F.lag("v").over(w)}, ["v"], 1, pages=9).collect()
    ordered_rows = sorted(out, key=lambda r: (r["ts"], r["tie"]))
    assert len(out) == 3000 and {r["tie"] for r in out} == set(range(3000))
    assert [r["p"] for r in ordered_rows] == [None, *[r["v"] for r in ordered_rows[:-1]]]


def test_pages_are_even_and_split_the_hot_group(skewed):
    paged = ordered.with_page(skewed, ["g", "ts", "tie"], 8)
    sizes = [r["n"] for r in paged.groupBy("_page").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 2000 / 8
    assert paged.where("g = 'hot'").select("_page").distinct().count() >= 3


@pytest.mark.parametrize("dtype", ["timestamp", "timestamp_ntz", "date", "double", "decimal(20,3)", "string"])
def test_any_key_type(spark, dtype):
    base = datetime.datetime(2024, 10, 27, 0, 0, 0, 123456)
    data = [(base + datetime.timedelta(hours=7 * i), i) for i in range(300)]
    df = spark.createDataFrame(data, "t timestamp_ntz, v long")
    number = F.col("v") / 8 - 20 if dtype in ("double", "decimal(20,3)") else None
    text = F.concat(F.lit("it's \\ "), F.col("v").cast("string")) if dtype == "string" else None
    key = text if text is not None else number if number is not None else F.col("t")
    df = df.select(key.cast(dtype).alias("k"), "v")
    got = ordered.ordered_frame(df, [], ["k", "v"], {"p": lambda w: F.lag("v").over(w)}, ["v"], 1, pages=16)
    want = df.withColumn("p", F.lag("v").over(Window.orderBy("k", "v")))
    assert rows(got) == rows(want)


@pytest.mark.parametrize("pages", [1, 3, 40])
@pytest.mark.parametrize("gap", [0, 5, 1000])
def test_sessions_equal_brute_force(skewed, pages, gap):
    times = {}
    for r in skewed.collect():
        times.setdefault(r["g"], []).append(r["ts"])
    want = []
    for g, ts in times.items():
        start = last = None
        n = 0
        for t in sorted(ts):
            if last is not None and t > last + gap:
                want.append((g, start, last, n, last - start))
                start, n = None, 0
            start, last, n = (t if start is None else start), t, n + 1
        want.append((g, start, last, n, last - start))
    for split in (True, False):
        got = sessions.sessions(skewed, ["g"], ["ts", "tie"], F.lit(gap), pages=pages, split_groups=split)
        assert rows(got.select("g", "session_start", "session_end", "events", "length")) == sorted(want, key=repr)


@pytest.mark.parametrize("pages", [1, 4, 40])
@pytest.mark.parametrize("page", [None, "g"])
def test_dedup_adjacent(skewed, pages, page):
    got = setops.dedup_adjacent(skewed, ["ts", "tie"], "v", page=page, pages=pages)
    w = Window.partitionBy(*([page] if page else [])).orderBy("ts", "tie")
    want = skewed.withColumn("p", F.lag("v").over(w)).withColumn("rn", F.row_number().over(w)).where(
        (F.col("rn") == 1) | ~F.col("p").eqNullSafe(F.col("v"))
    ).drop("p", "rn")
    assert rows(got) == rows(want)


def test_no_single_partition_over_raw_rows(spark, sf_dir):
    from loomwork.workload import batch

    for name in ("sliding_stats_global", "diff_global_paged", "dedup_adjacent_global"):
        df = batch.QUERIES[name](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan
        assert not [s for s in scans_below(plan, "Exchange SinglePartition") if "events.parquet" in s]


def scans_below(plan, operator):
    """Scan lines in the subtrees of ``operator`` in a plan text."""
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    below, found = None, []
    for line in plan.splitlines():
        if below is not None and depth(line) <= below:
            below = None
        if below is not None and "Scan" in line:
            found.append(line)
        if below is None and operator in line:
            below = depth(line)
    return found


# ------------------------------------------------------------------ known results


@pytest.fixture(scope="module")
def lead_lag(spark):
    return spark.createDataFrame(LEAD_LAG, "group string, ts long, value long")


def test_diff_by_group(spark):
    df = spark.createDataFrame(MULTI_GROUP, "group string, time long, value long")
    for split in (True, False):
        out = timeseries.diff_to_previous(df, ["time"], "value", ["group"], split_groups=split)
        for g in "AB":
            got = [r["dif"] for r in out.where(F.col("group") == g).orderBy("time").collect()]
            assert got == [1, 1, -1, 1, 1, -2, 3]


def test_peaks(lead_lag):
    want = {
        "A": {6: "peak", 8: "valley", 9: "peak", 11: "valley", 16: "peak", 18: "valley"},
        "B": {6: "peak", 8: "valley", 11: "peak", 12: "valley", 15: "peak", 18: "valley"},
    }
    for split in (True, False):
        out = timeseries.peak_valley(lead_lag, ["group"], ["ts"], "value", split_groups=split).collect()
        for r in out:
            assert r["turn"] == want[r["group"]].get(r["ts"], "n/a")


def test_sliding(lead_lag):
    out = timeseries.sliding_stats(lead_lag, ["ts", "group"], "value").orderBy("ts", "group").limit(6)
    got = [(round(r["v_moving_avg"], 3), r["v_moving_min"], r["v_moving_max"]) for r in out.collect()]
    assert got == [(100, 100, 100), (100, 100, 100), (100.333, 100, 101), (100.5, 100, 101), (101, 100, 102), (101.5, 101, 102)]


def test_sliding_over_inflections_only(spark):
    data = [(g, t, v) for g, t, v in LEAD_LAG if (g, t) in INFLECTIONS]
    df = spark.createDataFrame(data, "group string, ts long, value long")
    out = timeseries.sliding_stats(df, ["ts", "group"], "value").collect()
    assert {(r["group"], r["ts"]): r["v_moving_avg"] for r in out} == {("B", 15): 104.0, ("A", 17): 103.5}


def test_tumbling(lead_lag):
    out = timeseries.tumbling_stats(lead_lag, "group", timeseries.centred_bucket(F.col("ts"), 3), "value")
    got = {(r["group"], int(r["bucket"])): (round(r["v_avg"], 3), r["v_max"], r["v_min"]) for r in out.collect()}
    shared = {0: (100, 100, 100), 1: (102, 103, 101), 2: (104, 105, 103), 3: (103.5, 105, 102), 6: (103.333, 105, 102)}
    want = {
        "A": {**shared, 4: (101, 102, 100), 5: (104, 105, 103)},
        "B": {**shared, 4: (103, 106, 101), 5: (103.333, 104, 103)},
    }
    assert got == {(g, b): v for g, d in want.items() for b, v in d.items()}


def test_sessions(spark):
    df = spark.createDataFrame(SESSION_TIMES, "group string, ts long")
    want = [
        ("A", 1, 4, 3, 4), ("A", 15, 17, 2, 3), ("A", 28, 30, 2, 3), ("A", 41, 42, 1, 2), ("A", 53, 56, 3, 4),
        ("B", 12, 23, 11, 10), ("B", 34, 37, 3, 4), ("B", 48, 49, 1, 2),
    ]
    for split in (True, False):
        out = sessions.sessions(df, ["group"], ["ts"], F.lit(10), split_groups=split)
        assert rows(out.select("group", "session_start", "session_end", "length", "events")) == want


def test_empty_input(lead_lag):
    none = lead_lag.where("ts < 0")
    assert timeseries.sliding_stats(none, ["ts", "group"], "value").count() == 0
    assert sessions.sessions(none, ["group"], ["ts"], F.lit(10)).count() == 0


@pytest.fixture
def few_ranges(monkeypatch):
    monkeypatch.setattr(ordered, "RANGES", 4)


@pytest.mark.parametrize("pages", [5, 60])
def test_pages_within_ranges(skewed, few_ranges, pages):
    """The same as plain windows where the borders of pages are a table."""
    from pyspark.sql import Window

    order = ["ts", "tie"]
    for group_by in ([], ["g"]):
        window = Window.partitionBy(*group_by).orderBy(*order)
        plain = skewed.select("*", *[make(window).alias(name) for name, make in FRAMES.items()])
        got = ordered.ordered_frame(skewed, group_by, order, FRAMES, ["v"], 3, 3, pages=pages)
        assert rows(plain) == rows(got)
    split = sessions.sessions(skewed, ["g"], order, F.lit(5), pages=pages)
    assert rows(split) == rows(sessions.sessions(skewed, ["g"], order, F.lit(5), split_groups=False))


def test_ranges_are_even_and_pages_not_empty(skewed, few_ranges):
    n = ordered.whole_ranges(30)
    paged = ordered.with_page(skewed, ["g", "ts", "tie"], n)
    sizes = dict(paged.groupBy(ordered.PAGE).count().collect())
    assert n == 32 and set(sizes) == set(range(len(sizes))) and len(sizes) >= 28
    assert max(sizes.values()) <= 4 * skewed.count() / n


def test_a_plan_of_very_many_pages(spark):
    """No array of all borders in the plan of the rows, and no window over their keys as a whole."""
    n = ordered.whole_ranges(100_000)
    paged = ordered.with_page(spark.range(3000).select("id"), ["id"], n)
    plan = paged._jdf.queryExecution().optimizedPlan().toString()
    assert n >= 100_000 and "_range" in plan and "windowspecdefinition" not in plan and "Window" not in plan
    assert paged.agg(F.countDistinct(ordered.PAGE)).first()[0] > 1000
