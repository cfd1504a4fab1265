"""Streams over several files: parity with batch, late rows, retries."""

import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from loomwork.functions.parse import parse_weblog
from loomwork.operators import sessions as batch_sessions
from loomwork.sources.sinks import PartitionSink, Written, read_partitions
from loomwork.sources.streams import new_files, parquet_table, replay, with_ingest_time
from loomwork.streaming import counts, windows
from loomwork.streaming.sessions import SessionStream, session_lines
from loomwork.streaming.tables import ResultTable

T0 = datetime.datetime(2024, 1, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def text_stream(spark, folder, *batches):
    folder.mkdir()
    for i, lines in enumerate(batches):
        path = folder / f"{i}.txt"
        path.write_text("".join(f"{line}\n" for line in lines))
        import os

        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    return new_files(spark, str(folder), per_batch=1)


def event_stream(spark, folder, batches, columns="key string, t timestamp, v double"):
    """One file per batch, each later than the one before."""
    import os

    folder.mkdir()
    schema = spark.createDataFrame([], columns).schema
    for i, data in enumerate(batches):
        pdf = pd.DataFrame(data, columns=schema.fieldNames())
        pdf["t"] = pdf["t"].astype("datetime64[us]").dt.tz_localize("UTC")
        path = folder / f"{i}.parquet"
        pdf.to_parquet(path)
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    return parquet_table(spark, str(folder), schema, per_batch=1)


LINES = (["hi there"], ["hi bob", "Hi "])


def test_word_counts(spark, tmp_path):
    lines = text_stream(spark, tmp_path / "in", *LINES)
    want = [("bob", 1), ("hi", 3), ("there", 1)]
    assert rows(ResultTable(counts.word_counts(lines), "complete").run()) == want
    assert rows(ResultTable(counts.word_counts(lines), "update", keys=["word"]).run()) == want
    assert rows(ResultTable(counts.word_counts_by_state(lines), "update", keys=["word"]).run()) == want
    cased = ResultTable(counts.word_counts(lines, lower=False), "complete").run()
    assert rows(cased) == [("Hi", 1), ("bob", 1), ("hi", 2), ("there", 1)]


@pytest.fixture
def default_state_store(spark):
    """The session as Spark starts it, without the state store of ``session.SETTINGS``."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    yield
    spark.conf.set(name, before)


def test_word_counts_by_state_in_a_plain_session(spark, tmp_path, default_state_store):
    lines = text_stream(spark, tmp_path / "in", *LINES)
    out = ResultTable(counts.word_counts_by_state(lines, buckets=2), "update", keys=["word"]).run()
    assert rows(out) == [("bob", 1), ("hi", 3), ("there", 1)]


def test_batch_counts_do_not_carry_over(spark, tmp_path):
    out = counts.batch_word_counts(text_stream(spark, tmp_path / "in", *LINES)).run()
    assert rows(out.select("batch_id", "word", "n")) == [(0, "hi", 1), (0, "there", 1), (1, "bob", 1), (1, "hi", 2)]


def test_repeated_batch_overwrites_itself(spark, tmp_path):
    lines = text_stream(spark, tmp_path / "in", *LINES)
    table = counts.batch_word_counts(lines)
    first = rows(table.run())
    again = spark.createDataFrame([("hi bob",), ("Hi ",)], "value string")
    table._write(again, 1)
    assert rows(table.read()) == first


def test_text_batches(spark, tmp_path):
    from loomwork.sources.sinks import text_batches

    lines = text_stream(spark, tmp_path / "in", *LINES)
    out = str(tmp_path / "out")
    stream = lines.writeStream.option("checkpointLocation", str(tmp_path / "cp"))
    stream.trigger(availableNow=True).foreachBatch(text_batches(out)).start().awaitTermination()
    text_batches(out)(spark.createDataFrame([("hi bob",), ("Hi ",)], "value string"), 1)
    assert rows(spark.read.text(out)) == [("Hi ", 1), ("hi bob", 1), ("hi there", 0)]


def test_restart_from_checkpoint_goes_on(spark, tmp_path):
    lines = text_stream(spark, tmp_path / "in", *LINES)
    args = dict(mode="update", keys=["word"], path=str(tmp_path / "out"), checkpoint=str(tmp_path / "state"))
    ResultTable(counts.word_counts(lines), **args).run()
    (tmp_path / "in" / "9.txt").write_text("hi\n")
    assert ("hi", 4) in rows(ResultTable(counts.word_counts(lines), **args).run())
    # a table opened again reads what is there, also when nothing new comes
    assert ("hi", 4) in rows(ResultTable(counts.word_counts(lines), **args).run())
    complete = {**args, "mode": "complete", "path": str(tmp_path / "c"), "checkpoint": str(tmp_path / "cs")}
    first = rows(ResultTable(counts.word_counts(lines), **complete).run())
    assert first == rows(ResultTable(counts.word_counts(lines), **complete).read())


def test_table_without_batches_is_empty(spark, tmp_path):
    lines = text_stream(spark, tmp_path / "in")
    assert ResultTable(counts.word_counts(lines), "complete").run().columns == ["word", "n"]
    assert ResultTable(counts.word_counts(lines), "update", keys=["word"]).run().count() == 0


def test_entity_counts_are_polled_by_name(spark, tmp_path):
    lines = text_stream(spark, tmp_path / "in", ["bob,tim,FB,10,1", "bad", "bob,cat,G,20,2"], ["tim,cat,FB,11,3"])
    from loomwork.functions.parse import parse_messages

    tables = counts.entity_counts(parse_messages(lines), ["ticker", "destUser"], "live")
    for query in [t.start() for t in tables.values()]:
        query.awaitTermination()
    assert rows(spark.sql("SELECT ticker, n FROM live_ticker")) == [("FB", 2), ("G", 1)]
    assert rows(spark.sql("SELECT destUser, n FROM live_destUser")) == [("cat", 2), ("tim", 1)]


def test_ticker_sums(spark, tmp_path):
    from loomwork.functions.parse import parse_messages

    lines = text_stream(spark, tmp_path / "in", ["bob,tim,FB,10,1", "bob,tim,FB,10,2"], ["x", "bob,tim,FB,11,3", "bob,cat,G,20,3"])
    out = ResultTable(counts.ticker_sums(parse_messages(lines)), "complete").run()
    assert rows(out.withColumn("avg_price", F.round("avg_price", 4))) == [("FB", "tim", 31.0, 10.3333), ("G", "cat", 20.0, 20.0)]


def test_window_drops_late_rows(spark, tmp_path):
    at = lambda s: T0 + datetime.timedelta(seconds=s)
    stream = event_stream(
        spark, tmp_path / "in",
        # rows are held against the watermark of the batch before the last
        [[("FB", at(12), 10.0), ("FB", at(3), 1.0)], [("FB", at(200), 5.0)], [("FB", at(201), 5.0)], [("FB", at(4), 99.0)]],
    ).withColumnRenamed("key", "ticker")
    report = windows.window_trades(stream, "t", price="v")
    out = ResultTable(report, "update", keys=["window_start", "window_end", "ticker"]).run().collect()
    by_start = {(r["window_start"] - T0).total_seconds(): r for r in out}
    assert by_start[0]["trades"] == 2 and by_start[0]["total_price"] == 11.0
    assert by_start[10]["total_price"] == 10.0 and by_start[10]["max_time"] == at(12)
    assert by_start[200]["trades"] == 2
    assert all(r["total_price"] < 99 for r in out)
    assert {(r["window_end"] - r["window_start"]).total_seconds() for r in out} == {30}


def test_ingest_window(spark, tmp_path):
    lines = with_ingest_time(text_stream(spark, tmp_path / "in", ["bob,tim,FB,10,1", "bob,tim,FB,12,junk", "bad"]))
    report = windows.ingest_window_trades(lines)
    out = ResultTable(report, "update", keys=["window_start", "window_end", "ticker"]).run()
    assert {(r["ticker"], r["trades"], r["total_price"]) for r in out.collect()} == {("FB", 2, 22.0)}
    assert out.count() == 6


def test_enrich(spark, tmp_path):
    lines = text_stream(spark, tmp_path / "in", ["bob,tim,fb,10,1", "bad"])
    assert rows(ResultTable(windows.enrich(lines), "append").run().select("value")) == [("BOB,TIM,FB,10.0,1",)]


# ------------------------------------------------------------------ tables and their files


def split_tables(spark, sf_dir, folder, parts):
    """Links to all tables, with those that streams read as folders of ``parts`` files."""
    import os

    folder.mkdir()
    for name in os.listdir(sf_dir):
        if name.split(".")[0] in ("documents", "events", "conversations") and parts:
            spark.read.parquet(f"{sf_dir}/{name}").repartition(parts).write.parquet(str(folder / name))
        else:
            os.symlink(f"{sf_dir}/{name}", folder / name)
    return str(folder)


STREAMS = sorted(n for n in __import__("__spark_entry__").queries() if n.startswith("stream_"))


@pytest.fixture(scope="module")
def as_folders(spark, sf_dir, tmp_path_factory):
    return split_tables(spark, sf_dir, tmp_path_factory.mktemp("tables") / "split", 3)


@pytest.mark.parametrize("name", STREAMS)
def test_folder_tables_give_the_same_rows(spark, sf_dir, as_folders, name):
    query = __import__("__spark_entry__").queries()[name]
    got = rows(query(spark, as_folders))
    assert got and got == rows(query(spark, sf_dir))


def test_several_batches_from_a_folder_table(spark, sf_dir, as_folders):
    path, one = f"{as_folders}/events.parquet", f"{sf_dir}/events.parquet"
    schema = spark.read.parquet(one).schema
    count = lambda df: df.groupBy("event_type").count()
    got = ResultTable(count(parquet_table(spark, path, schema, per_batch=1)), "update", keys=["event_type"])
    assert rows(got.run()) == rows(count(spark.read.parquet(one))) and got.last >= 2


def test_missing_table_raises(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        parquet_table(spark, str(tmp_path / "none.parquet"), spark.range(1).schema)


def test_named_table_can_be_polled_before_the_first_batch(spark, tmp_path):
    lines = text_stream(spark, tmp_path / "in", *LINES)
    table = ResultTable(counts.word_counts(lines), "complete", name="early_counts")
    assert spark.sql("SELECT * FROM early_counts").columns == ["word", "n"]
    table.run()
    assert ("hi", 3) in rows(spark.sql("SELECT * FROM early_counts"))


@pytest.mark.parametrize("mode", ["update", "append"])
def test_many_batches(spark, tmp_path, mode):
    stream = text_stream(spark, tmp_path / "in")
    table = ResultTable(stream, mode, keys=["value"] if mode == "update" else [], path=str(tmp_path / "out"))
    n = 25
    for i in range(n):
        table._write(spark.createDataFrame([(f"w{i % 10}",)], "value string").coalesce(1), i)
    got = rows(table.read().select("value"))
    assert got == sorted((f"w{i}",) for i in range(10)) if mode == "update" else len(got) == n
    again = ResultTable(stream, mode, keys=table.keys, path=table.path)
    assert again.last == n - 1 and rows(again.read().select("value")) == got


def test_reader_sees_whole_batches_only(spark, tmp_path):
    stream = text_stream(spark, tmp_path / "in")
    table = ResultTable(stream, "append", path=str(tmp_path / "out"))
    table._write(spark.createDataFrame([("a",)], "value string"), 0)
    half = tmp_path / "out" / "batch_id=1"  # an attempt that died
    spark.createDataFrame([("half",)], "value string").write.parquet(str(half))
    (half / "_SUCCESS").unlink()
    assert rows(ResultTable(stream, "append", path=table.path).read().select("value")) == [("a",)]
    table._write(spark.createDataFrame([("b",)], "value string"), 1)
    table._write(spark.createDataFrame([("b",)], "value string"), 1)
    assert rows(table.read().select("value")) == [("a",), ("b",)]


def test_partition_sink(spark, tmp_path):
    lines, path = text_stream(spark, tmp_path / "in", *LINES), str(tmp_path / "out")
    spark.dataSource.register(PartitionSink)
    args = dict(path=path, checkpointLocation=str(tmp_path / "cp"))
    lines.writeStream.format("partitions").options(**args).trigger(availableNow=True).start().awaitTermination()
    want = [("Hi ",), ("hi bob",), ("hi there",)]
    assert rows(read_partitions(spark, path, lines.schema)) == want
    writer = PartitionSink({"path": path}).streamWriter(lines.schema, False)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["hi bob", "Hi "])], ["value"])
    lost = writer.write(iter([batch]))  # written, never named
    assert lost.rows == 2 and rows(read_partitions(spark, path, lines.schema)) == want
    again = writer.write(iter([batch]))
    writer.commit([again, Written("", 0), None], 1)  # the batch is repeated
    assert rows(read_partitions(spark, path, lines.schema)) == want
    writer.abort([writer.write(iter([batch]))], 2)
    assert rows(read_partitions(spark, path, lines.schema)) == want
    assert writer.write(iter([])).rows == 0
    assert read_partitions(spark, str(tmp_path / "out"), lines.schema).count() == 3


# ------------------------------------------------------------------ sessions


def run_sessions(stream, watermark="1 hour", gap="10 seconds"):
    out = SessionStream(stream, "key", "t", gap, watermark)
    out.run()
    return out


def test_sessions_out_of_order_equal_batch(spark, tmp_path):
    at = lambda s: T0 + datetime.timedelta(seconds=s)
    # batch 2 bridges two sessions of batch 0 and extends one backwards
    batches = [
        [("a", at(t), 0.0) for t in (100, 105, 130, 135)] + [("b", at(50), 0.0)],
        [("a", at(300), 0.0), ("b", at(61), 0.0)],
        [("a", at(t), 0.0) for t in (115, 124, 95)] + [("b", at(60), 0.0)],
    ]
    stream = event_stream(spark, tmp_path / "in", batches)
    got = run_sessions(stream).all_sessions()
    flat = [(k, t) for b in batches for k, t, _ in b]
    df = spark.createDataFrame(flat, "key string, t timestamp")
    want = batch_sessions.sessions(df, ["key"], ["t"], F.expr("INTERVAL '10' SECOND"))
    columns = ["key", "session_start", "session_end", "events"]
    assert rows(got.select(*columns)) == rows(want.select(*columns))


def test_sessions_close_behind_the_watermark(spark, tmp_path):
    at = lambda s: T0 + datetime.timedelta(seconds=s)
    batches = [
        [("a", at(0), 0.0), ("a", at(5), 0.0)],
        [("b", at(1000), 0.0)],
        [("b", at(1001), 0.0)],
        [("a", at(8), 0.0)],  # far too late by now
        [("a", at(1100), 0.0)],
    ]
    stream = event_stream(spark, tmp_path / "in", batches)
    out = run_sessions(stream, watermark="20 seconds")
    seen = lambda df: sorted((r["key"], (r["session_start"] - T0).total_seconds(), r["events"]) for r in df.collect())
    assert seen(out.all_sessions()) == [("a", 0, 2), ("a", 1100, 1), ("b", 1000, 2)]
    assert seen(out.live()) == [("a", 1100, 1)] and len(out.batches) == 5
    assert seen(out.live(out.batches[0].batch_id)) == [("a", 0, 2)]


def put(spark, folder, data, columns="key string, s long, part int"):
    rows_ = spark.createDataFrame(data, columns).withColumn("t", F.timestamp_seconds(F.col("s") + 1_700_000_000))
    return rows_.select("key", "t", "part", F.concat_ws(" ", "key", "s").alias("line"))


def shuffled_events(seed, n=400):
    import random

    r = random.Random(seed)
    return [(r.choice("aaaaabcd") if r.random() < 0.98 else None, r.randrange(20_000)) for _ in range(n)]


def expected_lines(events, gap):
    out, last = [], {}
    for key, s in sorted(events, key=lambda e: e[1]):
        start, end = last.get(key, (None, None))
        start = s if end is None or s > end + gap else start
        last[key] = start, s
        out.append((start, key, s))
    return sorted(out, key=repr)


@pytest.mark.parametrize("parts", [1, 3, 20])
def test_session_text_is_the_same_from_any_batches(spark, tmp_path, parts):
    """Events out of order over batches; the start goes on from batch to batch."""
    import random

    events, r = shuffled_events(5), random.Random(parts)
    order = sorted(events, key=lambda e: e[1] + r.randrange(2000))  # up to 2000 s late
    data = [(k, s, i * parts // len(order)) for i, (k, s) in enumerate(order)] + [("end", 60_000, parts)]
    all_rows = put(spark, tmp_path, data)
    folder = str(tmp_path / "in")
    all_rows.limit(0).write.parquet(folder)
    stream = spark.readStream.schema(all_rows.schema).parquet(folder)
    table = ResultTable(session_lines(stream, "key", "t", F.coalesce("line", F.lit("")), 60, "2500 seconds"), "append")
    for _ in replay(all_rows, F.col("part"), parts + 1, folder):
        got = table.run()
    seen = []
    for v in got.select("value").collect():
        start, line = v.value.split("\t")
        at = datetime.datetime.strptime(start, "%d/%b/%Y %H:%M:%S %z").timestamp()
        key, _, s = line.rpartition(" ")
        seen.append((int(at) - 1_700_000_000, key or None, int(s)))
    assert sorted(seen, key=repr) == expected_lines(events, 60)


def test_session_text_in_a_plain_session(spark, tmp_path, default_state_store):
    test_session_text_is_the_same_from_any_batches(spark, tmp_path, 3)


def test_metrics_of_every_batch(spark, tmp_path):
    """All metrics by plain Python over the events seen up to each batch."""
    import random

    events, r = [e for e in shuffled_events(8) if e[0]], random.Random(2)
    order = sorted(events, key=lambda e: e[1] + r.randrange(3000))
    parts = 4
    data = [(k, s, i * parts // len(order)) for i, (k, s) in enumerate(order)]
    all_rows, folder = put(spark, tmp_path, data), str(tmp_path / "in")
    all_rows.limit(0).write.parquet(folder)
    out = SessionStream(spark.readStream.schema(all_rows.schema).parquet(folder), "key", "t", "60 seconds", "3500 seconds", arrival=F.col("part"))
    for part in replay(all_rows, F.col("part"), parts, folder):
        (batch,) = out.run()
        got = dict(rows(out.metrics(batch, timeout=60_000, slack=20_000, short=5_000, long=60_000)))
        now = max(s for _, s, p in data if p <= part)
        sessions = []
        for key in {k for k, _, _ in data}:
            for s, p in sorted((s, p) for k, s, p in data if k == key and p <= part):
                if not sessions or sessions[-1][0] != key or s > sessions[-1][2] + 60:
                    sessions.append([key, s, s, 0, p])
                sessions[-1][2:] = s, sessions[-1][3] + 1, min(p, sessions[-1][4])
        active = [x for x in sessions if now - x[2] < 60]
        length = lambda x: x[2] - x[1]
        assert got == {
            "TOTAL_SESSION_TIME": 1000 * sum(map(length, active)), "UNDER_A_MINUTE_COUNT": sum(length(x) < 5 for x in active),
            "ONE_TO_TEN_MINUTE_COUNT": sum(5 <= length(x) < 60 for x in active), "OVER_TEN_MINUTES_COUNT": sum(length(x) >= 60 for x in active),
            "NEW_SESSION_COUNTS": sum(now - x[2] < 20 and x[4] == part for x in active), "TOTAL_SESSION_COUNTS": len(active),
            "TOTAL_SESSION_EVENT_COUNTS": sum(x[3] for x in active), "EVENT_COUNTS": sum(p == part for _, _, p in data),
            "DEAD_SESSION_COUNTS": sum(60 < now - x[2] < 80 for x in sessions),
        }
        record = out.record(batch).collect()
        assert len(record) == 1 and record[0].row_key == f"C.{2**63 - 1 - batch.newest_ms}"


def test_log_lines_to_sessions_and_metrics(spark, tmp_path):
    line = '{} - - [01/Jan/2024 00:{:02d}:{:02d} +0000] "GET / HTTP/1.1" 200 11179 "-" "a"'.format
    lines = text_stream(
        spark, tmp_path / "in",
        [line("1.1.1.1", 0, 0), line("1.1.1.1", 0, 20), "broken"], [line("1.1.1.1", 1, 0), line("2.2.2.2", 1, 5)],
    )
    parsed = parse_weblog(lines).where("log_time is not null and key is not null")
    # extending on less than 30 s means at most 29 s at whole seconds
    got = run_sessions(parsed.withColumn("t", F.col("log_time")), "1 minute", "29 seconds").all_sessions()
    as_of = F.lit(int((T0 - datetime.datetime(1970, 1, 1)).total_seconds() * 1000) + 70_000)
    in_ms = got.select(F.unix_millis("session_start").alias("start_ms"), F.unix_millis("session_end").alias("end_ms"), "events")
    metrics = dict(rows(batch_sessions.session_metrics(in_ms, as_of)))
    assert metrics["TOTAL_SESSION_COUNTS"] == 2 and metrics["EVENT_COUNTS"] == 4
    assert metrics["NEW_SESSION_COUNTS"] == 2 - 0 and metrics["TOTAL_SESSION_TIME"] == 0
