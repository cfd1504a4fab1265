"""Streaming queries: each processes a whole table as a stream and reads the result table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.parse import parse_messages
from ..operators.sessions import LARGEST_LONG, METRICS
from ..sources.sinks import PartitionSink, read_partitions
from ..sources.streams import parquet_table, replay
from ..storage import new_path
from ..streaming import counts, windows
from ..streaming.sessions import SessionStream, session_lines
from ..streaming.tables import ResultTable
from .batch import HOUR, SESSIONS
from .batch import ORACLES as BATCH_SQL
from .tables import log_line, message_lines, table, text_lines

QUERIES = {}
ORACLES = {}


def query(sql: str):
    def register(fn):
        QUERIES[fn.__name__] = fn
        ORACLES[fn.__name__] = sql
        return fn

    return register


def _stream(spark, sf_dir, name):
    return parquet_table(spark, f"{sf_dir}/{name}.parquet", table(spark, sf_dir, name).schema)


def _words_sql(source: str, line: str) -> str:
    return f"""select word, count(*) as n from (
  select unnest(string_split(rtrim({line}, ' '), ' ')) as word
  from (select unnest(string_split(text, chr(10))) as line from {source})
  where line = '' or trim(line, ' ') <> '') group by 1"""


@query(_words_sql("documents", "lower(line)"))
def stream_word_count(spark, sf_dir):
    lines = text_lines(_stream(spark, sf_dir, "documents"))
    return ResultTable(counts.word_counts(lines), "complete").run()


@query(_words_sql("documents", "line"))
def stream_word_count_cased(spark, sf_dir):
    lines = text_lines(_stream(spark, sf_dir, "documents"))
    return ResultTable(counts.word_counts(lines, lower=False), "update", keys=["word"]).run()


@query(f"select cast(0 as integer) as batch_id, word, n from ({_words_sql('conversations', 'lower(line)')})")
def stream_batch_word_count(spark, sf_dir):
    return counts.batch_word_counts(text_lines(_stream(spark, sf_dir, "conversations"))).run()


@query(_words_sql("conversations", "lower(line)"))
def stream_word_count_state(spark, sf_dir):
    lines = text_lines(_stream(spark, sf_dir, "conversations"))
    return ResultTable(counts.word_counts_by_state(lines), "update", keys=["word"]).run()


@query("""select event_type as ticker, user_id as "destUser",
  sum(value::decimal(28, 9))::double as total_price, sum(value::decimal(28, 9))::double / count(value) as avg_price from events group by 1, 2""")
def stream_ticker_agg(spark, sf_dir):
    messages = _stream(spark, sf_dir, "events").select(
        F.col("event_type").alias("ticker"), F.col("user_id").alias("destUser"), F.col("value").alias("price")
    )
    return ResultTable(counts.ticker_sums(messages), "complete").run()


@query("""select 'event_type' as kind, event_type as key, count(*) as n from events group by 2
  union all select 'user_id', cast(user_id as varchar), count(*) from events group by 2""")
def stream_entity_counts(spark, sf_dir):
    prefix = f"counts_{uuid.uuid4().hex}"
    tables = counts.entity_counts(_stream(spark, sf_dir, "events"), ["event_type", "user_id"], prefix)
    for query_ in [t.start() for t in tables.values()]:
        query_.awaitTermination()
    parts = [
        f"SELECT '{key}' AS kind, CAST({key} AS STRING) AS key, n FROM {t.name}" for key, t in tables.items()
    ]
    return spark.sql(" UNION ALL ".join(parts))


@query("""select w as window_start, w + interval 1 hour as window_end, event_type as ticker,
  max(ts) as max_time, sum(value::decimal(28, 9))::double as total_price, sum(value::decimal(28, 9))::double / count(value) as avg_price, count(*) as trades
from (select *, unnest([time_bucket(interval 10 minute, ts) - i * interval 10 minute for i in range(0, 6)]) as w from events)
group by 1, 2, 3""")
def stream_window_agg(spark, sf_dir):
    trades = _stream(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("time"), F.col("event_type").alias("ticker"), F.col("value").alias("price")
    )
    report = windows.window_trades(trades, "time", window="1 hour", slide="10 minutes", watermark="30 minutes")
    out = ResultTable(report, "update", keys=["window_start", "window_end", "ticker"]).run()
    zoneless = {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end", "max_time")}
    return out.withColumns(zoneless)


@query("""select event_id, upper(concat_ws(',', user_id, user_id + 1, event_type,
  cast(cast(cast(value as decimal(18, 2)) as double) as varchar), event_id)) as value
  from events where event_type not in ('error', 'signup')""")
def stream_enrich(spark, sf_dir):
    lines = message_lines(_stream(spark, sf_dir, "events"))
    out = ResultTable(windows.enrich(lines, keep=("event_id",)), "append").run()
    return out.select("event_id", "value")


@query("""select event_id, upper(concat_ws(',', user_id, user_id + 1, event_type,
  cast(cast(cast(value as decimal(18, 2)) as double) as varchar), event_id)) as value
  from events where event_type not in ('error', 'signup')""")
def stream_enrich_partitions(spark, sf_dir):
    """The same rows, written by every task through a connection of its own."""
    rows = windows.enrich(message_lines(_stream(spark, sf_dir, "events")), keep=("event_id",))
    path = new_path(spark, "partitions")
    spark.dataSource.register(PartitionSink)
    query_ = rows.writeStream.format(PartitionSink.name()).option("path", path).option("checkpointLocation", new_path(spark, "stream-state"))
    query_.trigger(availableNow=True).start().awaitTermination()
    return read_partitions(spark, path, rows.schema)


@query(f"with {SESSIONS} select user_id, session_start, session_end, events from s")
def stream_log_sessions(spark, sf_dir):
    """Closed sessions and those still open."""
    events = _stream(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("time"))
    stream = SessionStream(events, "user_id", "time", "6 hours", "1 hour")
    stream.run()
    zoneless = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("session_start", "session_end")]
    return stream.all_sessions().select("user_id", *zoneless, "events")


@query("""select event_type as ticker, cast(user_id + 1 as varchar) as "destUser", sum(price::decimal(28, 9))::double as total_price,
  sum(price::decimal(28, 9))::double / count(price) as avg_price from (select *, cast(cast(value as decimal(18, 2)) as double) as price from events
  where event_type not in ('error', 'signup')) group by 1, 2""")
def stream_ticker_messages(spark, sf_dir):
    messages = parse_messages(message_lines(_stream(spark, sf_dir, "events")))
    return ResultTable(counts.ticker_sums(messages), "complete").run()


@query("""select w as window_start, w + interval 30 second as window_end, event_type as ticker, max(t) as max_time,
  sum(price::decimal(28, 9))::double as total_price, sum(price::decimal(28, 9))::double / count(price) as avg_price, count(*) as trades
from (select *, unnest([time_bucket(interval 5 second, t) - i * interval 5 second for i in range(0, 6)]) as w
  from (select event_type, cast(cast(value as decimal(18, 2)) as double) as price, date_trunc('second', ts) as t
    from events where event_type not in ('error', 'signup'))) group by 1, 2, 3""")
def stream_ingest_window(spark, sf_dir):
    """Messages are timed by their receipt; here that is the event's time, as the table has no other."""
    lines = message_lines(_stream(spark, sf_dir, "events")).withColumn("timestamp", F.col("ts").cast("timestamp"))
    report = windows.ingest_window_trades(lines, "timestamp", watermark="3650 days")
    out = ResultTable(report, "update", keys=["window_start", "window_end", "ticker"]).run()
    zoneless = {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end", "max_time")}
    return out.withColumns(zoneless)


# ---------------------------------------------------------------- streams that come in parts

# A part is a third of the month; every seventh event comes with the part after its own.
PARTS = 4
_PART = "cast(floor((day(ts) - 1) / 10) as int) + cast(event_id % 7 = 0 as int)"
_PARTS_SQL = """parts as (select *, (day(ts) - 1) // 10 + (event_id % 7 = 0)::int as part from events),
batches as (select p from range(4) t(p) where exists (select 1 from parts where part = p)),
newest as (select p, (select max(ts) from parts where part <= p) as ts from batches)"""


def _in_parts(spark, sf_dir, rows):
    """A stream that the parts of a table come to, and the giver of the parts."""
    folder = new_path(spark, "parts")
    rows.limit(0).write.parquet(folder)
    return spark.readStream.schema(rows.schema).parquet(folder), replay(rows, F.col("part"), PARTS, folder)


def _timed(spark, sf_dir, *more):
    rows = table(spark, sf_dir, "events").withColumn("part", F.expr(_PART))
    return rows.select("event_id", "user_id", F.col("ts").cast("timestamp").alias("time"), "part", *more)


def _by_batch(spark, sf_dir, result):
    """What a function of (session stream, batch) gives for every batch, with the number of its part."""
    events, parts = _in_parts(spark, sf_dir, _timed(spark, sf_dir))
    stream, out = SessionStream(events, "user_id", "time", "6 hours", "20 days", arrival=F.col("part")), None
    for _ in parts:
        for batch in stream.run():
            one = result(stream, batch).withColumn("part", F.lit(batch.arrival))
            out = one if out is None else out.unionByName(one)
    return out


_LIMITS = {"timeout": 6 * HOUR, "slack": HOUR, "short": HOUR, "long": 10 * HOUR}
_BY_BATCH_SQL = f"""with {_PARTS_SQL},
g as (select p, n.ts as now, e.*, case when e.ts <= lag(e.ts) over w + interval 6 hour then 0 else 1 end f
  from newest n join parts e on e.part <= n.p window w as (partition by p, user_id order by e.ts, event_id)),
h as (select *, sum(f) over (partition by p, user_id order by ts, event_id) as sid from g),
m as (select p, epoch_us(min(now)) // 1000 as now, epoch_us(min(ts)) // 1000 as st, epoch_us(max(ts)) // 1000 as en, count(*) as events,
    count(*) filter (part = p) as fresh, min(part) = p as is_new from h group by p, user_id, sid),
x as (select *, now - en as idle, en - st as len, now - en < {6 * HOUR} as active from m),
w as (select p, min(now) as now, coalesce(sum(len) filter (active), 0)::bigint as TOTAL_SESSION_TIME,
  count(*) filter (active and len < {HOUR}) as UNDER_A_MINUTE_COUNT,
  count(*) filter (active and len >= {HOUR} and len < {10 * HOUR}) as ONE_TO_TEN_MINUTE_COUNT,
  count(*) filter (active and len >= {10 * HOUR}) as OVER_TEN_MINUTES_COUNT,
  count(*) filter (active and idle < {HOUR} and is_new) as NEW_SESSION_COUNTS,
  count(*) filter (active) as TOTAL_SESSION_COUNTS, coalesce(sum(events) filter (active), 0)::bigint as TOTAL_SESSION_EVENT_COUNTS,
  sum(fresh)::bigint as EVENT_COUNTS, count(*) filter (idle > {6 * HOUR} and idle < {7 * HOUR}) as DEAD_SESSION_COUNTS
  from x group by p)"""


@query(_BY_BATCH_SQL + f" select p::int as part, metric, value from (unpivot (select * exclude (now) from w) on {', '.join(METRICS)} into name metric value value)")
def stream_session_metrics(spark, sf_dir):
    """All metrics after every micro-batch, over all sessions in state."""
    return _by_batch(spark, sf_dir, lambda stream, batch: stream.metrics(batch, **_LIMITS))


@query(_BY_BATCH_SQL + f" select p::int as part, 'C.' || ({LARGEST_LONG} - now) as row_key, {', '.join(METRICS)} from w")
def stream_metric_records(spark, sf_dir):
    """A wide record of the metrics for every micro-batch, the newest first by its key."""
    return _by_batch(spark, sf_dir, lambda stream, batch: stream.record(batch, **_LIMITS))


def _closed(rows, key):
    """``rows``, and in a part after the last one a row of no key, late enough for all others to be settled."""
    last = rows.agg(F.max("time").alias("time")).select((F.col("time") + F.expr("INTERVAL 30 DAYS")).alias("time"))
    others = {f.name: F.lit(None).cast(f.dataType) for f in rows.schema.fields if f.name not in ("time", "part")}
    end = last.withColumns({**others, "part": F.lit(PARTS - 1)})
    return rows.unionByName(end.select(rows.columns))


@query(f"select value from ({BATCH_SQL['sessionized_events']})")
def stream_session_text(spark, sf_dir):
    """Each event with the start of its session, which goes on from batch to batch."""
    # the last part has the end mark too; its own events are out of order by then, but not late
    rows = _closed(_timed(spark, sf_dir, log_line().alias("line")), "user_id")
    events, parts = _in_parts(spark, sf_dir, rows)
    lines = session_lines(events, "user_id", "time", F.col("line"), 6 * 3600, "20 days")
    out = ResultTable(lines, "append")
    for _ in parts:
        out.run()
    return out.read().select("value")


@query(f"""with {_PARTS_SQL},
rows as (select e.*, time_bucket(interval 12 hour, e.ts) as w from parts e),
kept as (select r.* from rows r left join newest n on n.p = r.part - 1
  where n.ts is null or r.w + interval 12 hour > date_trunc('millisecond', n.ts) - interval 5 day)
select w as window_start, w + interval 12 hour as window_end, event_type as ticker, max(ts) as max_time,
  sum(value::decimal(28, 9))::double as total_price, sum(value::decimal(28, 9))::double / count(value) as avg_price, count(*) as trades from kept group by 1, 2, 3""")
def stream_late_window(spark, sf_dir):
    """Windows over parts with late rows: those whose window the watermark has passed are dropped."""
    events, parts = _in_parts(spark, sf_dir, _timed(spark, sf_dir, F.col("event_type").alias("ticker"), F.col("value").alias("price")))
    report = windows.window_trades(events, "time", window="12 hours", slide="12 hours", watermark="5 days")
    out = ResultTable(report, "update", keys=["window_start", "window_end", "ticker"])
    for _ in parts:
        out.run()
    zoneless = {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end", "max_time")}
    return out.read().withColumns(zoneless)
