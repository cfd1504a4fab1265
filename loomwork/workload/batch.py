"""Batch queries on the test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import features, parse
from ..operators import joins, nested, pairs, partition, rates, sessions, setops, timeseries
from ..storage import new_path
from .tables import (
    LOG_LINES_SQL,
    NESTED_SQL,
    log_line,
    message_lines,
    nested_documents,
    table,
    text_lines,
)

QUERIES = {}
ORACLES = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


# ---------------------------------------------------------------- rates

RATE = "cast(sum(cast({flag} as int)) as bigint) as n_true, count(*) as n_total, sum(cast({flag} as int)) / count(*)::double as rate"


def _rate_sql(tbl: str, flag: str, key: str, name: str) -> str:
    return f"select {key} as {name}, {RATE.format(flag=flag)} from {tbl} group by 1"


@query(_rate_sql("orders", "o_orderstatus = 'F'", "o_orderpriority", "o_orderpriority"))
def rate_by_key(spark, sf_dir):
    df = table(spark, sf_dir, "orders")
    return rates.rate_by(df, F.col("o_orderstatus") == "F", F.col("o_orderpriority"), "o_orderpriority")


@query(_rate_sql("part", "p_size > 25", "substr(p_type, 1, 1)", "letter"))
def rate_by_prefix(spark, sf_dir):
    df = table(spark, sf_dir, "part")
    return rates.rate_by(df, F.col("p_size") > 25, rates.first_letter(F.col("p_type")), "letter", True)


@query(_rate_sql("customer", "c_acctbal > 0", "round(cast(trunc(c_acctbal) as int) / 10) + 0.0", "bucket"))
def rate_by_int_bucket(spark, sf_dir):
    df = table(spark, sf_dir, "customer")
    return rates.rate_by(df, F.col("c_acctbal") > 0, rates.int_bucket(F.col("c_acctbal")), "bucket", True)


@query(_rate_sql("part", "p_size > 25", "round(p_retailprice / 10) + 0.0", "bucket"))
def rate_by_double_bucket(spark, sf_dir):
    df = table(spark, sf_dir, "part")
    return rates.rate_by(df, F.col("p_size") > 25, rates.double_bucket(F.col("p_retailprice")), "bucket", True)


@query(_rate_sql("part", "p_retailprice > 1500", "p_size", "p_size"))
def rate_by_key_int(spark, sf_dir):
    df = table(spark, sf_dir, "part")
    return rates.rate_by(df, F.col("p_retailprice") > 1500, F.col("p_size"), "p_size", True)


@query(_rate_sql("customer", "c_acctbal > 5000", "c_mktsegment", "c_mktsegment"))
def rate_by_key_ordered(spark, sf_dir):
    df = table(spark, sf_dir, "customer")
    return rates.rate_by(df, F.col("c_acctbal") > 5000, F.col("c_mktsegment"), "c_mktsegment", True)


@query("select cast(sum(cast(o_orderstatus = 'F' as int)) as bigint) as n_true, count(*) as n_total from orders")
def rate_global(spark, sf_dir):
    return rates.rate_total(table(spark, sf_dir, "orders"), F.col("o_orderstatus") == "F")


# ---------------------------------------------------------------- time series

USER = ["user_id"]
ORDER = ["ts", "event_id"]
NEIGHBOURS = """select user_id, event_id, value as v_now,
  lead(value) over w as v_after, lag(value) over w as v_before
  from events window w as (partition by user_id order by ts, event_id)"""


def _events(spark, sf_dir, *more):
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value", *more)


@query(NEIGHBOURS)
def lead_lag(spark, sf_dir):
    out = timeseries.lead_lag(_events(spark, sf_dir), USER, ORDER, "value")
    return out.select("user_id", "event_id", F.col("value").alias("v_now"), "v_after", "v_before")


# by the signs of the steps to and from a row: up then down, or down then up
@query(f"""select *, case sign(v_now - v_before)::int * 3 + sign(v_after - v_now)::int
  when 2 then 'peak' when -2 then 'valley' else 'n/a' end as turn from ({NEIGHBOURS})""")
def peak_valley(spark, sf_dir):
    out = timeseries.peak_valley(_events(spark, sf_dir), USER, ORDER, "value")
    return out.select("user_id", "event_id", F.col("value").alias("v_now"), "v_after", "v_before", "turn")


def _sliding_sql(source: str) -> str:
    return f"""select event_id, user_id, event_type, value as v_now,
  round(avg(value) over w, 6) as v_moving_avg, min(value) over w as v_moving_min,
  max(value) over w as v_moving_max
  from {source} window w as (order by ts, event_id rows between 3 preceding and current row)"""


def _sliding_columns(df):
    return df.select(
        "event_id", "user_id", "event_type", F.col("value").alias("v_now"),
        F.round("v_moving_avg", 6).alias("v_moving_avg"), "v_moving_min", "v_moving_max",
    )


@query(_sliding_sql("events"))
def sliding_stats_global(spark, sf_dir):
    return _sliding_columns(timeseries.sliding_stats(_events(spark, sf_dir, "event_type"), ORDER, "value"))


@query(_sliding_sql("(select * from events where event_type = 'error')"))
def sliding_stats_filtered(spark, sf_dir):
    errors = _events(spark, sf_dir, "event_type").where(F.col("event_type") == "error")
    return _sliding_columns(timeseries.sliding_stats(errors, ORDER, "value"))


@query(f"select * from ({_sliding_sql('events')}) where event_type = 'error'")
def sliding_stats_at_events(spark, sf_dir):
    return sliding_stats_global(spark, sf_dir).where(F.col("event_type") == "error")


TUMBLING = "round(avg(value), 6) as v_avg, max(value) as v_max, min(value) as v_min from events group by 1, 2"


@query(f"select event_type, round(floor(epoch(ts)) / 10800.0) as bucket, {TUMBLING}")
def tumbling_stats(spark, sf_dir):
    bucket = timeseries.centred_bucket(F.unix_timestamp("ts"), 10800)
    out = timeseries.tumbling_stats(_events(spark, sf_dir, "event_type"), "event_type", bucket, "value")
    return out.withColumn("v_avg", F.round("v_avg", 6))


@query(f"select event_type, time_bucket(interval 1 hour, ts) as bucket, {TUMBLING}")
def tumbling_stats_aligned(spark, sf_dir):
    bucket = timeseries.aligned_bucket(F.col("ts"), "1 hour")
    out = timeseries.tumbling_stats(_events(spark, sf_dir, "event_type"), "event_type", bucket, "value")
    return out.withColumn("v_avg", F.round("v_avg", 6)).withColumn("bucket", F.col("bucket").cast("timestamp_ntz"))


@query("""select user_id, event_id, value, value - lag(value, 1, 0) over
  (partition by user_id order by ts, event_id) as dif from events""")
def diff_by_group(spark, sf_dir):
    out = timeseries.diff_to_previous(_events(spark, sf_dir), ORDER, "value", USER)
    return out.select("user_id", "event_id", "value", "dif")


@query("""select event_id, value, value - lag(value, 1, 0) over (order by ts, event_id) as dif from events""")
def diff_global_paged(spark, sf_dir):
    return timeseries.diff_to_previous(_events(spark, sf_dir), ORDER, "value").select("event_id", "value", "dif")


# ---------------------------------------------------------------- sessions

GAP = "INTERVAL '6' HOUR"
SESSIONS = """
g as (select *, case when ts <= lag(ts) over w + interval 6 hour then 0 else 1 end f
  from events window w as (partition by user_id order by ts, event_id)),
h as (select *, sum(f) over (partition by user_id order by ts, event_id) sid from g),
s as (select user_id, sid, min(ts) as session_start, max(ts) as session_end, count(*) as events
  from h group by user_id, sid)
"""
HOUR = 3_600_000


def _sessions(spark, sf_dir):
    return sessions.sessions(_events(spark, sf_dir), USER, ORDER, F.expr(GAP))


@query(f"""with {SESSIONS} select user_id, session_start, session_end,
  date_sub('second', session_start, session_end) as length_s, events from s""")
def sessions_batch(spark, sf_dir):
    seconds = F.timestamp_diff("SECOND", "session_start", "session_end").alias("length_s")
    return _sessions(spark, sf_dir).select("user_id", "session_start", "session_end", seconds, "events")


@query("""select user_id, min(ts) as first_start, max(ts) as last_end, count(*) as events
  from events group by 1""")
def key_span(spark, sf_dir):
    return sessions.key_span(_events(spark, sf_dir), "user_id", "ts", "ts", F.lit(1))


METRICS_SQL = f"""with {SESSIONS},
m as (select epoch_us(session_start) // 1000 as st, epoch_us(session_end) // 1000 as en, events,
  (select epoch_us(max(ts)) // 1000 from events) as now from s),
i as (select *, now - en as idle, en - st as len, now - en < 6 * {HOUR} as active from m),
w as (select
  coalesce(sum(len) filter (active), 0) as TOTAL_SESSION_TIME,
  count(*) filter (active and len < {HOUR}) as UNDER_A_MINUTE_COUNT,
  count(*) filter (active and len >= {HOUR} and len < 10 * {HOUR}) as ONE_TO_TEN_MINUTE_COUNT,
  count(*) filter (active and len >= 10 * {HOUR}) as OVER_TEN_MINUTES_COUNT,
  count(*) filter (active and idle < {HOUR} and now - st < {HOUR}) as NEW_SESSION_COUNTS,
  count(*) filter (active) as TOTAL_SESSION_COUNTS,
  coalesce(sum(events) filter (active), 0) as TOTAL_SESSION_EVENT_COUNTS,
  sum(events) as EVENT_COUNTS,
  count(*) filter (idle > 6 * {HOUR} and idle < 7 * {HOUR}) as DEAD_SESSION_COUNTS from i)
"""


def _metrics(spark, sf_dir):
    as_of = table(spark, sf_dir, "events").agg(F.unix_millis(F.max("ts").cast("timestamp"))).scalar()
    in_ms = _sessions(spark, sf_dir).select(
        F.unix_millis(F.col("session_start").cast("timestamp")).alias("start_ms"),
        F.unix_millis(F.col("session_end").cast("timestamp")).alias("end_ms"),
        "events",
    )
    rows = sessions.session_metrics(
        in_ms, as_of, timeout=6 * HOUR, slack=HOUR, short=HOUR, long=10 * HOUR
    )
    return rows, as_of


@query(METRICS_SQL + " select metric, cast(value as bigint) as value from (unpivot w on columns(*) into name metric value value)")
def session_metrics(spark, sf_dir):
    return _metrics(spark, sf_dir)[0]


@query(METRICS_SQL + f""" select 'C.' || ({sessions.LARGEST_LONG} - (select epoch_us(max(ts)) // 1000 from events)) as row_key,
  """ + ", ".join(f"cast({m} as bigint) as {m}" for m in sessions.METRICS) + " from w")
def session_metric_record(spark, sf_dir):
    return sessions.metric_record(*_metrics(spark, sf_dir))


@query(f"""with {SESSIONS}, {LOG_LINES_SQL}
select h.event_id, strftime(s.session_start, '%d/%b/%Y %H:%M:%S +0000') || chr(9) || log.value as value
  from h join s using (user_id, sid) join log using (event_id)""")
def sessionized_events(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", log_line().alias("line"))
    out = sessions.session_lines(rows, USER, ORDER, F.expr(GAP), F.col("line"))
    return out.select("event_id", "value")


# ---------------------------------------------------------------- joins, pairs, placement


@query("""select s_nationkey, count(*) as n, cast(sum(cast(l_quantity as bigint)) as bigint) as quantity
  from lineitem join supplier on l_suppkey = s_suppkey group by 1""")
def plain_join(spark, sf_dir):
    return _by_nation(joins.plain_join(*_join_inputs(spark, sf_dir), "suppkey"))


@query(ORACLES["plain_join"])
def salted_join(spark, sf_dir):
    joined = joins.salted_join(
        *_join_inputs(spark, sf_dir), "suppkey", row_id=["l_orderkey", "l_linenumber", "l_partkey"]
    )
    return _by_nation(joined)


def _join_inputs(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("suppkey"), "s_nationkey")
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("suppkey"), "l_orderkey", "l_linenumber", "l_partkey", "l_quantity"
    )
    return supplier, items


def _by_nation(joined):
    return joined.groupBy("s_nationkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("quantity")
    )


PAIRS = """i as (select l_orderkey as k, l_partkey as x, count(*) as c from lineitem group by 1, 2),
p as (select l.x as a, r.x as b, cast(sum(l.c * r.c) as bigint) as n
  from i l join i r on l.k = r.k and l.x < r.x group by 1, 2)"""


@query(f"with {PAIRS} select a, b, n from p")
def pair_counts(spark, sf_dir):
    return pairs.pair_counts(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey")


SEGMENTS = 4


@query(f"""with {PAIRS}, r as (select a, (('0x' || md5(b::varchar)[1:8])::bigint % {SEGMENTS})::int as segment,
  string_agg(b || ':' || n, ',' order by b) as partners from p group by 1, 2)
select x as a, coalesce(segment, 0) as segment, coalesce(partners, '') as partners
from (select distinct x from i) left join r on x = a""")
def pair_counts_nested(spark, sf_dir):
    out = pairs.pair_counts_nested(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey", segments=SEGMENTS)
    entry = lambda e: F.concat(e["key"].cast("string"), F.lit(":"), e["value"].cast("string"))
    entries = F.transform(F.array_sort(F.map_entries("partners")), entry)
    return out.select("a", "segment", F.array_join(entries, ",").alias("partners"))


DAY = "cast(date_diff('day', date '1970-01-01', cast(ts as date)) as integer)"


def _day():
    return F.unix_date(F.col("ts").cast("date"))


@query(f"""select user_id, {DAY} as day, cast(sum(cast(value as decimal(18, 2))) as double) as total
  from events group by 1, 2""")
def sum_by_group_time(spark, sf_dir):
    rows = _events(spark, sf_dir).select("user_id", _day().alias("day"), F.col("value").cast("decimal(18,2)").alias("value"))
    out = partition.sum_by(rows, ["user_id", "day"], F.col("value"), "total", partitions=100)
    return out.withColumn("total", F.col("total").cast("double"))


def _shuffle_partitions(spark):
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@query("select event_id, user_id, value from events")
def partition_sorted(spark, sf_dir):
    out = partition.partition_sorted(_events(spark, sf_dir), _shuffle_partitions(spark), USER, ORDER)
    return out.select("event_id", "user_id", "value")


@query("select event_id, event_type, value from events")
def skew_partition(spark, sf_dir):
    events = _events(spark, sf_dir, "event_type")
    out = partition.skew_partition(events, _shuffle_partitions(spark), "event_type", ["event_id"])
    return out.select("event_id", "event_type", "value")


@query("""select event_id, user_id, ts, value from events order by ts, event_id limit 10""")
def top_rows(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", "user_id", "ts", "value").orderBy("ts", "event_id").limit(10)


# ---------------------------------------------------------------- sets and adjacent duplicates


@query("""select line, cast(sum(sign) as bigint) as net from (
  select unnest(string_split(text, chr(10))) as line, 1 as sign from documents
  union all select unnest(string_split(text, chr(10))), -1 from conversations)
group by 1 having sum(sign) <> 0""")
def multiset_diff(spark, sf_dir):
    left, right = (text_lines(table(spark, sf_dir, t)) for t in ("documents", "conversations"))
    return setops.multiset_diff(left, right, ["value"]).withColumnRenamed("value", "line")


def _typed_days(spark, sf_dir):
    return _events(spark, sf_dir, "event_type").select("event_id", "ts", "event_type", _day().alias("page"))


@query(f"select {DAY} as page, arg_min(event_type, (ts, event_id)) as first from events group by 1")
def page_firsts(spark, sf_dir):
    return setops.page_firsts(_typed_days(spark, sf_dir), "page", ORDER, "event_type")


@query(f"""select event_id, event_type, page from (select *, lag(event_type) over
  (partition by page order by ts, event_id) as prev from (select *, {DAY} as page from events))
where prev is distinct from event_type""")
def dedup_adjacent_in_page(spark, sf_dir):
    out = setops.dedup_adjacent(_typed_days(spark, sf_dir), ORDER, "event_type", page="page")
    return out.select("event_id", "event_type", "page")


@query("""select event_id, event_type from (select *, lag(event_type) over (order by ts, event_id) as prev
  from events) where prev is distinct from event_type""")
def dedup_adjacent_global(spark, sf_dir):
    return setops.dedup_adjacent(_typed_days(spark, sf_dir), ORDER, "event_type").select("event_id", "event_type")


# ---------------------------------------------------------------- nested data


@query(f"with {NESTED_SQL} select doc_id, line_no, n_chars from el")
def nested_explode(spark, sf_dir):
    docs = nested_documents(table(spark, sf_dir, "documents"))
    return nested.explode_structs_sql(docs, "nested_documents", ["doc_id"], "nested")


@query(f"""with {NESTED_SQL}
select doc_id, 'doc_id' as path, 'bigint' as type, cast(doc_id as varchar) as value from documents
union all select doc_id, 'lang', 'string', lang from documents
union all select doc_id, 'nested.line_no', 'int', cast(line_no as varchar) from el
union all select doc_id, 'nested.n_chars', 'int', cast(n_chars as varchar) from el""")
def nested_flatten(spark, sf_dir):
    return nested.flatten_rows(nested_documents(table(spark, sf_dir, "documents")), ["doc_id"])


@query(f"with {NESTED_SQL} select doc_id, lang, line_no, n_chars from el")
def nested_roundtrip(spark, sf_dir):
    name = f"nested_{uuid.uuid4().hex}"
    ddl = "doc_id bigint, lang string, nested array<struct<line_no:int,n_chars:int>>"
    schema = nested.create_table_if_absent(spark, f"{name}_empty", ddl, new_path(spark, "tables"))
    rows = nested_documents(table(spark, sf_dir, "documents")).to(schema)
    saved = nested.save_table(rows, name, new_path(spark, "tables"), files=_shuffle_partitions(spark))
    return nested.explode_structs(saved, ["doc_id", "lang"], "nested")


# ---------------------------------------------------------------- parsing and features


@query(f"""with {LOG_LINES_SQL}
select event_id, case when instr(value, ' ') > 0 then split_part(value, ' ', 1) end as key,
  try_strptime(regexp_extract(value, '^[^\\[\\]]*\\[([^\\]]*)\\]', 1), '%d/%b/%Y %H:%M:%S +0000') as log_time from log""")
def weblog_parse(spark, sf_dir):
    lines = table(spark, sf_dir, "events").select("event_id", log_line().alias("value"))
    out = parse.parse_weblog(lines)
    return out.select("event_id", "key", F.col("log_time").cast("timestamp_ntz").alias("log_time"))


@query("""select event_id, cast(user_id as varchar) as srcUser, cast(user_id + 1 as varchar) as destUser,
  event_type as ticker, cast(cast(value as decimal(18, 2)) as double) as price, event_id as tradeTs
  from events where event_type not in ('error', 'signup')""")
def message_parse(spark, sf_dir):
    out = parse.parse_messages(message_lines(table(spark, sf_dir, "events")))
    return out.select("event_id", *parse.MESSAGE_FIELDS)


@query("""select count(*) filter (event_type not in ('error', 'signup')) as accepted,
  count(*) filter (event_type in ('error', 'signup')) as rejected from events""")
def message_rejects(spark, sf_dir):
    return parse.message_counts(message_lines(table(spark, sf_dir, "events")))


PASSENGERS_SQL = """select c_custkey,
  case when c_nationkey % 2 = 0 then 'male' else 'female' end as sex,
  case when c_acctbal >= 0 then c_acctbal / 100 end as age,
  c_nationkey % 4 as sibSp, c_nationkey % 3 as parch,
  case when c_acctbal >= 2000 then c_mktsegment when c_acctbal >= 0 then substr(c_mktsegment, 1, 1) || '1 ' || c_nationkey end as cabin,
  case when c_nationkey % 5 = 0 then 'Q' when c_nationkey % 5 < 3 then 'S' when c_nationkey % 5 = 3 then 'C' end as embarked,
  c_nationkey % 3 + 1 as pclass, c_acctbal as fare from {source}"""


@query("with p as (" + PASSENGERS_SQL.format(source="customer") + """) select c_custkey,
  case when sex = 'male' then 1.0::double else 0.0::double end as "isMan", coalesce(age, 45.0) as age,
  cast(age is null as int)::double as "noAge", cast(sibSp > 0 as int)::double as "hasHelper",
  cast(parch > 0 as int)::double as "hasDependent", parch::double as "dependentCount",
  cast(sibSp + parch > 0 as int)::double as "hasFamily", cast(cabin is null as int)::double as "inUnknownCabin",
  """ + ", ".join(
    f"""coalesce(cast(contains(cabin, '{text}') as int), 0)::double as "{name}" """
    for name, text in [("moreThanOneCabin", " "), *[(f"isCabin{c}", c) for c in features.CABIN_LETTERS]]
) + ", " + ", ".join(
    f"""coalesce(cast(embarked = '{c}' as int), 0)::double as "isEmbark{c}" """ for c in features.PORTS
) + """, pclass::double as "pClass", fare from p""")
def ml_features_passenger(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    return features.passenger_features(spark.sql(PASSENGERS_SQL.format(source="{source}"), source=customers))


WEATHER_SQL = """select o_orderkey,
  case o_orderstatus when 'O' then 'sunny' when 'F' then 'rainy' else 'overcast' end as outlook,
  40 + 4 * month(o_orderdate) as temp,
  case when month(o_orderdate) < 5 then 'cool' when month(o_orderdate) < 9 then 'mild' else 'hot' end as "tempEnum",
  50 + day(o_orderdate) as humidity,
  case when day(o_orderdate) < 16 then 'normal' else 'high' end as "humidityEnum",
  case when o_orderpriority < '3' then 'TRUE' else 'FALSE' end as "windyFlag",
  case when o_totalprice > 200000 then 'yes' else 'no' end as "playFlag" from {source}"""


@query("with d as (" + WEATHER_SQL.format(source="orders") + """) select o_orderkey,
  """ + ", ".join(f"cast(outlook = '{v}' as int)::double as outlook_{v}" for v in features.OUTLOOKS)
  + ", temp::double as temp, "
  + ", ".join(f"""cast("tempEnum" = '{v}' as int)::double as temp_{v}""" for v in features.TEMPERATURES) + ", "
  + ", ".join(f"""cast("humidityEnum" = '{v}' as int)::double as humidity_{v}""" for v in features.HUMIDITIES)
  + """, cast("windyFlag" = 'TRUE' as int)::double as windy, cast("playFlag" = 'yes' as int)::double as label from d""")
def ml_features_weather(spark, sf_dir):
    sql = WEATHER_SQL.format(source="{source}").replace('"', "`")
    return features.weather_features(spark.sql(sql, source=table(spark, sf_dir, "orders")))
