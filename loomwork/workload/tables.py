"""The test tables, and inputs Spark derives from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table.  Its zoneless times are read as UTC throughout."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def log_line() -> Column:
    """A web log line for an event; cheap errors, signups and views give malformed ones."""
    head = F.concat(F.lit("66.249."), F.col("user_id").cast("string"), F.lit(".1 - - "))
    time = F.date_format(F.col("ts").cast("timestamp"), "dd/MMM/yyyy HH:mm:ss Z")
    tail = F.concat(
        F.lit(' "GET /'), F.col("event_type"), F.lit(' HTTP/1.1" 200 11179 "-" "agent"')
    )
    cheap = F.col("value") < 5
    return (
        F.when(cheap & (F.col("event_type") == "error"), F.concat(head, tail))
        .when(cheap & (F.col("event_type") == "signup"), F.concat(head, F.lit("[yesterday]"), tail))
        .when(cheap & (F.col("event_type") == "view"), F.lit("broken"))
        .otherwise(F.concat(head, F.lit("["), time, F.lit("]"), tail))
    )


LOG_LINES_SQL = """
lines as (select event_id, ts, '66.249.' || user_id || '.1 - - ' as head,
    strftime(ts, '%d/%b/%Y %H:%M:%S +0000') as log_text,
    ' "GET /' || event_type || ' HTTP/1.1" 200 11179 "-" "agent"' as tail, value < 5 as cheap, event_type
  from events),
log as (select event_id, ts, case when cheap and event_type = 'error' then head || tail
    when cheap and event_type = 'signup' then head || '[yesterday]' || tail
    when cheap and event_type = 'view' then 'broken'
    else head || '[' || log_text || ']' || tail end as value from lines)
"""


def message_lines(events: DataFrame) -> DataFrame:
    """A message per event: errors miss a field, signups have no price, views a trailing comma."""
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    price = F.when(kind == "signup", "n/a").otherwise(F.col("value").cast("decimal(18,2)").cast("string"))
    line = F.concat_ws(",", user, (F.col("user_id") + 1).cast("string"), kind, price)
    time = F.col("event_id").cast("string")
    whole = (
        F.when(kind == "error", line)
        .when(kind == "view", F.concat(line, F.lit(","), time, F.lit(",")))
        .otherwise(F.concat(line, F.lit(","), time))
    )
    return events.select("event_id", "ts", whole.alias("value"))


def nested_documents(documents: DataFrame) -> DataFrame:
    """Each document with an array of structs: number and length of each of its lines."""
    lines = F.transform(
        F.split("text", "\n"),
        lambda line, i: F.struct((i + 1).alias("line_no"), F.length(line).alias("n_chars")),
    )
    return documents.select("doc_id", "lang", lines.alias("nested"))


NESTED_SQL = """
d as (select doc_id, lang, string_split(text, chr(10)) as parts from documents),
el as (select doc_id, lang, cast(i as integer) as line_no, cast(length(parts[i]) as integer) as n_chars
  from (select doc_id, lang, parts, unnest(range(1, len(parts) + 1)) as i from d))
"""


def text_lines(texts: DataFrame) -> DataFrame:
    """The lines of all texts as ``value``."""
    return texts.select(F.explode(F.split("text", "\n")).alias("value"))


def trade_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directed graph of all line items: customer to part, part to supplier, supplier to customer.

    The three kinds of id are interleaved: 3 * key, 3 * key + 1, 3 * key + 2.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    rows = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("o_custkey") * 3).alias("c"),
        (F.col("l_partkey") * 3 + 1).alias("p"),
        (F.col("l_suppkey") * 3 + 2).alias("s"),
    )
    links = F.array(
        F.struct(F.col("c").alias("src"), F.col("p").alias("dst")),
        F.struct(F.col("p").alias("src"), F.col("s").alias("dst")),
        F.struct(F.col("s").alias("src"), F.col("c").alias("dst")),
    )
    return rows.select(F.inline(links))


TRADE_SQL = """
trade as (select o_custkey * 3 as c, l_partkey * 3 + 1 as p, l_suppkey * 3 + 2 as s
  from lineitem join orders on l_orderkey = o_orderkey),
e as (select c as src, p as dst from trade union all select p, s from trade
  union all select s, c from trade)
"""
