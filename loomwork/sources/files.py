"""Reading and inspecting files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The record types of the shipped kinds of input.
SCHEMAS = {
    "window": "group string, time long, value long",
    "timeseries": "group string, ts long, value long",
    "timeseries_events": "group string, ts long, value long, event_type string",
    "baskets": "group string, actions array<struct<action:long>>",
    "salted": "group string, value long",
    "nested": "group string, time long, value long, nested array<struct<col1:double,col2:double>>",
    "vertex": "vertex_id long, name string, is_zombie string, time_alive long",
    "edge": "src long, dst long, edge_type string",
    "weather": "outlook string, temp int, tempEnum string, humidity int, humidityEnum string,"
    " windyFlag boolean, playFlag string",
}


def read_json(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """JSON lines.  Give a schema: inferring one reads the whole input first."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.json(path)


def read_csv(
    spark: SparkSession,
    path: str,
    header: bool = True,
    sep: str = ",",
    schema: str | T.StructType | None = None,
) -> DataFrame:
    """Delimited UTF-8 text; all columns are strings unless a schema is given."""
    reader = spark.read.options(header=header, sep=sep, encoding="UTF-8")
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def read_tsv(
    spark: SparkSession, path: str, header: bool = False, schema: str | T.StructType | None = None
) -> DataFrame:
    """Tab-separated text, without a header line by default."""
    return read_csv(spark, path, header=header, sep="\t", schema=schema)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines as ``value``."""
    return spark.read.text(path)


def query_view(df: DataFrame, view: str, limit: int | None = None) -> DataFrame:
    """Register ``df`` as a temporary view and select from it."""
    df.createOrReplaceTempView(view)
    out = df.sparkSession.sql(f"SELECT * FROM {view}")
    return out.limit(limit) if limit is not None else out


def schema_tree(df: DataFrame) -> str:
    """The schema as an indented tree."""
    return df.schema.treeString()


def from_values(spark: SparkSession, values: list, partitions: int) -> DataFrame:
    """A literal collection with its position and page, in ``partitions`` even pages."""
    rows = [(i * partitions // len(values), i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "page int, pos long, value long")
    return df.repartitionById(partitions, "page").sortWithinPartitions("pos")
