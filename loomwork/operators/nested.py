"""Nested records: explode, field access, flattening, tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def explode_structs(df: DataFrame, keep: Sequence[str], array: str) -> DataFrame:
    """One row per array element, its fields beside the ``keep`` columns."""
    return df.select(*keep, F.inline(array))


def explode_structs_sql(df: DataFrame, view: str, keep: Sequence[str], array: str) -> DataFrame:
    """The same through a temporary view and ``LATERAL VIEW``."""
    df.createOrReplaceTempView(view)
    fields = df.schema[array].dataType.elementType.fieldNames()
    columns = ", ".join([*keep, *[f"element.{f}" for f in fields]])
    return df.sparkSession.sql(
        f"SELECT {columns} FROM {view} LATERAL VIEW explode({array}) AS element"
    )


def _leaf(path: str, dtype: T.DataType, value: Column) -> Column:
    return F.struct(
        F.lit(path).alias("path"),
        F.lit(dtype.simpleString()).alias("type"),
        value.cast("string").alias("value"),
    )


def _leaves(dtype: T.DataType, value: Column, path: str) -> list[Column]:
    """Array columns that together hold every leaf under ``value``."""
    if isinstance(dtype, T.StructType):
        prefix = f"{path}." if path else ""
        return [
            leaf
            for f in dtype.fields
            for leaf in _leaves(f.dataType, value.getField(f.name), prefix + f.name)
        ]
    if isinstance(dtype, T.ArrayType):
        inner = F.transform(value, lambda x: F.concat(*_leaves(dtype.elementType, x, path)))
        return [F.coalesce(F.flatten(inner), F.array().cast(LEAVES))]
    return [F.array(_leaf(path, dtype, value))]


LEAVES = "array<struct<path:string,type:string,value:string>>"


def flatten_rows(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``(keep..., path, type, value)``: one row per leaf value at any depth.

    Elements of arrays share their array's dotted path.  The expression follows
    the schema, so the input is read once and nothing is shuffled.
    """
    leaves = [
        leaf for f in df.schema.fields for leaf in _leaves(f.dataType, F.col(f.name), f.name)
    ]
    return df.select(*keep, F.explode(F.concat(*leaves)).alias("_leaf")).select(*keep, "_leaf.*")


def create_table_if_absent(spark: SparkSession, name: str, columns: str, path: str) -> T.StructType:
    """Create an empty parquet table from column DDL, and return its schema."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet LOCATION '{path}'")
    return spark.table(name).schema


def rows_to_frame(spark: SparkSession, rows: Sequence, schema: T.StructType) -> DataFrame:
    """Literal rows with a declared schema, or one taken from a table."""
    return spark.createDataFrame(list(rows), schema)


def save_table(df: DataFrame, name: str, path: str, files: int | None = None) -> DataFrame:
    """Save as a gzip parquet table, optionally in ``files`` files, and read it back."""
    out = df.repartition(files) if files else df
    out.write.mode("overwrite").option("compression", "gzip").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)
