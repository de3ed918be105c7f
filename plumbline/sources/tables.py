"""Scans: Parquet with row positions, CSV by contract or as text, JSON pages and documents, parameter rows."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def with_position(spark: SparkSession, path: str, name: str = "source_row_id") -> DataFrame:
    """A Parquet file with each row's position in it. A month is one file; of several, positions repeat."""
    rows = spark.read.parquet(path)
    return rows.select(F.col("_metadata.row_index").alias(name), "*")


def csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None, **options: str) -> DataFrame:
    """CSV with a header. With a schema nothing is inferred; without one all columns are text. Empty fields are null."""
    reader = spark.read.option("header", True).options(**options)
    return (reader.schema(schema) if schema is not None else reader.option("inferSchema", False)).csv(path)


def csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header and inferred types, for small files whose types are then held against a contract."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def json_pages(spark: SparkSession, paths: Sequence[str], schema: T.StructType | str | None = None) -> DataFrame:
    """Pages that each hold a JSON array (or one document), read as one frame."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema is not None else reader).json(list(paths))


def json_texts(rows: DataFrame, schema: str, column: str = "value") -> DataFrame:
    """Rows of texts that each hold a JSON array of objects of a declared schema."""
    return rows.select(F.inline(F.from_json(column, f"array<struct<{schema}>>")))


def flattened(rows: DataFrame, array: str, keep: Sequence[str]) -> DataFrame:
    """One row for each element of an array of structs, parent columns carried down; empty arrays give none."""
    return rows.select(*keep, F.inline(array))


def lookup_number(rows: DataFrame, where: dict[str, str], column: str) -> DataFrame:
    """A number with thousands separators from the first row that matches; the column is named `value`."""
    for name, value in where.items():
        rows = rows.filter(F.col(f"`{name}`") == value)
    return rows.select(F.regexp_replace(F.col(f"`{column}`"), ",", "").cast("long").alias("value")).limit(1)


def parameter_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Literal rows of a declared schema.

    They go by way of Arrow, which makes a local relation: Spark then knows its size and broadcasts it. Rows given as
    Python objects would be a frame of unknown size, and joining the data with it would shuffle the data.
    """
    struct = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(struct)
    columns = list(zip(*rows)) if rows else [[] for _ in struct]
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow), schema=struct)


def schema_rows(rows: DataFrame) -> list[tuple[str, str]]:
    """(name, type) of every column."""
    return rows.dtypes
