"""Appending to a catalog table."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.mapping import map_by_position


def destination_schema(spark: SparkSession, table: str) -> T.StructType:
    """The schema of a table, from the catalog; no rows are read."""
    return spark.table(table).schema


def append_table(
    df: DataFrame,
    table: str,
    read_only: Collection[str] = (),
    generated: Mapping[str, Column] | None = None,
) -> None:
    """Append all rows of ``df`` by position, in one commit."""
    schema = destination_schema(df.sparkSession, table)
    map_by_position(df, schema, read_only, generated).write.insertInto(table)
