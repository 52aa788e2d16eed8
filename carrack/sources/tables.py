"""Tables as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..functions.predicates import Predicate, restrict


def parquet_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def slice_scan(df: DataFrame, columns: Sequence[str] | None = None, where: Predicate = None) -> DataFrame:
    """Chosen columns of the rows under ``where``; both reach the file scan."""
    rows = restrict(df, where)
    return rows.select(*columns) if columns is not None else rows
