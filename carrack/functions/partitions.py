"""Text in partition columns, coded, since a folder name cannot tell '' from NULL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

CODED = "__v_"


def is_coded(name: str, schema: T.StructType, partition_by: Sequence[str]) -> bool:
    return name in partition_by and isinstance(schema[name].dataType, T.StringType)


def stored_name(name: str, schema: T.StructType, partition_by: Sequence[str]) -> str:
    return CODED + name if is_coded(name, schema, partition_by) else name


def stored_columns(schema: T.StructType, partition_by: Sequence[str]) -> list[T.StructField]:
    return [T.StructField(stored_name(f.name, schema, partition_by), f.dataType) for f in schema.fields]


def coded(schema: T.StructType, partition_by: Sequence[str]) -> list[Column]:
    """The columns as they are stored."""
    return [
        F.concat(F.lit("v"), _column(f.name)).alias(CODED + f.name) if is_coded(f.name, schema, partition_by) else _column(f.name)
        for f in schema.fields
    ]


def decoded_columns(schema: T.StructType, partition_by: Sequence[str]) -> list[Column]:
    """The columns as they were before they were stored."""
    return [
        F.substring(_column(CODED + f.name), 2, 2_147_483_647).alias(f.name)
        if is_coded(f.name, schema, partition_by)
        else _column(f.name)
        for f in schema.fields
    ]


def _column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")
