"""Measured bounds for broadcasts."""

from __future__ import annotations

from functools import reduce
from operator import add
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

BROADCAST_BYTES = 128 * 1024 * 1024
ROW_OVERHEAD = 32


# Types whose extremes survive the way over the driver exactly.
RANGE_TYPES = (T.IntegralType, T.DateType, T.StringType, T.DecimalType)


class KeySpan(NamedTuple):
    """How large a set of keys is, and between which values it lies (``None``: not told)."""

    n_bytes: int
    low: Any
    high: Any

    @property
    def small(self) -> bool:
        return self.n_bytes <= BROADCAST_BYTES


def bytes_of(df: DataFrame) -> Column:
    """The aggregate for what the rows of ``df`` take in memory."""
    width = reduce(add, [_width(f) for f in df.schema.fields], F.lit(ROW_OVERHEAD).cast("bigint"))
    return F.coalesce(F.sum(width), F.lit(0))


def measured_bytes(df: DataFrame) -> int:
    """Bytes that the rows of ``df`` take in memory, from one narrow aggregation."""
    return df.agg(bytes_of(df).alias("n_bytes")).first()["n_bytes"]


def settled(df: DataFrame) -> tuple[DataFrame, int]:
    """``df`` written to the shared folder, and its size, measured while writing.

    For a small result of a long scan: it is computed once, and a broadcast of it
    does not have to wait for the scan.
    """
    path, seen = scratch_path(df.sparkSession, "settled"), Observation()
    df.observe(seen, bytes_of(df).alias("n_bytes")).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get["n_bytes"]


def key_span(keys: DataFrame) -> KeySpan:
    """Measure a frame of one column in one aggregation."""
    [field] = keys.schema.fields
    if not isinstance(field.dataType, RANGE_TYPES):
        return KeySpan(measured_bytes(keys), None, None)
    return KeySpan(*keys.agg(bytes_of(keys), F.min(field.name), F.max(field.name)).first())


def cut_to_keys(df: DataFrame, keys: DataFrame, key: str, span: KeySpan) -> DataFrame:
    """The rows of a large ``df`` whose key is in the small frame ``keys``, without moving ``df``.

    The range of the keys prunes its scan; keys within the broadcast bound are then
    looked up row by row.  A larger set of keys only gives the range, so the result
    may hold more rows and has to be joined by key again.
    """
    if span.low is not None:
        df = df.where(F.col(key).between(F.lit(span.low), F.lit(span.high)))
    return df.join(F.broadcast(keys), key, "left_semi") if span.small else df


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """Mark ``df`` for broadcast if its measured size is within the bound.

    Beyond it the join is left to Catalyst and AQE, which shuffles both sides and
    splits skewed keys.
    """
    return F.broadcast(df) if measured_bytes(df) <= BROADCAST_BYTES else df


def _width(field: T.StructField) -> Column:
    column = F.col("`" + field.name.replace("`", "``") + "`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)).cast("bigint")
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)).cast("bigint")
    return F.lit(16).cast("bigint")
