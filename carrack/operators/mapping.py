"""Mapping source columns to a destination by position, and finding columns by name."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def find_column(df: DataFrame, name: str) -> str:
    """The spelling in ``df`` of the column called ``name``, ignoring case and outer blanks."""
    wanted = name.strip().lower()
    for column in df.columns:
        if column.strip().lower() == wanted:
            return column
    raise ValueError(f"column {name!r} was not found; available columns: {', '.join(df.columns)}")


def map_by_position(
    df: DataFrame,
    destination: T.StructType,
    read_only: Collection[str] = (),
    generated: Mapping[str, Column] | None = None,
    carry: Mapping[str, Column] | None = None,
) -> DataFrame:
    """The i-th source column becomes the i-th writable destination column, in its type.

    Source columns beyond the last writable one are cut off; too few are an error.
    Read-only columns take their value from ``generated``, else NULL.  ``carry`` adds
    columns computed from the source columns by name.
    """
    locked = {name.strip().lower() for name in read_only}
    writable = [f for f in destination.fields if f.name.strip().lower() not in locked]
    if len(df.columns) < len(writable):
        needed = ", ".join(f"{n}: {f.name}" for n, f in enumerate(writable))
        raise ValueError(
            f"column count mismatch: the source has {len(df.columns)} columns, the destination "
            f"{len(writable)} writable ones ({needed})"
        )
    made = {name.strip().lower(): column for name, column in (generated or {}).items()}
    extra = carry or {}
    source = df.select("*", *[column.alias(f"__carry_{n}") for n, column in enumerate(extra.values())])
    source = source.toDF(*[f"__col_{n}" for n in range(len(source.columns))])

    mapped, position = [], 0
    for field in destination.fields:
        key = field.name.strip().lower()
        if key in locked:
            value = made.get(key, F.lit(None))
        else:
            value, position = F.col(f"__col_{position}"), position + 1
        mapped.append(value.cast(field.dataType).alias(field.name))
    carried = [F.col(f"__col_{len(df.columns) + n}").alias(name) for n, name in enumerate(extra)]
    return source.select(*mapped, *carried)
