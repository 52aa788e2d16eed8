"""Version watermarks and the rows and keys beyond them."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import Predicate, restrict
from ..functions.scalars import int_or_default

# What stands for "no version yet" on either side.
SOURCE_DEFAULT = 0
TARGET_DEFAULT = -1


class Watermark(NamedTuple):
    created: int
    modified: int


def watermark_row(df: DataFrame, created: str, modified: str, where: Predicate, default: int) -> DataFrame:
    """The highest ``created`` and ``modified`` version under ``where``, as one row."""
    return restrict(df, where).agg(
        int_or_default(F.max(created), default).alias("created"),
        int_or_default(F.max(modified), default).alias("modified"),
    )


def watermark(df: DataFrame, created: str, modified: str, where: Predicate, default: int) -> Watermark:
    row = watermark_row(df, created, modified, where, default).first()
    return Watermark(row["created"], row["modified"])


def delta_rows(df: DataFrame, mark: Watermark, created: str, modified: str, where: Predicate = None) -> DataFrame:
    """Rows created or modified after ``mark``; the literals reach the file scan.

    A NULL version is never later than the mark.
    """
    return restrict(df, where).where(
        (F.col(created) > F.lit(mark.created)) | (F.col(modified) > F.lit(mark.modified))
    )


def changed_keys(df: DataFrame, mark: Watermark, key: str, modified: str, where: Predicate = None) -> DataFrame:
    """Distinct keys of rows modified after ``mark``.

    Empty if the mark has no modified version yet.  NULL is no key.
    """
    rows = restrict(df, where).where(F.col(modified) > F.lit(mark.modified)).where(F.col(key).isNotNull())
    if mark.modified < 0:
        rows = rows.limit(0)
    return rows.select(key).distinct()
