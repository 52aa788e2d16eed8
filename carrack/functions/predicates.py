"""Row predicates that callers may give as text or as a Column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Predicate = Column | str | None


def restrict(df: DataFrame, where: Predicate) -> DataFrame:
    """``df`` under ``where``; the predicate is always one unit, and ``None`` or '' keeps all rows."""
    if where is None or (isinstance(where, str) and not where.strip()):
        return df
    return df.where(F.expr(where) if isinstance(where, str) else where)
