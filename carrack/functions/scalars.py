"""Scalar expressions, all built from Spark's own functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def int_or_default(value: Column, default: int) -> Column:
    """The value as a 64-bit integer; NULL or unreadable text gives ``default``.

    A failing cast costs an exception per row inside Spark, so text that does not
    begin like a number is not cast at all.
    """
    begins_well = value.cast("string").rlike(r"^\s*[-+]?[.\d]")
    return F.coalesce(F.when(begins_well, value.try_cast("bigint")), F.lit(default).cast("bigint"))


def is_blank(line: Column) -> Column:
    """True for an empty line and for one of white space only, tabs and Unicode spaces included.

    Most lines begin with a visible ASCII character, which two byte comparisons tell;
    only the others are searched.
    """
    begins_visibly = (line >= F.lit("!")) & (line < F.lit("\x7f"))
    return ~(begins_visibly | line.rlike(r"(?U)\S"))


def first_match(text: Column, pattern: str) -> Column:
    """The first match of ``pattern`` (Java dialect), or '' where there is none."""
    return F.regexp_extract(text, pattern, 0)


def time_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMddHHmmss")


def time_stamp_now() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d%H%M%S")


def zero_pad(number: Column, width: int) -> Column:
    """Digits with leading zeros; a number wider than ``width`` keeps all its digits."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def strip_brackets(name: Column) -> Column:
    return F.translate(name, "[]", "")
