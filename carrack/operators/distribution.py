"""Dealing merged lines out to outputs by arithmetic on their ordinal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def round_robin(ordinal: Column, n_outputs: int) -> tuple[Column, Column]:
    """The output (from 1) of a line and its place among the data lines there (from 0)."""
    if n_outputs < 1:
        raise ValueError("the number of outputs must be at least 1")
    output = (F.pmod(ordinal, F.lit(n_outputs)) + 1).cast("int")
    return output, F.floor(ordinal / F.lit(n_outputs)).cast("bigint")


def lines_per_output(total: int, n_outputs: int) -> int:
    """The length of the longest output."""
    return -(-total // n_outputs)


def in_one_task_per_output(lines: DataFrame, n_outputs: int) -> DataFrame:
    """Each output whole and in order in its own task; the sort there spills."""
    return lines.repartitionById(n_outputs, F.col("output") - 1).sortWithinPartitions("output", "position")


def in_ordered_parts(lines: DataFrame, n_outputs: int, n_parts: int, longest: int) -> DataFrame:
    """Each output as ``n_parts`` tasks of equal length in ascending order.

    Positions are dense, so the part is plain arithmetic: no sampling as for a range
    partitioning, and no task can get more than its share.
    """
    per_part = max(1, -(-longest // n_parts))
    part = F.least(F.floor(F.col("position") / F.lit(per_part)), F.lit(n_parts - 1))
    slot = ((F.col("output") - 1) * F.lit(n_parts) + part).cast("int")
    return lines.repartitionById(n_outputs * n_parts, slot).sortWithinPartitions("output", "position")
