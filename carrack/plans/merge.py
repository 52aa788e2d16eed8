"""Merging a folder of text shards into one or more outputs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..functions.fields import NameField
from ..operators import distribution
from ..operators.numbering import NumberedLines, number_lines
from ..session import scratch_path
from ..sinks.files import output_paths, write_outputs
from ..sources.shards import list_shards

ROWS_PER_PART = 2_000_000


@dataclass(frozen=True)
class MergedLines:
    """Rows ``output, position, line``.  Position 0 of every output is the header if there is one."""

    lines: DataFrame
    n_outputs: int
    n_data_lines: int
    header: str | None


@dataclass(frozen=True)
class MergeResult:
    paths: list[str]
    n_data_lines: int
    header: str | None


def deal_lines(
    spark: SparkSession,
    numbered: NumberedLines,
    n_outputs: int = 1,
    field: NameField | None = None,
    has_header: bool = True,
) -> MergedLines:
    """Deal the surviving lines out to ``n_outputs``, every output headed by the header.

    The header is the first surviving line of the first file, even where skipping has
    removed the real header; a first file without any leaves the outputs without a
    header.  ``has_header=False`` makes every line a data line.
    """
    headed = has_header and numbered.in_first_file > 0
    ordinal = F.col("ordinal") - F.lit(1 if headed else 0)
    output, place = distribution.round_robin(ordinal, n_outputs)
    line = field.prefix(F.col("file_name"), F.col("line")) if field else F.col("line")
    data = numbered.lines
    if headed:
        data = data.where(F.col("ordinal") > 0)
    lines = data.select(output.alias("output"), (place + (1 if headed else 0)).alias("position"), line.alias("line"))

    header = None
    if headed:
        header = field.head(numbered.head) if field else numbered.head
        heads = spark.range(1, n_outputs + 1).select(
            F.col("id").cast("int").alias("output"),
            F.lit(0).cast("bigint").alias("position"),
            F.lit(header).alias("line"),
        )
        lines = heads.unionByName(lines)
    return MergedLines(lines, n_outputs, numbered.total - (1 if headed else 0), header)


def merge_shards(
    spark: SparkSession,
    folder: str,
    output: str,
    skip_first: int = 0,
    skip_others: int = 0,
    codec: str = "auto",
    n_outputs: int = 1,
    field_name: str | None = None,
    field_pattern: str | None = None,
    field_delimiter: str | None = None,
    has_header: bool = True,
    layout: str = "parts",
    rows_per_part: int = ROWS_PER_PART,
    line_sep: str = "\n",
) -> MergeResult:
    """Merge the shards of ``folder`` into ``output`` (see :func:`output_paths` for the names).

    ``layout="parts"`` makes every output a folder of ordered part files, written by
    as many tasks as the line count calls for.  ``layout="files"`` makes every output
    one file: on a store that joins files (HDFS) from such parts, elsewhere written by
    one task per output, as nothing else can give one file there.
    """
    if layout not in ("files", "parts"):
        raise ValueError("layout must be 'files' or 'parts'")
    if not output.strip():
        raise ValueError("an output path is needed")
    paths = output_paths(output, n_outputs)
    field = NameField.of(field_name, field_pattern, field_delimiter)
    shards = list_shards(spark, folder, codec)
    staging = scratch_path(spark, "merge")
    try:
        numbered = number_lines(spark, shards, staging, skip_first, skip_others)
        merged = deal_lines(spark, numbered, n_outputs, field, has_header)
        if layout == "files" and not storage.can_concat(spark, staging):
            ordered = distribution.in_one_task_per_output(merged.lines, n_outputs)
        else:
            longest = distribution.lines_per_output(merged.n_data_lines, n_outputs) + 1
            n_parts = max(1, -(-longest // rows_per_part))
            ordered = distribution.in_ordered_parts(merged.lines, n_outputs, n_parts, longest)
        write_outputs(spark, ordered, paths, f"{staging}/outputs", layout == "parts", line_sep)
    finally:
        storage.delete(spark, staging)
    return MergeResult(paths, merged.n_data_lines, merged.header)
