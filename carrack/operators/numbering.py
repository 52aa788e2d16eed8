"""Line numbers and global ordinals for text shards, without a global sort.

The lines are written out once with a ``line_id`` that grows in line order inside a
block.  After that a small table of counts, one row per run of at most ``RUN_LINES``
lines, is enough to turn a ``line_id`` into the line number in its file and into the
ordinal over all files.  Text is never shuffled for numbering,
except for runs that have a blank line in their middle, and then in groups of at
most ``RUN_LINES`` lines.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import is_blank
from ..sources.shards import ShardFolder, scan_shards

RUN_BITS = 20
RUN_LINES = 1 << RUN_BITS
FILES_PER_GROUP = 1024
# One row of the run table takes about 150 bytes in a broadcast hash table.
BROADCAST_RUNS = 2_000_000
RUN = ["file_name", "block_start", "run"]

# Lines hardly repeat, so a dictionary for them is wasted work.
STAGING_OPTIONS = {"compression": "lz4", "parquet.enable.dictionary#line": "false"}
STAGED_SCHEMA = T.StructType(
    [
        T.StructField("file_name", T.StringType()),
        T.StructField("block_start", T.LongType()),
        T.StructField("line_id", T.LongType()),
        T.StructField("blank", T.BooleanType()),
        T.StructField("line", T.StringType()),
    ]
)


@dataclass(frozen=True)
class NumberedLines:
    """The surviving lines ``file_name, line_no, ordinal, line`` (both numbers from 0),
    how many there are, how many of them are in the first file, and the first one."""

    lines: DataFrame
    total: int
    in_first_file: int
    head: str | None


def number_lines(
    spark: SparkSession,
    folder: ShardFolder,
    staging: str,
    skip_first: int = 0,
    skip_others: int = 0,
) -> NumberedLines:
    """Skip leading lines, drop blank ones, number the rest.

    ``skip_first`` physical lines of the first file and ``skip_others`` of every
    other file are left out; blank lines count for that.  ``staging`` is a path that
    must outlive the result.
    """
    if skip_first < 0 or skip_others < 0:
        raise ValueError("the number of lines to skip must not be negative")
    staged = _stage(spark, folder, f"{staging}/lines")
    runs, facts = _count_runs(spark, folder, staged, skip_first, skip_others, f"{staging}/runs")

    head = None
    if facts["head"] is not None:
        # Two literals that the parquet scan prunes by; one row comes back.
        at_head = (F.col("file_name") == facts["head"]["file_name"]) & (F.col("line_id") == facts["head"]["first_kept"])
        head = staged.where(at_head).select("line").first()["line"]

    return NumberedLines(
        _place(staged, runs, facts["n_runs"], facts["any_gaps"]), facts["total"], facts["in_first_file"], head
    )


def _stage(spark: SparkSession, folder: ShardFolder, path: str) -> DataFrame:
    scan_shards(spark, folder).select(
        "file_name", "block_start", "line_id", is_blank(F.col("line")).alias("blank"), "line"
    ).write.options(**STAGING_OPTIONS).parquet(path)
    return spark.read.schema(STAGED_SCHEMA).parquet(path).withColumn(
        "run", F.shiftright("line_id", RUN_BITS)
    )


def _count_runs(
    spark: SparkSession, folder: ShardFolder, staged: DataFrame, skip_first: int, skip_others: int, path: str
) -> tuple[DataFrame, dict]:
    """One row per run: where its lines start in the file and where its kept lines start
    overall; and the totals, counted in the last stage of the write."""
    kept = ~F.col("blank")
    runs = staged.groupBy(*RUN).agg(
        F.min("line_id").alias("first_id"),
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(kept).alias("n_kept"),
        F.min(F.when(kept, F.col("line_id"))).alias("first_kept"),
        F.max(F.when(kept, F.col("line_id"))).alias("last_kept"),
    )
    # The names are already on the driver, as they are in Spark's own file index.
    order = pa.table({"file_no": range(len(folder.names)), "file_name": list(folder.names)})
    in_file = Window.partitionBy("file_name").orderBy("block_start", "run")
    unlisted = F.raise_error(F.concat(F.lit("file was added during the merge: "), "file_name")).cast("bigint")
    runs = runs.join(spark.createDataFrame(order), "file_name", "left").withColumns(
        {
            "file_no": F.coalesce("file_no", unlisted),
            "lines_before": F.sum("n_lines").over(in_file) - F.col("n_lines"),
            "skip": F.when(F.col("file_name") == folder.first, F.lit(skip_first)).otherwise(F.lit(skip_others)),
        }
    )
    table, facts = _write_runs(_skip(runs), folder, path)
    if facts["unsettled"]:
        table, facts = _write_runs(_recount(staged, table, facts["n_runs"]), folder, f"{path}-recounted")
    return table, facts


def _skip(runs: DataFrame) -> DataFrame:
    """Take the lines to skip out of the counts, by arithmetic.

    That is exact for a run that the skipping does not reach, and for one without
    blank lines between its kept ones.  Others are ``unsettled`` and keep their counts.
    """
    boundary = F.col("first_id") + F.col("skip") - F.col("lines_before")
    reached = (F.col("n_kept") > 0) & (F.col("first_kept") < boundary)
    has_gaps = F.col("last_kept") - F.col("first_kept") + 1 > F.col("n_kept")
    survives = F.col("last_kept") >= boundary
    runs = runs.withColumns({"boundary": boundary, "unsettled": reached & has_gaps & survives})
    cut = F.col("first_kept") < F.col("boundary")
    return runs.withColumns(
        {
            "n_kept": F.when(F.col("unsettled") | ~reached, F.col("n_kept"))
            .when(survives, F.col("last_kept") - F.col("boundary") + 1)
            .otherwise(0),
            "first_kept": F.when(F.col("unsettled") | ~cut, F.col("first_kept")).when(survives, F.col("boundary")),
            "last_kept": F.when(F.col("unsettled") | ~cut | survives, F.col("last_kept")),
        }
    )


def _write_runs(runs: DataFrame, folder: ShardFolder, path: str) -> tuple[DataFrame, dict]:
    runs = _with_kept_before(runs, len(folder.names)).withColumn(
        "dense", F.col("last_kept") - F.col("first_kept") + 1 == F.col("n_kept")
    )
    has_kept = F.col("n_kept") > 0
    of_first_file = F.when(F.col("file_name") == folder.first, F.col("n_kept"))
    at_start = F.when(has_kept & (F.col("kept_before") == 0), F.struct("file_name", "first_kept"))
    seen = Observation()
    runs.observe(
        seen,
        F.count(F.lit(1)).alias("n_runs"),
        F.coalesce(F.sum("n_kept"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(of_first_file), F.lit(0)).alias("in_first_file"),
        F.coalesce(F.bool_or(has_kept & ~F.col("dense")), F.lit(False)).alias("any_gaps"),
        F.coalesce(F.bool_or("unsettled"), F.lit(False)).alias("unsettled"),
        F.min(at_start).alias("head"),
    ).write.parquet(path)
    return _table(runs, path), seen.get


def _table(like: DataFrame, path: str) -> DataFrame:
    return like.sparkSession.read.schema(like.schema).parquet(path)


def _recount(staged: DataFrame, runs: DataFrame, n_runs: int) -> DataFrame:
    """Count the kept lines of the unsettled runs again, line by line."""
    unsettled = runs.where("unsettled").select(*RUN, "boundary")
    recounted = (
        staged.where(~F.col("blank"))
        .join(F.broadcast(unsettled) if n_runs <= BROADCAST_RUNS else unsettled, RUN)
        .where(F.col("line_id") >= F.col("boundary"))
        .groupBy(*RUN)
        .agg(F.count(F.lit(1)).alias("n_left"), F.min("line_id").alias("first_left"))
    )
    again = F.col("unsettled")
    return runs.join(recounted, RUN, "left").withColumns(
        {
            "n_kept": F.when(again, F.coalesce("n_left", F.lit(0))).otherwise(F.col("n_kept")),
            "first_kept": F.when(again, F.col("first_left")).otherwise(F.col("first_kept")),
            "unsettled": F.lit(False),
        }
    )


def _with_kept_before(runs: DataFrame, n_files: int) -> DataFrame:
    """Running totals of kept lines: inside a group of files, then over the groups.

    Only the second window has no partitions, and it has one row per
    ``FILES_PER_GROUP`` files.
    """
    runs = runs.withColumn("file_group", F.floor(F.col("file_no") / FILES_PER_GROUP))
    in_group = Window.partitionBy("file_group").orderBy("file_no", "block_start", "run")
    placed = runs.withColumn("kept_before", F.sum("n_kept").over(in_group) - F.col("n_kept"))
    if n_files > FILES_PER_GROUP:
        over_groups = Window.orderBy("file_group")
        groups = runs.groupBy("file_group").agg(F.sum("n_kept").alias("n_group"))
        groups = groups.select("file_group", (F.sum("n_group").over(over_groups) - F.col("n_group")).alias("before_group"))
        placed = placed.join(groups, "file_group").withColumn(
            "kept_before", F.col("kept_before") + F.col("before_group")
        )
    kept = ["first_id", "lines_before", "boundary", "unsettled", "n_kept", "first_kept", "last_kept", "kept_before"]
    return placed.select("file_no", *RUN, *kept)


def _place(staged: DataFrame, runs: DataFrame, n_runs: int, any_gaps: bool) -> DataFrame:
    keep = ~F.col("blank") & F.col("line_id").between(F.col("first_kept"), F.col("last_kept"))
    line_no = F.col("lines_before") + F.col("line_id") - F.col("first_id")
    columns = [*RUN, "first_id", "lines_before", "first_kept", "last_kept", "kept_before"]

    def joined(some: DataFrame) -> DataFrame:
        some = some.select(*columns)
        return staged.join(F.broadcast(some) if n_runs <= BROADCAST_RUNS else some, RUN).where(keep)

    def numbered(lines: DataFrame, rank) -> DataFrame:
        return lines.select(
            "file_name", line_no.alias("line_no"), (F.col("kept_before") + rank).alias("ordinal"), "line"
        )

    placed = numbered(joined(runs.where("dense")), F.col("line_id") - F.col("first_kept"))
    if any_gaps:
        # A blank line between kept ones: rank inside the run, at most RUN_LINES lines.
        in_run = Window.partitionBy(*RUN).orderBy("line_id")
        placed = placed.unionByName(numbered(joined(runs.where("NOT dense")), F.row_number().over(in_run) - 1))
    return placed
