"""Bulk loading the results of SELECT statements, with reports."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Collection, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.mapping import find_column, map_by_position
from ..session import scratch_path
from ..sinks.routed import ROUTE, note_failure, read_reports, route_of, split_value, write_load
from ..sinks.tables import destination_schema
from ..sources.statements import Statement, statement_list

#: Statements that run side by side; each is a distributed job.
STATEMENTS_AT_ONCE = 8

# The columns of the reports.
STATEMENT_REPORT = T.StructType(
    [
        T.StructField("BCPPackage", T.StringType()),
        T.StructField("NumRecords", T.LongType()),
        T.StructField("HasError", T.BooleanType()),
        T.StructField("SQLStatement", T.StringType()),
        T.StructField("ProcessingError", T.StringType()),
    ]
)

SPLIT_REPORT = T.StructType(
    [
        T.StructField("BCPPackage", T.StringType()),
        T.StructField("NumRecords", T.LongType()),
        T.StructField("HasError", T.BooleanType()),
        T.StructField("BCPSplitOnValueOfField", T.StringType()),
        T.StructField("BCPSplitOnValue", T.StringType()),
        T.StructField("ProcessingError", T.StringType()),
    ]
)


@dataclass(frozen=True)
class LoadResult:
    """The report of one load, and its totals."""

    report: DataFrame
    n_records: int
    seconds: float

    @property
    def records_per_second(self) -> int:
        return round(self.n_records / self.seconds) if self.seconds else 0


def union_statements(spark: SparkSession, statements: str | Sequence[str]) -> DataFrame:
    """All rows of all statements, by position and without removing duplicates."""
    return reduce(DataFrame.union, [spark.sql(s.sql) for s in statement_list(statements)])


def load_statements(
    spark: SparkSession,
    statements: str | Sequence[str],
    table: str,
    read_only: Collection[str] = (),
    generated: Mapping[str, Column] | None = None,
    on_error: str = "report",
) -> LoadResult:
    """Append the rows of every statement to ``table`` and report per statement.

    With ``on_error="raise"`` all statements are branches of one job.  With ``"report"``
    a failing one only shows in its row of the report: the statements run side by side,
    each into a table of its own in the shared folder, and those that end well are
    appended in one job with one commit.  Nothing is worked out twice.
    """
    if on_error not in ("report", "raise"):
        raise ValueError("on_error must be 'report' or 'raise'")
    started = time.monotonic()
    schema = destination_schema(spark, table)
    todo = statement_list(statements)
    errors: dict[str, str] = {}
    if on_error == "raise":
        planned = [(s, map_by_position(spark.sql(s.sql), schema, read_only, generated)) for s in todo]
        counts = _append(planned, table)
    else:

        def settle(statement: Statement) -> tuple[DataFrame, int]:
            rows = map_by_position(spark.sql(statement.sql), schema, read_only, generated)
            path, seen = scratch_path(spark, "statement"), Observation()
            rows.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
            return spark.read.schema(rows.schema).parquet(path), seen.get["n"]

        settled = _side_by_side(spark, todo, settle, errors)
        counts = {package: n for package, (_, n) in settled.items()}
        if settled:
            reduce(DataFrame.union, [df for df, _ in settled.values()]).write.insertInto(table)

    rows = [
        (s.package, counts.get(s.package, 0), s.package in errors, s.sql, errors.get(s.package, "")) for s in todo
    ]
    report = spark.createDataFrame(rows, STATEMENT_REPORT)
    return LoadResult(report, sum(counts.values()), time.monotonic() - started)


def _side_by_side(spark: SparkSession, todo: list[Statement], work: Callable, errors: dict[str, str]) -> dict:
    """The results of ``work`` by package, in the order of the statements; what fails goes to ``errors``."""
    with ThreadPoolExecutor(min(STATEMENTS_AT_ONCE, len(todo))) as pool:
        running = {s.package: pool.submit(inheritable_thread_target(spark)(work), s) for s in todo}
    done = {}
    for package, one in running.items():
        error = one.exception()
        if error is None:
            done[package] = one.result()
        elif isinstance(error, Exception):
            errors[package] = str(error)
        else:
            raise error
    return done


def _append(planned: list[tuple[Statement, DataFrame]], table: str) -> dict[str, int]:
    """One job.  The counts are taken in its last stage, where Spark counts each task once."""
    seen = {statement.package: Observation() for statement, _ in planned}
    branches = [df.observe(seen[s.package], F.count(F.lit(1)).alias("n")) for s, df in planned]
    reduce(DataFrame.union, branches).write.insertInto(table)
    return {package: observation.get["n"] for package, observation in seen.items()}


def load_routed(
    spark: SparkSession,
    statements: str | Sequence[str],
    schema: T.StructType,
    path: str,
    split: str,
    read_only: Collection[str] = (),
    generated: Mapping[str, Column] | None = None,
    load_id: str | None = None,
    max_splits: int | None = None,
    label: str | None = None,
    on_error: str = "raise",
) -> LoadResult:
    """Load all statements into the routed table at ``path``, one part per value of ``split``.

    The split column is found by name in every statement and need not be among the
    mapped columns.  ``max_splits`` refuses a load with more distinct values.  The
    report is counted on what was written, from the file footers.  With
    ``on_error="report"`` each statement is a load of its own, side by side with the
    others; one that fails is a row of the report with its error.
    """
    if on_error not in ("report", "raise"):
        raise ValueError("on_error must be 'report' or 'raise'")
    if on_error == "report" and max_splits is not None:
        raise ValueError("max_splits is checked over all statements, so it needs on_error='raise'")
    started = time.monotonic()
    load_id, label = load_id or uuid.uuid4().hex, label or path

    def routed(statement: Statement) -> DataFrame:
        df = spark.sql(statement.sql)
        by = F.col("`" + find_column(df, split).replace("`", "``") + "`")
        return map_by_position(df, schema, read_only, generated, {ROUTE: route_of(by)})

    todo = statement_list(statements)
    if on_error == "report":
        errors: dict[str, str] = {}

        def attempt(s: Statement) -> DataFrame:
            own = f"{load_id}-{s.package}"
            try:
                return write_load(spark, routed(s), path, own, lambda written: split_report(written, split, label))
            except Exception as error:
                note_failure(spark, path, own, str(error))
                raise

        loads = _side_by_side(spark, todo, attempt, errors)
        failed = [(f"BCP {label} : {name}", 0, True, split, "", error) for name, error in errors.items()]
        report = spark.createDataFrame(failed, SPLIT_REPORT)
        if loads:
            keys = [ROUTE, *(c for c in SPLIT_REPORT.names if c != "NumRecords")]
            told = reduce(DataFrame.union, loads.values()).groupBy(*keys).agg(F.sum("NumRecords").alias("NumRecords"))
            told = told.select(*SPLIT_REPORT.names)
            report = told.union(report)
        return LoadResult(report, _total(report), time.monotonic() - started)

    rows = reduce(DataFrame.union, [routed(s) for s in todo])
    if max_splits is not None:
        n_splits = rows.select(ROUTE).distinct().limit(max_splits + 1).count()
        if n_splits > max_splits:
            raise ValueError(f"{split} has more than {max_splits} distinct values")

    report = write_load(spark, rows, path, load_id, lambda written: split_report(written, split, label)).drop(ROUTE)
    return LoadResult(report, _total(report), time.monotonic() - started)


def routed_reports(spark: SparkSession, path: str) -> DataFrame:
    """The reports of all loads at ``path``, as they were written with the loads.

    A statement that failed under ``on_error="report"`` is a row with its ``error``.
    """
    return read_reports(spark, path, SPLIT_REPORT)


def _total(report: DataFrame) -> int:
    return report.agg(F.coalesce(F.sum("NumRecords"), F.lit(0)).alias("n")).first()["n"]


def split_report(written: DataFrame, split: str, label: str) -> DataFrame:
    """One row per split value of ``written``, and its route; NULL and '' are rows of their own, both shown as ''."""
    value = split_value(F.col(ROUTE))
    return written.groupBy(ROUTE).agg(F.count(F.lit(1)).alias("NumRecords")).select(
        F.concat(F.lit(f"BCP {label} : {split} = "), value).alias("BCPPackage"),
        "NumRecords",
        F.lit(False).alias("HasError"),
        F.lit(split).alias("BCPSplitOnValueOfField"),
        value.alias("BCPSplitOnValue"),
        F.lit("").alias("ProcessingError"),
        ROUTE,
    )
