"""A table that is loaded in parts, one per value of a split column.

Every load has its own folder ``load=<id>`` with one folder per value below it, so
loads do not touch each other and each shows up by a single rename, with its report
beside its rows.  The route is a
text of its own (``n`` for NULL, else ``v`` and the value): a plain partition column
would turn '' into NULL.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import storage

ROUTE = "__route"
LOAD = "__load"
#: Names that Spark passes over when it reads the rows: reports of loads, and loads that failed.
REPORT = "_report"
FAILED = "_failed"


def route_of(split: Column) -> Column:
    return F.coalesce(F.concat(F.lit("v"), split.cast("string")), F.lit("n"))


def split_value(route: Column) -> Column:
    """The split value as shown in reports; NULL shows as ''."""
    return F.substring(route, 2, 2_147_483_647)


def write_load(
    spark: SparkSession, rows: DataFrame, path: str, load_id: str, report: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Write ``rows`` (with a ``__route`` column) as one load; returns its report.

    ``report`` makes it from what was written.  It is written before the load is shown,
    so whoever sees the rows sees the report, though the driver may be gone.  The rebalance brings each value together for files of a good size.  AQE splits a
    value that is larger than the advisory partition size over several tasks, so a
    value with a third of all rows is not one task's work.
    """
    target = f"{path.rstrip('/')}/{LOAD}={load_id}"
    if storage.exists(spark, target):
        raise FileExistsError(f"load {load_id!r} exists in {path}")
    staging = f"{path.rstrip('/')}/_staging-{uuid.uuid4().hex}"
    try:
        rows.hint("rebalance", F.col(ROUTE)).write.mode("overwrite").partitionBy(ROUTE).parquet(staging)
        told = report(_read(spark, rows.schema, staging))
        told.write.parquet(f"{staging}/{REPORT}")
        storage.rename(spark, staging, target)
    except BaseException:
        storage.delete(spark, staging)
        raise
    return spark.read.schema(told.schema).parquet(f"{target}/{REPORT}")


def note_failure(spark: SparkSession, path: str, load_id: str, error: str) -> None:
    """Keep the error of a load that shows no rows."""
    folder = f"{path.rstrip('/')}/{FAILED}"
    storage.make_dir(spark, folder)
    storage.write_text(spark, f"{folder}/{uuid.uuid4().hex}.json", json.dumps({"load_id": load_id, "error": error}))


def read_reports(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """``load_id`` and the report of every load at ``path``; a failed one is a row with ``error``."""
    base = path.rstrip("/")
    entries = storage.list_dir(spark, base) if storage.is_dir(spark, base) else []
    full = T.StructType([T.StructField("load_id", T.StringType()), *schema.fields, T.StructField("error", T.StringType())])
    found = spark.createDataFrame([], full)
    shown = [e.name for e in entries if e.is_dir and e.name.startswith(f"{LOAD}=")]
    paths = [f"{base}/{name}/{REPORT}" for name in shown if storage.is_dir(spark, f"{base}/{name}/{REPORT}")]
    if paths:
        load_id = F.regexp_extract("_metadata.file_path", f"/{LOAD}=([^/]*)/{REPORT}/", 1)
        rows = spark.read.schema(schema).parquet(*paths)
        found = found.union(rows.select(load_id, *schema.names, F.lit(None).cast("string")))
    if any(e.name == FAILED for e in entries):
        failed = spark.read.schema("load_id string, error string").json(f"{base}/{FAILED}")
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
        found = found.union(failed.select("load_id", *empty, "error"))
    return found


def read_routed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows of all loads, without the folder columns."""
    extended = T.StructType(
        [*schema.fields, T.StructField(LOAD, T.StringType()), T.StructField(ROUTE, T.StringType())]
    )
    return _read(spark, extended, path).select(*[f"`{f.name}`" for f in schema.fields])


def _read(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)
