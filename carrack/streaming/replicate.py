"""Replicating a stream into a replica table, batch by batch."""

from __future__ import annotations

import contextlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import storage
from ..operators import sizing
from ..sinks.replica import Replica

MODES = ("insert_missing", "upsert")
REPLACES = "__replaces"


def replicate_stream(
    stream: DataFrame,
    replica: Replica,
    key: str,
    checkpoint: str,
    mode: str = "insert_missing",
    modified: str | None = None,
    name: str | None = None,
    trigger: dict | None = None,
    progress: str | None = None,
) -> StreamingQuery:
    """Apply every micro-batch to ``replica``.

    ``upsert`` keeps the greatest row of each key: the latest ``modified`` version, and
    among equal ones the greatest by the other columns in their order.  So the table is
    the same however the stream is cut into batches and in whichever order rows arrive.
    ``insert_missing`` adds the rows whose key the replica does not have, of a key that
    a batch holds several times the greatest; what is there first stays.  A batch looks
    its keys up: it reads the pages of the replica that may hold them, not its key column.
    The batch number is part of each change, so a batch that Spark runs again after a failure is
    applied once; a full replay with a new checkpoint adds nothing either, because its
    keys are there.

    ``progress`` is a folder for the counts of each batch, for :func:`read_progress` to
    show while the stream runs.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if mode == "upsert" and not modified:
        raise ValueError("upsert needs the modified version column")
    position = name or checkpoint.rstrip("/")

    def note(number: int, rows: DataFrame, written: DataFrame, replaced: int) -> None:
        if progress:
            counts = {"batch": number, "submitted": rows.count(), "written": written.count(), "replaced": replaced}
            storage.make_dir(replica.spark, progress)
            with contextlib.suppress(FileExistsError):  # a batch that runs again
                storage.write_text(replica.spark, f"{progress}/{number:012d}.json", json.dumps(counts))

    def apply(batch: DataFrame, number: int) -> None:
        if replica.state().streams.get(position, -1) >= number:
            return
        batch = batch.persist()
        try:
            if mode == "insert_missing":
                one, keys = greatest_rows(batch, key), batch.select(key)
                present = replica.holding(keys, [key]).distinct()  # not more keys than the batch has
                if sizing.measured_bytes(keys) <= sizing.BROADCAST_BYTES:
                    present = F.broadcast(present)
                written = replica.publish(one.join(present, key, "left_anti"), None, (position, number))
                note(number, batch, written, 0)
            else:
                there = replica.holding(batch.select(key), batch.columns)
                newer = newer_rows(batch, there, key, modified)
                older = newer.where(F.col(REPLACES)).select(key)
                before = sum(replica.state().parts.values())
                written = replica.publish(newer, lambda _: older, (position, number))
                if progress:
                    added = written.count()
                    note(number, batch, written, before + added - sum(replica.state().parts.values()))
            replica.tidy()
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def read_progress(spark: SparkSession, folder: str) -> DataFrame:
    """``batch, submitted, written, replaced``: the counts of the batches that a stream has applied so far."""
    schema = "batch long, submitted long, written long, replaced long"
    if not storage.is_dir(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(folder)


def _order(columns: list[str], key: str, modified: str | None) -> Column:
    """A total order of the rows of a key; a missing version is before all others."""
    rest = [c for c in columns if c not in (key, modified)]
    return F.struct(*([modified] if modified else []), *rest)


def greatest_rows(batch: DataFrame, key: str, modified: str | None = None) -> DataFrame:
    """Per key the greatest row of ``batch``; rows without a key are all kept."""
    keyed = batch.where(F.col(key).isNotNull())
    greatest = keyed.groupBy(key).agg(F.max(_order(batch.columns, key, modified)).alias("row"))
    one = greatest.select(*[key if c == key else F.col("row")[c].alias(c) for c in batch.columns])
    return one.unionByName(batch.where(F.col(key).isNull()))


def newer_rows(batch: DataFrame, there: DataFrame, key: str, modified: str) -> DataFrame:
    """The rows of ``batch`` that are the greatest of their key and greater than the rows of it in ``there``;
    ``__replaces`` tells whether there are any.

    ``there`` may hold rows of other keys.  Rows without a key are all kept.
    """
    types = {f.name: f.dataType for f in there.schema.fields}
    batch = batch.select(*[F.col(c).cast(types[c]).alias(c) if c in types else c for c in batch.columns])
    there = there.groupBy(key).agg(F.max(_order(batch.columns, key, modified)).alias("__there"))
    latest = greatest_rows(batch, key, modified)
    later = F.col("__there").isNull() | (_order(batch.columns, key, modified) > F.col("__there"))
    newer = latest.join(there, key, "left").where(later)
    return newer.select(*batch.columns, F.col("__there").isNotNull().alias(REPLACES))
