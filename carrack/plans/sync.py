"""Incremental replication by version watermarks."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.predicates import Predicate, restrict
from ..functions.types import plan_types
from ..operators.keys import delete_by_keys
from ..operators.versions import TARGET_DEFAULT, Watermark, changed_keys, delta_rows, watermark
from ..sinks.replica import Replica


@dataclass(frozen=True)
class SyncRule:
    """What makes a row new or changed, and which row it replaces.

    ``on_conflict="append"`` replaces only rows whose source row has a later modified
    version; ``"replace"`` also replaces rows that only their created version brings in
    again.  Without a key column nothing is ever replaced.
    """

    created: str
    modified: str
    key: str
    where: Predicate = None
    on_conflict: str = "append"
    strict: bool = False
    datetime_as_date: bool = False

    def __post_init__(self):
        if self.on_conflict not in ("append", "replace"):
            raise ValueError("on_conflict must be 'append' or 'replace'")

    @property
    def name(self) -> str | None:
        """What its versions and slice are known by; a slice that is no text has no name."""
        if self.where is not None and not isinstance(self.where, str):
            return None
        return f"{self.created}, {self.modified}: {(self.where or '').strip()}"


@dataclass(frozen=True)
class SyncResult:
    before: Watermark
    n_records: int
    seconds: float

    @property
    def records_per_second(self) -> int:
        return round(self.n_records / self.seconds) if self.seconds else 0


def target_mark(target: DataFrame, rule: SyncRule) -> Watermark:
    return watermark(target, rule.created, rule.modified, rule.where, TARGET_DEFAULT)


def replica_mark(replica: Replica, rule: SyncRule) -> Watermark:
    """The watermark of a replica, in most cases without scanning all of it.

    The highest versions are not below those of an earlier sync unless rows have been
    replaced by older ones.  So the rows at or above the earlier mark are looked at
    first, which prunes all older files by their statistics; if there are none, the
    whole slice is scanned.
    """
    earlier = replica.state().marks.get(rule.name) if rule.name else None
    if earlier:
        created, modified = F.col(rule.created), F.col(rule.modified)
        near = restrict(replica.read(), rule.where).where((created >= earlier[0]) | (modified >= earlier[1]))
        top = near.agg(
            F.max(F.when(created >= earlier[0], created)).try_cast("bigint"),
            F.max(F.when(modified >= earlier[1], modified)).try_cast("bigint"),
        ).first()
        if None not in tuple(top):
            return Watermark(*top)
    return target_mark(replica.read(), rule)


def new_rows(source: DataFrame, mark: Watermark, rule: SyncRule) -> DataFrame:
    """The delta in target types."""
    plan = plan_types(source.schema, rule.strict, rule.datetime_as_date)
    return plan.apply(delta_rows(source, mark, rule.created, rule.modified, rule.where))


def replaced_keys(rows: DataFrame, mark: Watermark, rule: SyncRule) -> DataFrame | None:
    """Keys of delta rows that replace target rows, or ``None`` where there cannot be any."""
    if rule.key.lower() not in [name.lower() for name in rows.columns]:
        return None
    if rule.on_conflict == "replace":
        return rows.select(rule.key)
    if mark.modified < 0:
        return None
    return rows.where(F.col(rule.modified) > F.lit(mark.modified)).select(rule.key)


def sync_dataset(source: DataFrame, target: DataFrame, rule: SyncRule) -> DataFrame:
    """The target after one sync: its rows without the replaced keys, and the delta.

    Deletes go by key over the whole target, while the versions are compared within
    the slice.  Rows that are gone from the source stay.
    """
    mark = target_mark(target, rule)
    rows = new_rows(source, mark, rule)
    keys = replaced_keys(rows, mark, rule)
    kept = target if keys is None else delete_by_keys(target, keys, rule.key)
    return kept.unionByName(rows)


def sync_summary(source: DataFrame, target: DataFrame, rule: SyncRule) -> DataFrame:
    """One row ``deleted, inserted, unchanged, final`` for what :func:`sync_dataset` would do."""
    mark = target_mark(target, rule)
    rows = new_rows(source, mark, rule)
    keys = replaced_keys(rows, mark, rule)
    flagged = target.select(F.lit(None).cast("boolean").alias("__hit"))
    if keys is not None:
        hit = keys.where(F.col(rule.key).isNotNull()).distinct().withColumn("__hit", F.lit(True))
        flagged = target.select(rule.key).join(hit, rule.key, "left")
    none = F.lit(0).cast("bigint")
    before, unchanged = F.count(F.lit(1)).alias("before"), F.count_if(F.col("__hit").isNull()).alias("unchanged")
    parts = flagged.agg(before, unchanged, F.max(none).alias("inserted")).union(
        rows.agg(F.max(none), F.max(none), F.count(F.lit(1)))
    )
    counts = parts.agg(*[F.sum(c).alias(c) for c in ("before", "unchanged", "inserted")])
    return counts.select(
        (F.col("before") - F.col("unchanged")).alias("deleted"),
        "inserted",
        "unchanged",
        (F.col("unchanged") + F.col("inserted")).alias("final"),
    )


def create_replica(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    rule: SyncRule | None = None,
    partition_by=(),
    cluster_by=(),
    strict: bool = False,
    datetime_as_date: bool = False,
) -> Replica:
    """Drop and create an empty replica with the mapped column types of ``source``."""
    if rule:
        strict, datetime_as_date = rule.strict, rule.datetime_as_date
    plan = plan_types(source.schema, strict, datetime_as_date)
    names = {f.name.lower(): f.name for f in plan.schema.fields}
    key = names.get(rule.key.lower()) if rule else None
    return Replica.create(spark, path, plan.schema, key, partition_by, cluster_by)


def sync_replica(
    replica: Replica, source: DataFrame, rule: SyncRule, stream: tuple[str, int] | None = None
) -> SyncResult:
    """One sync into a replica.  The work is the delta, not the table.

    The source is read once, under literal version bounds that its scan can prune by;
    the replaced keys are read from the delta as it was written.
    """
    started = time.monotonic()
    mark = replica_mark(replica, rule)
    written = replica.publish(
        new_rows(source, mark, rule),
        lambda rows: replaced_keys(rows, mark, rule),
        stream,
        {rule.name: mark} if rule.name else None,
    )
    n_records = written.count()
    replica.tidy()
    return SyncResult(mark, n_records, time.monotonic() - started)
