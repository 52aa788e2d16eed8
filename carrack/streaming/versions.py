"""Following a versioned table: a stream whose offset is the highest created and modified version.

The versions that a trigger reaches are kept in the replica's pointer, in the same step
as the rows that they bring.  So a query that is started again goes on where the last
change ended, whatever became of its checkpoint, and a batch that Spark runs again finds
nothing newer.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.predicates import restrict
from ..functions.types import plan_types
from ..operators.versions import SOURCE_DEFAULT, Watermark, watermark
from ..plans.sync import SyncRule, replaced_keys, replica_mark
from ..sinks.replica import Replica


def rows_between(source: DataFrame, low: Watermark, high: Watermark, rule: SyncRule) -> DataFrame:
    """Rows of the slice that are later than ``low`` in one of their versions and not later than ``high`` in any.

    Every row is in exactly one of a sequence of steps.  A missing version is neither.
    """
    created, modified = F.col(rule.created), F.col(rule.modified)
    later = (created > F.lit(low.created)) | (modified > F.lit(low.modified))
    beyond = F.coalesce(created > F.lit(high.created), F.lit(False)) | F.coalesce(
        modified > F.lit(high.modified), F.lit(False)
    )
    return restrict(source, rule.where).where(later & ~beyond)


def step(read: Callable[[], DataFrame], replica: Replica, rule: SyncRule, position: str) -> bool:
    """Bring ``replica`` to the versions that the table has now; whether there were newer ones."""
    source, reached = read(), replica.state().marks.get(position)
    low = Watermark(*reached) if reached else replica_mark(replica, rule)
    top = watermark(source, rule.created, rule.modified, rule.where, SOURCE_DEFAULT)
    high = Watermark(max(low.created, top.created), max(low.modified, top.modified))
    if high == low:
        return False
    plan = plan_types(source.schema, rule.strict, rule.datetime_as_date)
    replica.publish(
        plan.apply(rows_between(source, low, high, rule)),
        lambda rows: replaced_keys(rows, low, rule),
        marks={position: high},
    )
    replica.tidy()
    return True


def replicate_table(
    spark: SparkSession,
    read: Callable[[], DataFrame],
    replica: Replica,
    rule: SyncRule,
    checkpoint: str,
    name: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Follow a versioned table into ``replica``: each trigger takes what has become newer under the slice.

    ``read`` gives the table as it is now.  A trigger starts one narrow aggregation of
    the two version columns and, if they have grown, one read of the rows in between,
    under literal bounds that the scan prunes by.  ``trigger`` is that of a stream; the
    default catches up once.
    """
    position = f"table {name or checkpoint.rstrip('/')}"
    ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).option("numPartitions", 1).load()

    def apply(_: DataFrame, __: int) -> None:
        step(read, replica, rule, position)

    writer = ticks.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
