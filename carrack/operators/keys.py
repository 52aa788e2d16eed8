"""Taking rows away, or holding them back, by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import sizing
from .sizing import cut_to_keys, key_span, settled


def delete_by_keys(target: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``target`` without the rows whose key is in ``keys``; a NULL key always stays.

    The keys are worked out once and written to the shared folder.  A key set within
    the broadcast bound is then broadcast, so the target is not shuffled.
    """
    keys, n_bytes = settled(keys.select(key).where(F.col(key).isNotNull()))
    return target.join(F.broadcast(keys) if n_bytes <= sizing.BROADCAST_BYTES else keys, key, "left_anti")


def missing_rows(batch: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """The rows of ``batch`` whose key is not yet in ``target``.

    ``batch`` must be cheap to read more than once (a table, or persisted).  The
    target is first cut down to the keys of the batch: by their range, which prunes
    the scan, and by a semi-join with the broadcast keys.  So a small batch against a
    large target moves no target rows between executors.
    """
    keys = batch.select(key).where(F.col(key).isNotNull())
    span = key_span(keys)
    present = cut_to_keys(target.select(key), keys, key, span)
    if span.small:
        # Not more distinct keys than the batch has, so they are within the bound too.
        present = F.broadcast(present.distinct())
    return batch.join(present, key, "left_anti")


def insert_missing(batch: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """``target`` and the rows of ``batch`` that it does not have yet."""
    return target.unionByName(missing_rows(batch, target, key))
