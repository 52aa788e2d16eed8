"""Which keys differ between a source and its replica, found by digests of key ranges.

A range is the rows whose key hash begins with the same bits.  Its digest is a count and
two sums over hashes of its rows, so both sides shuffle one narrow row per range and
task.  Ranges with equal digests are left alone; the others are cut further, and only
rows of the last, small ranges that differ are shuffled and compared by key.  What moves
goes with the difference, not with the tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sizing import BROADCAST_BYTES, settled

#: Bits that each round adds to the ranges, and rows of a range that need no further round.
ROUND_BITS = 10
SMALL_RANGE = 64
MOST_BITS = 40


def _hashed(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``key, place, row``: a hash of the key, and one of all columns."""
    quoted = ["`" + c.replace("`", "``") + "`" for c in columns]
    # Which columns are missing is part of the hash, as hashing passes over nulls.
    missing = F.concat(*[F.when(F.col(c).isNull(), F.lit("0")).otherwise(F.lit("1")) for c in quoted])
    own = F.col("`" + key.replace("`", "``") + "`")
    return df.select(own.alias("key"), F.xxhash64(own).alias("place"), F.xxhash64(missing, *quoted).alias("row"))


def _range(bits: int) -> Column:
    return F.shiftrightunsigned("place", 64 - bits).alias("range")


def _digest() -> list[Column]:
    total = F.sum(F.col("row").cast("decimal(38,0)"))
    return [F.count("*").alias("n"), F.bit_xor(F.xxhash64("row")).alias("mix"), total.alias("total")]


def _in(side: DataFrame, ranges: DataFrame, bits: int) -> DataFrame:
    return side.join(ranges, F.shiftrightunsigned("place", 64 - bits) == F.col("range"), "left_semi")


def _both(left: DataFrame, right: DataFrame, on: str, facts: Sequence[str]) -> DataFrame:
    """A full join with ``<fact>`` of the left side, ``other_<fact>`` of the right one, and ``differs``."""
    other = right.select(F.col(on).alias("other"), *[F.col(f).alias(f"other_{f}") for f in facts])
    joined = left.join(other, F.col(on).eqNullSafe(F.col("other")), "full")
    same = [F.col(f).eqNullSafe(F.col(f"other_{f}")) for f in facts]
    for more in same[1:]:
        same[0] &= more
    return joined.withColumn(on, F.when(F.col(facts[0]).isNull(), F.col("other")).otherwise(F.col(on))).withColumn("differs", ~same[0])


def reconcile(source: DataFrame, target: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """``key, status, n_source, n_target`` for every key that the two do not hold alike.

    ``missing``: only the source has it; ``extra``: only the target; ``changed``: both,
    but not the same rows, each as often.  All rows without a key count as one key.  The
    tables are read once per round of :data:`ROUND_BITS` bits, in the ranges that still
    differ, and once more in the end; they are compared by ``columns``, or by those that
    both have.
    """
    columns = list(columns or [c for c in source.columns if c in target.columns])
    left, right, bits = _hashed(source, key, columns), _hashed(target, key, columns), 0
    ranges, facts = None, ["n", "mix", "total"]
    while bits < MOST_BITS:
        bits += ROUND_BITS
        sides = [side if ranges is None else _in(side, ranges, bits - ROUND_BITS) for side in (left, right)]
        found = _both(*[side.groupBy(_range(bits)).agg(*_digest()) for side in sides], "range", facts).where("differs")
        rows = F.greatest(F.coalesce("n", F.lit(0)), F.coalesce("other_n", F.lit(0)))
        found, n_bytes = settled(found.select("range", rows.alias("n")))
        most = found.agg(F.max("n")).first()[0] or 0
        ranges = F.broadcast(found.select("range")) if n_bytes <= BROADCAST_BYTES else found.select("range")
        if most <= SMALL_RANGE:
            break
    kept = [_in(side, ranges, bits).groupBy("key").agg(*_digest()) for side in (left, right)]
    found = _both(*kept, "key", facts).where("differs")
    status = F.when(F.col("other_n").isNull(), "missing").when(F.col("n").isNull(), "extra").otherwise("changed")
    counts = [F.coalesce(c, F.lit(0)).cast("long") for c in ("n", "other_n")]
    return found.select("key", status.alias("status"), counts[0].alias("n_source"), counts[1].alias("n_target"))
