"""Mixing sources to target weights by repetition.

1. One narrow aggregation gives the words of each source.
2. Sources are ranked by code point, null last, and weigh ``WEIGHTS`` in turn.  A target
   is the weight's share of all words, at most ``MOST`` times the source's own; what is
   cut off is shared again by weight among the others until none is above.
3. The repetition rate of a source is its target over its words.  A document is emitted
   floor(rate) times, and once more if its draw is below the fraction.
4. A document has ``DRAFTS`` draws, 32-bit words of SHA-256 digests seeded by its doc_id
   and text, so a rerun, on any number of tasks, draws the same.  The words that each draft
   would take are summed by source, and the draft that comes nearest to the target is
   the source's.  So one very long document cannot throw a small source off.

Only sums move in the aggregations, so a hot source is no hot task.  The table of sources
may grow with the data: it is ranked by a sort over all tasks, shared out by rounds of
one aggregation each, and broadcast only within a measured bound.

Cases: a null or empty text has size 0 and takes no words; a null source is a source, the
last one, and '' another; a source without words has target 0; rows that share doc_id and
text draw alike, so they are all taken once more or none is; without doc_id the text
draws; without any words all targets are 0; an empty table gives an empty table.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sizing import broadcast_if_small
from .tables import documents, written

WEIGHTS = (1, 2, 3)
MOST = 3
DRAFTS = 32
WORD = r"[^\x20\x09-\x0D]+"
_EXACT = "decimal(38,0)"


class Level(NamedTuple):
    """What a source gets per unit of weight: ``words`` over ``weight``."""

    words: int
    weight: int


def size_of(text: Column) -> Column:
    """The words of a text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def digest_of(doc_id: Column, text: Column) -> Column:
    none = F.lit("")
    return F.sha2(F.concat(F.coalesce(doc_id.cast("string"), none), F.lit(":"), F.coalesce(text, none)), 256)


def draw(digest: Column, draft: int) -> Column:
    """A number from 0 to 1, exclusive: one of the eight words of a digest for each eight drafts."""
    words = F.sha2(F.concat(digest, F.lit(f":{draft // 8}")), 256)
    return F.conv(F.substring(words, draft % 8 * 8 + 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with ``rank``, from 0 by code point and null last, without a task that sees all of them."""
    ordered = sources.orderBy(F.col("source").asc_nulls_last()).withColumn("at", F.monotonically_increasing_id())
    ordered = written(ordered, "sources")
    task = F.shiftright("at", 33)
    counts = ordered.groupBy(task.alias("task")).count().collect()  # one row per task of the sort
    before, total = {}, 0
    for row in sorted(counts):
        before[row["task"]] = total - (row["task"] << 33)
        total += row["count"]
    shifts = ordered.sparkSession.createDataFrame(list(before.items()) or [(0, 0)], "task long, shift long")
    joined = ordered.withColumn("task", task).join(F.broadcast(shifts), "task")
    return joined.withColumn("rank", F.col("at") + F.col("shift")).drop("task", "at", "shift")


def _weight(weights: tuple[int, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))


def _above(level: Level, most: int) -> Column:
    """Whether the share of a source is above its cap, in whole numbers."""
    share = F.col("weight").cast("decimal(10,0)") * F.lit(Decimal(level.words)).cast("decimal(28,0)")
    return share > F.col("source_size").cast("decimal(19,0)") * F.lit(Decimal(most * level.weight)).cast("decimal(19,0)")


def shared_out(sources: DataFrame, most: int = MOST) -> Level:
    """The level at which the targets of ``source_size, weight`` add up to all words, by rounds of one aggregation."""
    size, weight = F.col("source_size").cast(_EXACT), F.col("weight").cast(_EXACT)
    total, weights = (int(x or 0) for x in sources.agg(F.sum(size), F.sum(weight)).first())
    level = Level(total, max(1, weights))
    while True:
        above = _above(level, most)
        words, taken = (int(x or 0) for x in sources.agg(F.sum(F.when(above, size)), F.sum(F.when(above, weight))).first())
        lower = Level(total - most * words, weights - taken)
        # All above: only if there are no words, or the caps add up to just the words.
        if lower == level or lower.weight <= 0:
            return level
        level = lower


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, digest`` of the rows of ``docs``, written once."""
    text = F.col("text")
    found = docs.select("doc_id", "source", size_of(text).alias("size"), digest_of(F.col("doc_id"), text).alias("digest"))
    return written(found, "sized")


def rates(found: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source, source_size, target, rate, draft`` for the rows that :func:`sized` gives."""
    sources = found.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = ranked(sources).withColumn("weight", _weight(weights))
    level = shared_out(sources, most)
    share = F.col("weight") * F.lit(level.words).cast("double") / F.lit(float(level.weight))
    target = F.when(_above(level, most), (most * F.col("source_size")).cast("double")).otherwise(share)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    sources = written(
        sources.select("source", "source_size", target.alias("target")).withColumn("rate", rate), "rates"
    )
    rated = _with_rates(found, sources)
    words = [F.sum(F.col("size") * copies(F.lit(k))).alias(f"words_{k}") for k in range(DRAFTS)]
    off = [F.struct(F.abs(F.col(f"words_{k}") - F.col("target")).alias("off"), F.lit(k).alias("draft")) for k in range(DRAFTS)]
    drafted = rated.groupBy("source").agg(*words, F.max("target").alias("target"))
    best = drafted.select(F.col("source").alias("of"), F.least(*off)["draft"].alias("draft"))
    return written(sources.join(best, F.col("source").eqNullSafe(F.col("of"))).drop("of"), "drafts")


def copies(draft: Column) -> Column:
    """How often a row of ``rate, digest`` is taken: floor(rate), and once more by its draw."""
    drawn = reduce(lambda other, k: other.when(draft == k, draw(F.col("digest"), k)), range(1, DRAFTS), F.when(draft == 0, draw(F.col("digest"), 0)))
    extra = drawn < F.col("rate") - F.floor("rate")
    return F.floor("rate") + F.when(extra, 1).otherwise(0)


def _with_rates(found: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows with the columns of their source; a large table of sources is shuffled, and hot ones split by AQE."""
    known = broadcast_if_small(sources.withColumnRenamed("source", "of"))
    return found.join(known, F.col("source").eqNullSafe(F.col("of"))).drop("of")


def taken(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``doc_id, source, size, source_size, target, rate, copies, taken`` for each row of ``docs``."""
    found = sized(docs)
    counted = _with_rates(found, rates(found, weights, most)).withColumn("copies", copies(F.col("draft")))
    counted = counted.withColumn("taken", F.col("size") * F.col("copies"))
    return counted.select("doc_id", "source", "size", "source_size", "target", "rate", "copies", "taken")


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The mix itself: every row of ``docs`` with all its columns, as often as it is taken."""
    sources = rates(sized(docs), weights, most)
    text = F.col("row.text")
    rows = docs.select(F.struct("*").alias("row")).select(
        "row", F.col("row.source").alias("source"), digest_of(F.col("row.doc_id"), text).alias("digest")
    )
    chosen = _with_rates(rows, sources).select("row", copies(F.col("draft")).cast("int").alias("copies"))
    return chosen.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("row.*")


def op11_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder, "doc_id", "source", "text")
    return taken(docs).select("doc_id", "size", "source_size", "target", "taken")


#: Sources in order of cap over weight: the level is that of the first that is not above its cap.
ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         sha256(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS digest
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT *, sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER below, 0) AS words,
         sum(weight) OVER () - coalesce(sum(weight) OVER below, 0) AS weights
  FROM sources
  WINDOW below AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT words, weights FROM levels WHERE weight * words <= 3 * source_size * weights
  ORDER BY source_size::DOUBLE / weight, source NULLS LAST LIMIT 1
), targets AS (
  SELECT source, source_size, CASE WHEN s.weight * l.words > 3 * source_size * l.weights THEN (3 * source_size)::DOUBLE
         ELSE (s.weight::DOUBLE * l.words::DOUBLE) / l.weights::DOUBLE END AS target
  FROM sources s, level l
), rated AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM targets
), drawn AS (
  SELECT d.*, r.source_size, r.target, r.rate, k AS draft,
         floor(r.rate)::BIGINT + CASE
           WHEN ('0x' || substr(sha256(digest || ':' || (k // 8)), (k % 8 * 8 + 1)::INT, 8))::BIGINT::DOUBLE / 4294967296.0
                < r.rate - floor(r.rate) THEN 1 ELSE 0 END AS copies
  FROM sized d JOIN rated r ON d.source IS NOT DISTINCT FROM r.source, range(32) t(k)
), best AS (
  SELECT source, arg_min(draft, (off, draft)) AS draft FROM (
    SELECT source, draft, abs(sum(size * copies)::BIGINT::DOUBLE - max(target)) AS off FROM drawn GROUP BY source, draft
  ) GROUP BY source
)
SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken
FROM drawn d JOIN best b ON d.source IS NOT DISTINCT FROM b.source AND d.draft = b.draft
"""
