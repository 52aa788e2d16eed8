"""Document fingerprints from closed syncmers, in DataFrame operations only.

A text is cut at ASCII white space and its words into units of at most ``UNIT``
characters.  An inner substring is two units in a row, a k-mer four inner substrings in
a row, five units.  A k-mer is an anchor if the smallest hash of its inner substrings is
at its first or last place: a closed syncmer.  That depends on the k-mer alone, so equal
passages have equal anchors wherever they stand, and an edit only changes the anchors
that it touches.

In a run of more than ``LONGEST_WORD`` characters without ASCII white space, as in
Chinese, units of a fixed stride would depend on what precedes them.  There a unit
starts at every character and has ``LONG_UNIT`` of them, so a k-mer of five has 20.

The fingerprint is the ``SKETCH`` smallest of the anchors' hashes, in hexadecimal; the
likeness of two fingerprints is the share of common ones among the smallest of both, an
estimate of the Jaccard similarity of the anchor sets.

Cases: null and empty texts, and blank ones, have an empty fingerprint, and two empty
fingerprints have likeness 1; a text of fewer than five units is one anchor as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import documents, written

UNIT = 4
LONGEST_WORD = 24
LONG_UNIT = 16
_FILLED = r"[^\x20\x09-\x0D]"
SKETCH = 64


def with_pairs(df: DataFrame, column: str, name: str) -> DataFrame:
    """``df`` with the hashes of the inner substrings: of each unit with the next one.

    The hashes of the units are a projection of their own: they are used several times.
    """
    text = F.coalesce(F.col(column), F.lit(""))

    def found(part: Column, pattern: str, group: int = 0) -> Column:
        return F.regexp_extract_all(part, F.lit(pattern), F.lit(group))

    def of_run(run: Column) -> Column:
        at_each = found(run, rf"(?=({_FILLED}{{1,{LONG_UNIT}}})){_FILLED}", 1)
        return F.when(F.length(run) > LONGEST_WORD, at_each).otherwise(found(run, rf"{_FILLED}{{1,{UNIT}}}"))

    has_long = text.rlike(rf"{_FILLED}{{{LONGEST_WORD + 1}}}")
    units = F.when(has_long, F.flatten(F.transform(found(text, rf"{_FILLED}+"), of_run))).otherwise(
        found(text, rf"{_FILLED}{{1,{UNIT}}}")
    )
    hashes = F.col("__units")
    # With one unit the pair is the unit itself, so that such a text has something to hash.
    pairs = F.when(F.size(hashes) < 2, hashes).otherwise(
        F.zip_with(
            F.slice(hashes, 1, F.greatest(F.size(hashes) - 1, F.lit(1))),
            F.slice(hashes, 2, F.greatest(F.size(hashes) - 1, F.lit(1))),
            lambda a, b: F.xxhash64(a, b),
        )
    )
    hashed = df.withColumn("__units", F.transform(units, lambda u: F.xxhash64(u)))
    return hashed.withColumn(name, pairs).drop("__units")


def anchors(pairs: Column) -> Column:
    """``at, hash`` of each closed syncmer of an array of inner hashes."""

    def at(i: Column, n: int) -> Column:
        return F.get(pairs, i + n)

    def anchor(first: Column, i: Column) -> Column:
        edge, inside = F.least(first, at(i, 3)), F.least(at(i, 1), at(i, 2))
        made = F.struct(i.alias("at"), F.xxhash64(first, at(i, 2), at(i, 3)).alias("hash"))
        return F.when(edge <= inside, made)

    joined = F.array_join(F.transform(pairs, lambda x: x.cast("string")), " ")
    whole = F.array(F.struct(F.lit(0).alias("at"), F.xxhash64(joined).alias("hash")))
    none = F.slice(whole, 1, 0)
    starts = F.slice(pairs, F.lit(1), F.size(pairs) - 3)
    chosen = F.filter(F.transform(starts, anchor), lambda x: x.isNotNull())
    return F.when(F.size(pairs) >= 4, chosen).when(F.size(pairs) > 0, whole).otherwise(none)


def sketch(found: Column) -> Column:
    """The smallest 32-bit hashes of anchors, in order."""
    hashes = F.transform(found, lambda x: F.shiftrightunsigned(x["hash"], 32))
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, SKETCH)


def text_of(sketched: Column) -> Column:
    return F.array_join(F.transform(sketched, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of the smallest hashes of both that both have, from 0 to 1."""
    smallest = F.slice(F.sort_array(F.array_union(a, b)), 1, SKETCH)
    common = F.size(F.array_intersect(F.array_intersect(smallest, a), b))
    return F.when(F.size(smallest) == 0, 1.0).otherwise(common / F.size(smallest)).cast("double")


def fingerprinted(df: DataFrame, column: str, name: str) -> DataFrame:
    """``df`` with the sketch of a text column; each step is a projection of its own, so it is computed once."""
    return (
        with_pairs(df, column, "__pairs")
        .withColumn("__anchors", anchors(F.col("__pairs")))
        .withColumn(name, sketch(F.col("__anchors")))
        .drop("__pairs", "__anchors")
    )


def neighbours(docs: DataFrame) -> DataFrame:
    """``doc_id, copy, before_id, before_copy, before_chars``: whose next document each one is.

    Documents are in descending doc_id, then by the hash of their text, rows without
    doc_id last; the first follows the last.  Rows that share doc_id and text are one.
    The order is made by range partitions of narrow rows; only the last row of each
    partition meets the others.
    """
    order = [F.desc_nulls_last("doc_id"), F.asc("copy")]
    ranged = docs.groupBy("doc_id", "copy").agg(F.max("n_chars").alias("n_chars")).repartitionByRange(*order)
    keys = written(ranged.withColumn("part", F.spark_partition_id()), "ordered")
    row = F.struct("doc_id", "copy", "n_chars")
    inside = Window.partitionBy("part").orderBy(*order)
    lagged = keys.withColumn("before", F.lag(row).over(inside)).withColumn("n", F.row_number().over(inside))
    backwards = Window.partitionBy("part").orderBy(F.asc_nulls_first("doc_id"), F.desc("copy"))
    ends = written(
        keys.withColumn("back", F.row_number().over(backwards))
        .where("back = 1")
        .select("part", row.alias("last")),
        "ends",
    )
    by_part = Window.orderBy("part")  # one row per range partition
    all_parts = by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    joints = ends.select("part", F.coalesce(F.lag("last").over(by_part), F.last("last").over(all_parts)).alias("joint"))
    linked = lagged.join(F.broadcast(joints), "part").withColumn(
        "before", F.when(F.col("n") == 1, F.col("joint")).otherwise(F.col("before"))
    )
    return linked.select(
        "doc_id",
        "copy",
        F.col("before.doc_id").alias("before_id"),
        F.col("before.copy").alias("before_copy"),
        F.col("before.n_chars").alias("before_chars"),
    )


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Each document with its fingerprint, that of its edited text, and their likenesses.

    The edited text has the last third replaced by the start of the next document.
    """
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("copy", F.xxhash64("text"))
    chain = written(neighbours(keyed.select("doc_id", "copy", F.length("text").alias("n_chars"))), "chain")
    same = keyed["doc_id"].eqNullSafe(chain["doc_id"]) & (keyed["copy"] == chain["copy"])
    placed = keyed.join(chain, same).select(
        keyed["doc_id"], keyed["copy"], "text", "before_id", "before_copy", F.expr("before_chars div 3").alias("wanted")
    )
    given = fingerprinted(placed, "text", "next_sketch").select(
        "before_id", "before_copy", F.expr("substring(text, 1, wanted)").alias("start"), "next_sketch"
    )
    given = given.dropDuplicates(["before_id", "before_copy"])
    both = placed.select("doc_id", "copy", "text").join(
        given, F.col("doc_id").eqNullSafe(F.col("before_id")) & (F.col("copy") == F.col("before_copy"))
    )
    edited = both.withColumn("n_chars", F.length("text").cast("long")).withColumn(
        "edited", F.concat(F.expr("substring(text, 1, n_chars - n_chars div 3)"), F.col("start"))
    )
    done = fingerprinted(fingerprinted(edited, "text", "own_sketch"), "edited", "edited_sketch")
    return done.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        text_of(F.col("own_sketch")).alias("fingerprint"),
        text_of(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("own_sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("own_sketch"), F.col("next_sketch")).alias("near_next"),
    )


def op9_syncmer_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return edited_fingerprints(documents(spark, folder))
