"""Embedding near-dedup by int8 tile products with rigorous error bounds.

Equal vectors are one node with a weight.  A node's unit vector u is stored as a scale
s and int8 numbers q; e = |u - s q| is computed, not estimated.  For two of them
|u.w - s s' (q.q')| <= e |s' q'| + e', so the integer product of two blocks tells for
nearly every pair on which side of the threshold it is.  Only the pairs in between are
computed again, in double precision from the given numbers.

Nodes are dealt into blocks of about ``BLOCK``, and every pair of blocks is one group.
A group returns a number of links per node and a spanning forest, never its pairs; the
work is quadratic in the number of distinct vectors, which the comparison of all with
all asks for, and spreads evenly over the pairs of blocks.

Cases: vectors that are null, empty or zero, or hold nulls or non-finite numbers, have
no links and stay; vectors of different lengths are never linked; rows that share a
vec_id are rows of their own, and rows without one never name a component of others;
an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components
from .tables import map_batches, ship_package, written

THRESHOLD = 0.9
BLOCK = 4096
#: Rows of a block that are multiplied at once with the whole other block.
STRIP = 256
#: Products of int8 numbers over so many dimensions are exact in single precision.
_EXACT = 1024
#: What double precision itself may be off by.
_SLACK = 1e-9


class Quantised:
    """Unit vectors, their int8 form and its error."""

    def __init__(self, vectors: np.ndarray):
        self.given = vectors.astype(np.float64)
        # Divided by the largest number first, so that squares of extreme ones stay finite.
        self.given /= np.abs(self.given).max(1, keepdims=True)
        self.norm = np.sqrt((self.given**2).sum(1))
        unit = self.given / self.norm[:, None]
        self.scale = np.abs(unit).max(1) / 127
        self.q = np.rint(unit / self.scale[:, None]).astype(np.int8)
        back = self.q * self.scale[:, None]
        self.error = np.sqrt(((unit - back) ** 2).sum(1)) + _SLACK
        self.length = np.sqrt((back**2).sum(1)) + _SLACK


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer products of int8 rows; each term fits single precision exactly."""
    total = a[:, :_EXACT].astype(np.float32) @ b[:, :_EXACT].astype(np.float32).T
    for at in range(_EXACT, a.shape[1], _EXACT):
        total = total.astype(np.float64)
        total += a[:, at : at + _EXACT].astype(np.float32) @ b[:, at : at + _EXACT].astype(np.float32).T
    return total


def linked_strip(a: Quantised, rows: np.ndarray, b: Quantised, threshold: float) -> np.ndarray:
    """Which rows of ``a`` are linked with which of ``b``; pairs near the threshold are computed exactly."""
    about = _product(a.q[rows], b.q) * b.scale.astype(np.float32)
    about *= a.scale[rows, None].astype(np.float32)
    slack = 1e-6  # the scaling in single precision
    widest = (a.error[rows] * b.length.max() + b.error.max() + slack).astype(np.float32)
    possible = about >= np.float32(threshold) - widest[:, None]
    linked = about >= np.float32(threshold) + widest[:, None]
    i, j = np.nonzero(possible & ~linked)
    for at in range(0, len(i), 1 << 16):
        x, y = rows[i[at : at + (1 << 16)]], j[at : at + (1 << 16)]
        cosine = (a.given[x] * b.given[y]).sum(1) / (a.norm[x] * b.norm[y])
        linked[i[at : at + (1 << 16)], y] = cosine >= threshold
    return linked


def tile(
    left: np.ndarray, right: np.ndarray | None, weight: np.ndarray, threshold: float
) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Weighted links per node of two blocks, or of one with itself, and a forest of positions."""
    a = Quantised(left)
    b = a if right is None else Quantised(right)
    shift = 0 if right is None else len(left)
    root = np.arange(len(weight))
    counts, forest = np.zeros(len(weight), np.int64), []
    for at in range(0, len(left), STRIP):
        rows = np.arange(at, min(len(left), at + STRIP))
        linked = linked_strip(a, rows, b, threshold)
        if right is None:
            linked[rows - at, rows] = False
        if not linked.any():
            continue
        counts[rows] += linked @ weight[shift : shift + linked.shape[1]]
        if right is not None:
            counts[shift:] += weight[rows] @ linked
        for n in np.flatnonzero(linked.any(1)):
            together = np.unique(np.append(root[np.flatnonzero(linked[n]) + shift], root[rows[n]]))
            if len(together) > 1:
                forest += [(int(x), int(together[0])) for x in together[1:]]
                root[np.isin(root, together)] = together[0]
    return counts, forest


def _usable(df: DataFrame) -> DataFrame:
    """``vec_id, raw, dim``: the numbers of a vector as bytes; null for vectors that link with nothing."""
    number = df.schema["embedding"].dataType.elementType
    kind = np.dtype("<f4" if isinstance(number, T.FloatType) else "<f8")

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        raw = []
        for value in batch.column("embedding").to_pylist():
            vector = np.array([np.nan if x is None else x for x in value or ()], kind)
            raw.append(vector.tobytes() if len(vector) and np.isfinite(vector).all() and vector.any() else None)
        dim = [len(x) // kind.itemsize if x else None for x in raw]
        yield {"vec_id": batch.column("vec_id"), "raw": raw, "dim": dim}

    return map_batches(df.select("vec_id", "embedding"), work, "vec_id long, raw binary, dim int")


def near_vectors(df: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row of ``vec_id, embedding``."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold is above 0 and at most 1")
    spark = df.sparkSession
    ship_package(spark)
    kind = "<f4" if isinstance(df.schema["embedding"].dataType.elementType, T.FloatType) else "<f8"
    given = written(_usable(df), "vectors")
    nodes = written(
        given.where("raw IS NOT NULL")
        .groupBy("raw")
        .agg(F.min("vec_id").alias("first_id"), F.count("*").alias("weight"), F.first("dim").alias("dim"))
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    blocks = max(1, -(-nodes.count() // block))
    dealt = nodes.select(
        "dim", "node", "weight", "raw", F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("int").alias("own")
    ).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    ends = F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi")
    pairs = dealt.select("dim", *ends, "own", "node", "weight", "raw")

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        dim, lo, hi = (k.as_py() for k in key)
        order = np.argsort(table.column("own").to_numpy(), kind="stable")
        node = table.column("node").to_numpy()[order]
        weight = table.column("weight").to_numpy()[order]
        joined = b"".join(x.as_py() for x in table.column("raw"))
        vectors = np.frombuffer(joined, kind).reshape(-1, dim)[order]
        n_left = int((table.column("own").to_numpy() == lo).sum())
        if lo == hi:
            counts, forest = tile(vectors, None, weight, threshold)
        elif 0 < n_left < len(node):
            counts, forest = tile(vectors[:n_left], vectors[n_left:], weight, threshold)
        else:
            counts, forest = np.zeros(len(node), np.int64), []
        some = np.flatnonzero(counts)
        ends = np.array(forest, np.int64).reshape(-1, 2)
        return pa.table(
            {
                "a": np.concatenate([node[some], node[ends[:, 0]]]),
                "b": np.concatenate([np.full(len(some), -1), node[ends[:, 1]]]),
                "n": np.concatenate([counts[some], np.zeros(len(ends), np.int64)]),
            }
        )

    tiles = pairs.repartition(blocks * (blocks + 1) // 2, "dim", "lo", "hi").groupBy("dim", "lo", "hi")
    found = written(tiles.applyInArrow(compare, "a long, b long, n long"), "tiles")
    counts = found.where("b = -1").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    reached = components(found.where("b >= 0").select("a", "b"))
    rooted = (
        nodes.drop("dim")
        .join(reached, "node", "left")
        .join(counts, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
        .select("raw", "weight", "first_id", "root", F.coalesce("n", F.lit(0)).alias("n"))
    )
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    links = (F.col("n") + F.col("weight") - 1).alias("n_links")
    judged = rooted.join(named, "root").select("raw", "component_id", links)
    alone = given.where("raw IS NULL").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
    )
    return (
        given.where("raw IS NOT NULL")
        .join(judged, "raw")
        .withColumn("kept", F.coalesce(F.expr("vec_id = component_id"), F.lit(False)))
        .select("vec_id", "n_links", "component_id", "kept")
        .union(alone)
    )


def op6_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{folder.rstrip('/')}/embeddings.parquet"))


ORACLE = """
WITH RECURSIVE usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM usable
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), named AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
counted AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM named LEFT JOIN counted USING (vec_id)
"""
