"""Centroid clustering over a VA-file: cells of few bits decide, full vectors are fetched where they cannot.

Components are turned into whole numbers, so every distance and centroid is exact.

1. Each dimension is cut into ``2**bits`` cells of equal width between its least and
   greatest value.  A row of the file has the packed cells of a vector beside the vector
   itself; Parquet reads the cells without the vectors.
2. In a round, look-up tables by dimension and cell give an interval for the distance
   to each centroid.  Where intervals overlap, what two distances have in common is taken
   out: inside a cell their difference is linear, so it is bounded more narrowly.
3. Sums of clusters are carried from round to round.  A vector whose cells give the same
   cluster for the last centroids and the new ones changes nothing and is not read.  All
   others are fetched, and those that moved are taken from one sum and added to the other.
4. The file is partitioned by how near a vector was to a second centroid at first.  Only
   folders that hold vectors to fetch are read, and the keys to fetch are broadcast within
   a measured bound; beyond it the file is read through, without a shuffle.

A round moves a sum per task, cluster and dimension.  No vector is shuffled.

Cases: vectors that are null, have another length, or hold null or non-finite numbers are
left out; equal vectors are vectors of their own, and equal distances go to the smaller
number; rows without vec_id are clustered, and start a centroid only after all others;
with fewer vectors than centroids there are fewer centroids, with none an empty table.
Numbers over ``LARGEST`` after scaling raise an error, since distances would not fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import sizing
from ..session import scratch_path
from .tables import map_batches, written

CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
LENGTH = 64
SEED = 3
BITS = 8
LEVELS = 8
LARGEST = 1 << 27


def whole_numbers(batch: pa.RecordBatch, length: int, scale: int) -> tuple[np.ndarray, pa.Array]:
    """The usable vectors of a batch as int32 rows, and the vec_id of each."""
    column = batch.column("embedding")
    fits = pc.equal(pc.list_value_length(column), length).fill_null(False)
    given = column.filter(fits).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, length)
    finite = np.isfinite(given).all(1)
    with np.errstate(over="ignore"):
        whole = np.floor(scale * given[finite])
    if len(whole) and np.abs(whole).max() > LARGEST:
        raise ValueError("a component is too large for exact distances in a long")
    return whole.astype("<i4"), batch.column("vec_id").filter(fits).filter(pa.array(finite))


def _rows(raw: pa.Array, length: int) -> np.ndarray:
    return np.frombuffer(b"".join(raw.to_pylist()), "<i4").reshape(-1, length)


def distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of every vector to every centroid."""
    wide = vectors.astype(np.int64)
    return np.stack([((wide - c) ** 2).sum(1) for c in centroids], 1)


class Cells:
    """The grid of a VA-file: cells of equal width in each dimension."""

    def __init__(self, least: np.ndarray, greatest: np.ndarray, bits: int):
        self.bits = bits
        self.least = least
        self.width = -(-(greatest - least + 1) // (1 << bits))

    def pack(self, vectors: np.ndarray) -> list[bytes]:
        cell = ((vectors - self.least) // self.width).astype(np.uint8)
        bits = np.unpackbits(cell[:, :, None], axis=2)[:, :, 8 - self.bits :]
        return [row.tobytes() for row in np.packbits(bits.reshape(len(cell), -1), axis=1)]

    def unpack(self, packed: list[bytes]) -> np.ndarray:
        size = len(self.least) * self.bits
        rows = np.frombuffer(b"".join(packed), np.uint8).reshape(len(packed), -1)
        bits = np.unpackbits(rows, axis=1, count=size).reshape(len(packed), -1, self.bits)
        return np.packbits(bits, axis=2)[:, :, 0] >> (8 - self.bits)

    def tables(self, centroids: np.ndarray) -> Tables:
        return Tables(self, centroids)


class Tables:
    """Look-up tables by dimension and cell for one set of centroids."""

    def __init__(self, cells: Cells, centroids: np.ndarray):
        low = (cells.least[:, None] + np.arange(1 << cells.bits) * cells.width[:, None])[:, :, None]
        high = low + cells.width[:, None, None] - 1
        c = centroids.T[:, None, :]
        at_low, at_high = (low - c) ** 2, (high - c) ** 2
        self.farthest = np.maximum(at_low, at_high)
        self.nearest = np.where((low <= c) & (c <= high), 0, np.minimum(at_low, at_high))
        self.corner = at_low
        self.centroids = centroids
        self.reach = cells.width - 1

    def decided(self, cell: np.ndarray) -> np.ndarray:
        """The cluster of each row of cells, or -1 if only the vector can tell."""
        near, far = self._sums(self.nearest, cell), self._sums(self.farthest, cell)
        best = far.argmin(1)
        # Of equal distances the smaller number wins.
        spare = near - far[np.arange(len(cell)), best][:, None]
        found = np.where(_all_beyond(spare, best), best, -1)
        left = np.flatnonzero(found < 0)
        if len(left):
            corner = self._sums(self.corner, cell[left])
            best = (corner - self.centroids @ self.reach).argmin(1)
            # d_c - d_b at the corner, and the most that it can fall inside the cell.
            apart = self.centroids[best][:, None, :] - self.centroids[None]
            fall = np.minimum(0, 2 * apart * self.reach).sum(2)
            spare = corner - corner[np.arange(len(left)), best][:, None] + fall
            found[left] = np.where(_all_beyond(spare, best), best, -1)
        return found

    @staticmethod
    def _sums(table: np.ndarray, cell: np.ndarray) -> np.ndarray:
        total = np.zeros((len(cell), table.shape[2]), np.int64)
        for n in range(cell.shape[1]):
            total += table[n][cell[:, n]]
        return total


def _all_beyond(spare: np.ndarray, best: np.ndarray) -> np.ndarray:
    """Whether all other centroids are surely farther, or as far with a larger number."""
    number = np.arange(spare.shape[1])
    beyond = np.where(number < best[:, None], spare > 0, spare >= 0)
    beyond[np.arange(len(best)), best] = True
    return beyond.all(1)


def _usable(df: DataFrame, length: int, scale: int) -> DataFrame:
    """``vec_id, vector``: the vectors that take part, their whole numbers as bytes."""

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        whole, ids = whole_numbers(batch, length, scale)
        yield {"vec_id": ids, "vector": [row.tobytes() for row in whole]}

    return map_batches(df.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding"), work, "vec_id long, vector binary")


def _first_centroids(vectors: DataFrame, clusters: int, length: int, seed: int) -> np.ndarray:
    """The vectors that come first by the hash of their vec_id; ``clusters`` rows reach the driver."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.orderBy(mark.asc_nulls_last(), "vector").limit(clusters).select("vector").collect()
    return np.array([np.frombuffer(r["vector"], "<i4") for r in first], np.int64).reshape(-1, length)


def _grid(vectors: DataFrame, length: int, bits: int) -> Cells:
    """The extremes of every dimension, ``length`` rows on the driver."""

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        rows = _rows(batch.column("vector"), length)
        if len(rows):
            yield {"n": np.arange(length), "low": rows.min(0), "high": rows.max(0)}

    found = map_batches(vectors, work, "n int, low int, high int").groupBy("n").agg(F.min("low"), F.max("high"))
    ends = np.array(sorted(tuple(r) for r in found.collect()), np.int64)
    return Cells(ends[:, 1], ends[:, 2], bits)


def _written_file(vectors: DataFrame, grid: Cells, first: np.ndarray) -> DataFrame:
    """``key, cells, vec_id, vector, level``: the VA-file, in folders by level."""
    length = first.shape[1]

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        rows = _rows(batch.column("vector"), length)
        if not len(rows):
            return
        level = np.zeros(len(rows), np.int32)
        if len(first) > 1:
            two = np.partition(distances(rows, first), 1, axis=1)[:, :2].astype(np.float64)
            ratio = two.sum(1) / np.maximum(two[:, 1] - two[:, 0], 1)
            level = np.clip(np.log2(np.maximum(ratio, 1)), 0, LEVELS - 1).astype(np.int32)
        yield {n: batch.column(n) for n in ("vec_id", "vector")} | {"cells": grid.pack(rows), "level": level}

    packed = map_batches(vectors, work, "vec_id long, vector binary, cells binary, level int")
    packed = packed.withColumn("key", F.monotonically_increasing_id())
    path = scratch_path(vectors.sparkSession, "vectors")
    packed.write.partitionBy("level").parquet(path)
    return vectors.sparkSession.read.schema(packed.schema).parquet(path)


def _moved_sums(file: DataFrame, grid: Cells, old: np.ndarray | None, new: np.ndarray) -> list[list[int]]:
    """What moves from cluster to cluster as centroids change: per cluster sums by dimension, and a count."""
    clusters, length = new.shape
    made: list[Tables] = []  # by the workers: the tables are large beside the centroids

    def moves(cells: pa.Array) -> np.ndarray:
        """Rows whose cells do not show that they stay where they are."""
        if not made:
            made.extend(grid.tables(c) for c in (old, new))
        cell = grid.unpack(cells.to_pylist())
        was, now = (tables.decided(cell) for tables in made)
        return (was < 0) | (was != now)

    def wanted(batch: pa.RecordBatch) -> Iterator[dict]:
        if batch.num_rows:
            fetch = pa.array(moves(batch.column("cells")))
            yield {n: batch.column(n).filter(fetch) for n in ("key", "level")}

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((clusters, length + 1), np.int64)
        for batch in batches:
            if "cells" in batch.schema.names and batch.num_rows and old is not None:
                batch = batch.filter(pa.array(moves(batch.column("cells"))))
            if not batch.num_rows:
                continue
            rows = _rows(batch.column("vector"), length)
            now = distances(rows, new).argmin(1)
            was = np.full(len(rows), -1) if old is None else distances(rows, old).argmin(1)
            counted = np.concatenate([rows, np.ones((len(rows), 1), "<i4")], 1).astype(np.int64)
            for k in range(clusters):
                total[k] += counted[(now == k) & (was != k)].sum(0) - counted[(was == k) & (now != k)].sum(0)
        k, n = np.nonzero(total)
        columns = {"k": pa.array(k, pa.int32()), "n": pa.array(n, pa.int32()), "total": pa.array(total[k, n])}
        yield pa.RecordBatch.from_pydict(columns)

    if old is None:
        rows = file.select("vector")
    else:
        keys, size = sizing.settled(map_batches(file.select("key", "level", "cells"), wanted, "key long, level int"))
        if size <= sizing.BROADCAST_BYTES:
            levels = [r["level"] for r in keys.select("level").distinct().collect()]  # LEVELS at most
            rows = file.where(F.col("level").isin(levels)).join(F.broadcast(keys.select("key")), "key", "left_semi")
            rows = rows.select("vector")
        else:
            rows = file.select("cells", "vector")
    sums = [[0] * (length + 1) for _ in range(clusters)]
    found = rows.mapInArrow(change, "k int, n int, total long").groupBy("k", "n")
    for r in found.agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect():
        sums[r["k"]][r["n"]] = int(r["total"])
    return sums


def clustered(
    df: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    length: int = LENGTH,
    scale: int = SCALE,
    seed: int = SEED,
    bits: int = BITS,
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` for the usable rows of ``vec_id, embedding``."""
    if not 1 <= bits <= 8:
        raise ValueError("cells have 1 to 8 bits")
    spark, schema = df.sparkSession, "vec_id long, cluster int, distance long"
    vectors = _usable(df, length, scale)
    centroids = _first_centroids(vectors, clusters, length, seed)
    if not len(centroids):
        return spark.createDataFrame([], schema + ", cluster_inertia long, inertia long, centroid_sha256 string")
    grid = _grid(vectors, length, bits)
    file = _written_file(vectors, grid, centroids)
    old, sums = None, [[0] * (length + 1) for _ in range(len(centroids))]
    for _ in range(rounds):
        moved = _moved_sums(file, grid, old, centroids)
        sums = [[a + b for a, b in zip(x, y)] for x, y in zip(sums, moved)]
        old = centroids
        means = [[v // s[-1] for v in s[:-1]] if s[-1] else list(c) for s, c in zip(sums, old)]
        centroids = np.array(means, np.int64)

    def assign(batch: pa.RecordBatch) -> Iterator[dict]:
        if not batch.num_rows:
            return
        apart = distances(_rows(batch.column("vector"), length), centroids)
        best = apart.argmin(1)
        yield {"vec_id": batch.column("vec_id"), "cluster": best, "distance": apart[np.arange(len(best)), best]}

    placed = written(map_batches(file.select("vec_id", "vector"), assign, schema), "clusters")
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    inertia = {r["cluster"]: int(r["total"]) for r in placed.groupBy("cluster").agg(total.alias("total")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    facts = [(k, v, sum(inertia.values()), digest[k]) for k, v in inertia.items()]
    told = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(told), "cluster").select(  # a row per cluster
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def op12_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return clustered(spark.read.parquet(f"{folder.rstrip('/')}/embeddings.parquet"))


def _round_sql(n: int) -> str:
    return f"""
near_{n} AS MATERIALIZED (
  SELECT row, arg_min(k, (distance, k)) AS k, min(distance) AS distance FROM (
    SELECT v.row, c.k, sum((v.x - c.x) * (v.x - c.x))::BIGINT AS distance
    FROM numbers v JOIN centroids_{n} c USING (n) GROUP BY v.row, c.k) GROUP BY row
), centroids_{n + 1} AS MATERIALIZED (
  SELECT c.k, c.n, coalesce(m.x, c.x) AS x FROM centroids_{n} c LEFT JOIN (
    SELECT k, n, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS x
    FROM numbers JOIN near_{n} USING (row) GROUP BY k, n) m USING (k, n)
),"""


#: The rounds one by one, over one row per number.
ORACLE = f"""
WITH vectors AS MATERIALIZED (
  SELECT vec_id, embedding, row_number() OVER () AS row FROM embeddings
  WHERE len(embedding) = {LENGTH} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), numbers AS MATERIALIZED (
  SELECT row, n, floor({SCALE}::DOUBLE * embedding[n]::DOUBLE)::BIGINT AS x FROM vectors, range(1, {LENGTH + 1}) t(n)
), first AS (
  SELECT row, row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1 AS k FROM vectors
  ORDER BY k LIMIT {CLUSTERS}
), centroids_0 AS MATERIALIZED (
  SELECT k, n, x FROM first JOIN numbers USING (row)
),{"".join(_round_sql(n) for n in range(ROUNDS))}{_round_sql(ROUNDS)}
digests AS (
  SELECT k, sha256(string_agg(x::VARCHAR, ',' ORDER BY n)) AS centroid_sha256 FROM centroids_{ROUNDS} GROUP BY k
)
SELECT vec_id, k::INTEGER AS cluster, distance, (sum(distance) OVER (PARTITION BY k))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM vectors JOIN near_{ROUNDS} USING (row) JOIN digests USING (k)
"""
