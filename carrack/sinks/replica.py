"""A replica table of plain Parquet, in buckets by key, changed by copying the buckets it touches.

    data/__part=<part>/__bucket=<bucket>/[<partition columns>/]   rows, written once
    current/<version>.json                                        the pointer

A bucket is a range of key hashes, and the rows of a file are in the order of their hash
unless ``cluster_by`` says otherwise.  New rows are a new part.  Where they replace older
rows, the buckets that hold those are written again without them, and the old copies are
left out of the next pointer.  A pointer names the live parts and, for each, the buckets
that later parts replace; moving the next one into place shows a change in one step.
Of two writers one fails with ``FileExistsError``.  Files that no pointer names are
never read, and go with ``vacuum``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import storage
from ..functions.partitions import coded, decoded_columns, stored_columns, stored_name
from ..operators import sizing

PART = "__part"
BUCKET = "__bucket"
HASH = "__hash"
#: Rows of a bucket, about; twice as many, and buckets are halved.
BUCKET_ROWS = 1 << 20
#: Parts that are left alone; beyond them all but the largest are merged.
MOST_PARTS = 16
#: Keys that are looked up by literals in the plan, and ranges of their hashes there.
LOOKUP_KEYS = 10_000
LOOKUP_RANGES = 256
#: Small pages let a look-up skip most of a bucket; the filter serves conditions on the key itself.
PAGE_ROWS = 1000


@dataclass(frozen=True)
class State:
    """What a pointer says.  ``parts`` has the live rows of each part, ``replaced`` its buckets that later parts hold."""

    version: int
    schema: T.StructType
    key: str | None
    bits: int
    partition_by: tuple[str, ...]
    derived: dict[str, str]
    cluster_by: tuple[str, ...]
    parts: dict[str, int]
    replaced: dict[str, list[int]]
    streams: dict[str, int]
    marks: dict[str, list[int]]

    def to_json(self) -> str:
        return json.dumps({**self.__dict__, "schema": self.schema.jsonValue()})

    @classmethod
    def from_json(cls, text: str) -> State:
        raw = json.loads(text)
        names = {n: tuple(raw[n]) for n in ("partition_by", "cluster_by")}
        return cls(**{**raw, **names, "schema": T.StructType.fromJson(raw["schema"])})


class Replica:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    @classmethod
    def create(
        cls,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        key: str | None = None,
        partition_by: Sequence[str] | Mapping[str, str] = (),
        cluster_by: Sequence[str] = (),
        expected_rows: int = 0,
    ) -> Replica:
        """Drop what is at ``path`` and create an empty table.

        ``partition_by`` names columns, or maps new column names to SQL expressions
        that are computed on every change.  ``cluster_by`` orders the rows inside each
        file, so that scans can skip row groups.  ``expected_rows`` saves a large
        first load from being written again in smaller buckets.
        """
        table = cls(spark, path)
        table.drop()
        derived = dict(partition_by) if isinstance(partition_by, Mapping) else {}
        empty = spark.createDataFrame([], schema)
        full = empty.select("*", *[F.expr(text).alias(name) for name, text in derived.items()]).schema
        bits = _bits(expected_rows) if key else 0
        table._point(State(0, full, key, bits, tuple(partition_by), derived, tuple(cluster_by), {}, {}, {}, {}))
        return table

    def drop(self) -> None:
        storage.delete(self.spark, self.path)

    def exists(self) -> bool:
        return storage.is_dir(self.spark, f"{self.path}/current")

    def state(self) -> State:
        pointers = [e.name for e in storage.list_dir(self.spark, f"{self.path}/current") if e.name.endswith(".json")]
        return State.from_json(storage.read_text(self.spark, f"{self.path}/current/{max(pointers)}"))

    def read(self) -> DataFrame:
        """The live rows, as a scan that leaves replaced buckets out; no job runs."""
        return self._columns(self._live(self.state()))

    def holding(self, keys: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
        """Live rows with a key of ``keys``, a frame of one column, for which only what may hold one is read.

        ``keys`` must be cheap to read more than once.  Up to ``LOOKUP_KEYS`` keys go into
        the plan: their buckets are pruned by folder, and pages by at most
        ``LOOKUP_RANGES`` ranges of their hashes, so what is read goes with the number of
        keys, not of rows.  A larger set of keys only prunes buckets.  A column that is not the key of the replica
        is looked up by its range.
        """
        state, [name] = self.state(), keys.columns
        if name != state.key:
            keys = keys.where(F.col(_quoted(name)).isNotNull())
            found = sizing.cut_to_keys(self.read(), keys, name, sizing.key_span(keys))
        else:
            found = self._holding(state, keys.toDF("__wanted").where("__wanted IS NOT NULL"))
        return found.select(*[_quoted(name) for name in columns or state.schema.names])

    def publish(
        self,
        rows: DataFrame,
        gone: Callable[[DataFrame], DataFrame | None] | None = None,
        stream: tuple[str, int] | None = None,
        marks: Mapping[str, Sequence[int]] | None = None,
    ) -> DataFrame:
        """Add ``rows`` in one visible step; returns them as written.

        ``gone`` gets the written rows and gives the keys whose older rows they
        replace, so the source is read only once.  No rows change nothing, unless the
        position of a stream has to be kept.  ``stream`` is a stream's name and batch
        number; publishing the same batch again changes nothing.  ``marks`` are kept in
        the pointer for the next change to look up.
        """
        state = self.state()
        if stream and state.streams.get(stream[0], -1) >= stream[1]:
            return self.spark.createDataFrame([], state.schema)
        added, copied = uuid.uuid4().hex, uuid.uuid4().hex
        try:
            n_rows = self._write(rows, state, added)
            if stream is None and not n_rows:
                self._remove(added)
                return self.spark.createDataFrame([], state.schema)
            written = self._columns(self._rows(state, [added]))
            keys = gone(written) if gone else None
            parts, replaced = {**state.parts, added: n_rows}, dict(state.replaced)
            touched = [] if keys is None else self._copy_without(state, keys, copied, parts)
            if touched:
                replaced |= {part: sorted({*replaced.get(part, []), *touched}) for part in state.parts}
            parts = {part: n for part, n in parts.items() if n}
            self._point(
                replace(
                    state,
                    version=state.version + 1,
                    parts=parts,
                    replaced={part: buckets for part, buckets in replaced.items() if part in parts},
                    streams={**state.streams, **({stream[0]: stream[1]} if stream else {})},
                    marks={**state.marks, **{name: list(mark) for name, mark in (marks or {}).items()}},
                )
            )
        except BaseException:
            self._remove_unless_named(added, copied)
            raise
        return written

    def tidy(self) -> None:
        """Halve buckets that have grown too large; merge small parts where there are many."""
        state = self.state()
        n_rows = sum(state.parts.values())
        if state.key and n_rows > 2 * BUCKET_ROWS << state.bits:
            self._merge(state, list(state.parts), _bits(n_rows))
        elif len(state.parts) > MOST_PARTS:
            largest = max(state.parts, key=state.parts.get)
            small = [part for part in state.parts if part != largest]
            all_of_them = 2 * sum(state.parts[part] for part in small) > state.parts[largest]
            self._merge(state, list(state.parts) if all_of_them else small, state.bits)

    def compact(self) -> None:
        """Write the live rows as one part."""
        state = self.state()
        if state.parts:
            self._merge(state, list(state.parts), state.bits)

    def vacuum(self) -> None:
        """Remove the files that the pointer does not name.  Run it when no one reads an older state."""
        live = {f"{PART}={part}" for part in self.state().parts}
        for entry in storage.list_dir(self.spark, f"{self.path}/data") if self.state().parts else []:
            if entry.name.startswith(PART) and entry.name not in live:
                storage.delete(self.spark, f"{self.path}/data/{entry.name}")

    def _copy_without(self, state: State, keys: DataFrame, part: str, parts: dict[str, int]) -> list[int]:
        """Write the buckets that hold any of ``keys`` again without them, as a part; the buckets."""
        keys, n_bytes = sizing.settled(keys.toDF("__wanted").where("__wanted IS NOT NULL").distinct())
        held = self._holding(state, keys).select(BUCKET).distinct()
        touched = sorted(r[BUCKET] for r in held.collect())  # at most one row per bucket
        if touched:
            keys = F.broadcast(keys) if n_bytes <= sizing.BROADCAST_BYTES else keys
            live = self._live(state).where(F.col(BUCKET).isin(touched))
            for row in live.groupBy(PART).count().collect():  # one row per part, from the footers
                parts[row[PART]] -= row["count"]
            kept = live.join(keys, F.col(_quoted(state.key)) == F.col("__wanted"), "left_anti")
            parts[part] = self._write(kept, state, part)
        return touched

    def _merge(self, state: State, merged: list[str], bits: int) -> None:
        part, rest = uuid.uuid4().hex, [p for p in state.parts if p not in merged]
        new = replace(state, version=state.version + 1, bits=bits)
        try:
            n_rows = self._write(self._live(state, merged), new, part)
            parts = {**{p: state.parts[p] for p in rest}, **({part: n_rows} if n_rows else {})}
            self._point(replace(new, parts=parts, replaced={p: b for p, b in state.replaced.items() if p in rest}))
        except BaseException:
            self._remove_unless_named(part)
            raise

    def _holding(self, state: State, keys: DataFrame) -> DataFrame:
        """Live rows with their bucket whose key is in ``keys`` (``__wanted``)."""
        live = self._live(state)
        key = F.col("__wanted").cast(state.schema[state.key].dataType)
        hashes = keys.select(F.xxhash64(key).alias("h")).distinct()
        some = [r["h"] for r in hashes.limit(LOOKUP_KEYS + 1).collect()]
        if len(some) <= LOOKUP_KEYS:
            buckets = {_bucket_of(h, state.bits) for h in some}
            live = live.where(F.col(BUCKET).isin(sorted(buckets))).where(F.expr(_any_range(_ranges(some))))
            keys = F.broadcast(keys)  # not many more than their hashes
        else:
            buckets = hashes.select(_bucket(F.col("h"), state.bits).alias("b")).distinct()
            live = live.where(F.col(BUCKET).isin([r["b"] for r in buckets.collect()]))
            keys = sizing.broadcast_if_small(keys)
        return live.join(keys, F.col(_quoted(state.key)) == key, "left_semi")

    def _live(self, state: State, parts: Sequence[str] | None = None) -> DataFrame:
        parts = list(state.parts if parts is None else parts)
        rows = self._rows(state, parts)
        for part in parts:
            if state.replaced.get(part):
                rows = rows.where(~((F.col(PART) == part) & F.col(BUCKET).isin(state.replaced[part])))
        return rows

    def _rows(self, state: State, parts: Sequence[str]) -> DataFrame:
        """All rows of ``parts`` with part, bucket and hash; text in partition columns is decoded."""
        extra = [T.StructField(HASH, T.LongType()), T.StructField(PART, T.StringType()), T.StructField(BUCKET, T.IntegerType())]
        if not parts:
            return self.spark.createDataFrame([], T.StructType([*state.schema.fields, *extra]))
        base = f"{self.path}/data"
        paths = [f"{base}/{PART}={part}" for part in parts if storage.exists(self.spark, f"{base}/{PART}={part}")]
        schema = T.StructType([*stored_columns(state.schema, state.partition_by), *extra])
        stored = self.spark.read.schema(schema).option("basePath", base).parquet(*paths)
        return stored.select(*decoded_columns(state.schema, state.partition_by), HASH, PART, BUCKET)

    def _columns(self, rows: DataFrame) -> DataFrame:
        return rows.drop(HASH, PART, BUCKET)

    def _write(self, rows: DataFrame, state: State, part: str) -> int:
        """Write the rows of a part; how many there are is counted while they are written."""
        given, seen, names = set(rows.columns), Observation(), [f.name for f in state.schema.fields]
        columns = [
            (F.expr(state.derived[f.name]) if f.name in state.derived and f.name not in given else F.col(_quoted(f.name)))
            .cast(f.dataType)
            .alias(f.name)
            for f in state.schema.fields
        ]
        every = F.xxhash64(*[F.col(_quoted(f.name)) for f in state.schema.fields if not isinstance(f.dataType, T.MapType)])
        # Rows without a key are never looked up; they spread over all buckets.
        hashed = F.when(F.col(_quoted(state.key)).isNotNull(), F.xxhash64(_quoted(state.key))).otherwise(every) if state.key else every
        rows = rows.select(*columns).withColumn(HASH, hashed)
        rows = rows.withColumn(BUCKET, _bucket(F.col(HASH), state.bits))
        # A single bucket is no key to deal rows by: that would be one task.
        folders = [*([BUCKET] if state.bits else []), *state.partition_by]
        rows = rows.hint("rebalance", *[F.col(_quoted(n)) for n in folders])
        renamed = [stored_name(n, state.schema, state.partition_by) for n in state.partition_by]
        rows = rows.select(*coded(state.schema, state.partition_by), HASH, BUCKET)
        inside = [stored_name(n, state.schema, state.partition_by) for n in state.cluster_by] or [HASH]
        # The writer needs its folder columns as the leading order.
        rows = rows.sortWithinPartitions(*[F.col(_quoted(n)) for n in (BUCKET, *renamed, *inside)])
        # Counted last: above the shuffle, whose empty result would take a count below it away.
        rows = rows.observe(seen, F.count(F.lit(1)).alias("n"))
        writer = rows.write.partitionBy(BUCKET, *renamed).option("parquet.page.row.count.limit", PAGE_ROWS)
        if state.key and state.key in names and state.key not in state.partition_by:
            writer = writer.option(f"parquet.bloom.filter.enabled#{state.key}", "true")
            writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")  # sized by the keys of the file
        writer.parquet(f"{self.path}/data/{PART}={part}")
        return seen.get["n"]

    def _point(self, state: State) -> None:
        """Move the next pointer into place; one before it stays for readers that have just seen it."""
        storage.make_dir(self.spark, f"{self.path}/current")
        storage.write_text(self.spark, self._pointer(state.version), state.to_json())
        if state.version > 1:
            storage.delete_quietly(self.spark, self._pointer(state.version - 2))

    def _pointer(self, version: int) -> str:
        return f"{self.path}/current/{version:012d}.json"

    def _remove(self, part: str) -> None:
        storage.delete(self.spark, f"{self.path}/data/{PART}={part}")

    def _remove_unless_named(self, *parts: str) -> None:
        """Clean up after a failed change, unless its pointer is in place."""
        live = self.state().parts
        if not any(part in live for part in parts):
            for part in parts:
                self._remove(part)


def _ranges(hashes: list[int]) -> list[tuple[int, int]]:
    """At most ``LOOKUP_RANGES`` ranges that hold all hashes, cut where the gaps are widest."""
    hashes = sorted(hashes)
    gaps = sorted(range(1, len(hashes)), key=lambda n: hashes[n] - hashes[n - 1])[-(LOOKUP_RANGES - 1) :]
    cuts = [0, *sorted(gaps), len(hashes)]
    return [(hashes[a], hashes[b - 1]) for a, b in zip(cuts, cuts[1:]) if a < b]


def _any_range(ranges: list[tuple[int, int]]) -> str:
    """Whether the hash is in one of them, as a balanced tree; Parquet's page index takes ranges, but no sets."""
    if not ranges:
        return "false"
    if len(ranges) == 1:
        low, high = ranges[0]
        return f"(`{HASH}` >= {low}L AND `{HASH}` <= {high}L)"
    half = len(ranges) // 2
    return f"({_any_range(ranges[:half])} OR {_any_range(ranges[half:])})"


def _bits(n_rows: int) -> int:
    return max(0, (max(1, n_rows) - 1) // BUCKET_ROWS).bit_length()


def _bucket(hashed: Column, bits: int) -> Column:
    """The first bits of a hash, so that a bucket is a range of hashes."""
    return F.shiftrightunsigned(hashed, 64 - bits).cast("int") if bits else F.lit(0)


def _bucket_of(hashed: int, bits: int) -> int:
    return (hashed & (1 << 64) - 1) >> 64 - bits


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
