"""A filter for keys that two documents share, built as two bit maps.

Every task keeps one map of the bits that were set by a document and one of those set
by two.  Maps are merged by segment: a bit is "twice" if it is twice somewhere, or
once in two places.  The second map then has both bits of every key that two documents
hold, and few others.  Its size is ``2**log2_bits`` bits whatever the table: on tables
too large for it more keys pass, and the exact step behind it has more to do.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .tables import forget, release, ship_package, slices

LOG2_BITS = 26
LOG2_SEGMENT = 21
#: Bits that a task holds as a list before it makes maps.
SPARSE_BITS = 1 << 21
#: Maps of one segment that are merged in one step, about.
FAN_IN = 256
_SECOND = np.uint64(0x9E3779B97F4A7C15)


def _places(keys: np.ndarray, log2_bits: int) -> np.ndarray:
    """Two bit positions per 64-bit key."""
    shift = np.uint64(64 - log2_bits)
    return np.stack([keys >> shift, (keys * _SECOND) >> shift], 1).astype(np.int64)


def holds(bits: np.ndarray, keys: np.ndarray, log2_bits: int = LOG2_BITS) -> np.ndarray:
    """Which of the keys have both bits set."""
    at = _places(keys, log2_bits)
    return ((bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(1)


def twice_seen(
    df: DataFrame,
    keys_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]],
    log2_bits: int = LOG2_BITS,
    sparse_bits: int = SPARSE_BITS,
) -> np.ndarray:
    """The second map, packed.  ``keys_of`` gives one array of 64-bit keys per document.

    A task with up to ``sparse_bits`` bits passes them on as a list.
    """
    ship_package(df.sparkSession)
    log2_segment = min(LOG2_SEGMENT, log2_bits)
    segment_bytes = 1 << (log2_segment - 3)

    def row(segment: int, share: int, sparse: bool, once: np.ndarray, twice: np.ndarray) -> dict:
        return {
            "segment": pa.array([segment], pa.int32()),
            "share": pa.array([share], pa.int32()),
            "sparse": pa.array([sparse], pa.bool_()),
            "once": pa.array([zlib.compress(once.tobytes(), 1)], pa.binary()),
            "twice": pa.array([zlib.compress(twice.tobytes(), 1)], pa.binary()),
        }

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        share, held, size, maps = 0, [], 0, None
        for batch in batches:
            for part in slices(batch):
                for keys in keys_of(part):
                    if not len(keys):
                        continue
                    share ^= int(keys[0])
                    # A document sets its bits as a set: only another document makes them twice.
                    held.append(np.unique(_places(keys, log2_bits)))
                    size += len(held[-1])
                    if size > sparse_bits:  # from here on whole maps are smaller
                        maps = maps or (np.zeros(1 << log2_bits, np.bool_), np.zeros(1 << log2_bits, np.bool_))
                        for bits in held:
                            maps[1][bits[maps[0][bits]]] = True
                            maps[0][bits] = True
                        held, size = [], 0
            release()
        if maps is None and not held:
            return
        if maps is None:
            bits, times = np.unique(np.concatenate(held), return_counts=True)
            edges = np.searchsorted(bits, np.arange((1 << (log2_bits - log2_segment)) + 1) << log2_segment)
            for k in np.flatnonzero(np.diff(edges)).tolist():
                own, n = bits[edges[k] : edges[k + 1]] - (k << log2_segment), times[edges[k] : edges[k + 1]]
                found = own.astype(np.uint32), own[n > 1].astype(np.uint32)
                yield pa.RecordBatch.from_pydict(row(k, share % FAN_IN, True, *found))
            return
        for bits in held:
            maps[1][bits[maps[0][bits]]] = True
            maps[0][bits] = True
        for k in range(1 << (log2_bits - log2_segment)):
            part = slice(k << log2_segment, (k + 1) << log2_segment)
            yield pa.RecordBatch.from_pydict(row(k, share % FAN_IN, False, *(np.packbits(x[part]) for x in maps)))

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        once, twice = np.zeros(1 << log2_segment, np.bool_), np.zeros(1 << log2_segment, np.bool_)
        for sparse, a, b in zip(*(table.column(name) for name in ("sparse", "once", "twice"))):
            a, b = (zlib.decompress(x.as_py()) for x in (a, b))
            if sparse.as_py():
                more, again = np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)
                twice[again] = True
                twice[more[once[more]]] = True
                once[more] = True
            else:
                more, again = (np.unpackbits(np.frombuffer(x, np.uint8), count=len(once)).view(np.bool_) for x in (a, b))
                twice |= again | (once & more)
                once |= more
        return pa.table(row(key[0].as_py(), 0, False, np.packbits(once), np.packbits(twice)))

    schema = "segment int, share int, sparse boolean, once binary, twice binary"
    shares = df.mapInArrow(build, schema).groupBy("segment", "share").applyInArrow(merge, schema)
    whole = shares.groupBy("segment").applyInArrow(merge, schema).select("segment", "twice")
    filled = np.zeros(1 << (log2_bits - 3), np.uint8)
    for segment, twice in whole.toLocalIterator():  # 2^log2_bits / 8 bytes at most
        at = segment * segment_bytes
        filled[at : at + segment_bytes] = np.frombuffer(zlib.decompress(twice), np.uint8)
    return filled
