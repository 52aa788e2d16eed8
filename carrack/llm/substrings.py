"""Substring dedup: seed on winnowed anchors, extend both ways, keep maximal repeats.

A window of ``length`` words takes one seed of its ``SEED_WORDS``-grams as its anchor,
the one of the smallest hash (the leftmost of equal ones).  The choice depends on the
words of the window alone, so equal windows have equal anchors at equal places
(winnowing), and windows without a common anchor need not be compared.  Consecutive
windows with one anchor are a run: the anchor with its extension to the left and to the
right as far as it stays the anchor.

1. A Bloom filter (:mod:`.bloom`) tells which anchors occur in two documents; others go.
2. Runs are joined on the anchor.  Those that extend equally are one class, and all
   windows of a run are repeats if its class has a smaller document.
3. Where an anchor has several classes, the first run of each class is extended word by
   word: each placement of a whole window around the anchor is compared by its digest,
   again after a filter for those that two documents hold.
4. Covered windows that follow each other are merged to maximal repeats, the spans of
   at least ``length`` words that are removed.

No pairs of documents are made: classes and windows are aggregated to their smallest
document before anything is joined, and hot keys are pre-aggregated in the map tasks.
Digests have 128 bits.

Cases: null, empty and blank texts have no words; shorter texts than ``length`` lose
nothing; a window that is repeated in its own document only stays; rows with one doc_id
do not repeat each other; rows without doc_id lose nothing and take nothing from others.
An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bloom import LOG2_BITS, holds, twice_seen
from .tables import documents, extend_batches, map_batches, texts, written

LENGTH = 50
SEED_WORDS = 25
#: Odd bases of two polynomial hashes over words, modulo 2^64.
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(lane: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse, at least ``n`` of them."""
    if lane not in _powers or len(_powers[lane][0]) < n:
        size, base = max(n, 1 << 15), _BASES[lane]
        inverse = pow(base, -1, 1 << 64)
        tables = []
        for factor in (base, inverse):
            table = np.full(size, factor, np.uint64)
            table[0] = 1
            tables.append(np.multiply.accumulate(table))
        _powers[lane] = (tables[0], tables[1])
    return _powers[lane]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hashed:
    """The words of a document with hashes of any span in constant time."""

    def __init__(self, words: list[bytes]):
        values = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), "<u8").reshape(-1, 2)
        self.sums = []
        for lane in range(2):
            up, _ = _power(lane, len(words) + 1)
            total = np.zeros(len(words) + 1, np.uint64)
            np.cumsum(values[:, lane] * up[: len(words)], out=total[1:])
            self.sums.append(total)

    def span(self, lane: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        _, down = _power(lane, len(self.sums[lane]))
        return _mixed((self.sums[lane][end] - self.sums[lane][start]) * down[start])


def runs(hashed: Hashed, n_words: int, length: int, seed_words: int) -> tuple[np.ndarray, ...]:
    """Anchor digest, anchor place, first and last window of each run."""
    at = np.arange(n_words - seed_words + 1)
    value = hashed.span(0, at, at + seed_words)
    best, place, width = value, at, 1
    reach = length - seed_words + 1
    while width < reach:  # the smallest of 1, 2, 4, … seeds and then of all that a window has
        step = min(width, reach - width)
        later = best[step:] < best[:-step]
        best, place = np.where(later, best[step:], best[:-step]), np.where(later, place[step:], place[:-step])
        width += step
    first = np.flatnonzero(np.concatenate([[True], np.diff(place) != 0]))
    last = np.concatenate([first[1:] - 1, [len(place) - 1]])
    return value[place[first]], place[first], first, last


def _tables(length: int, seed_words: int, log2_bits: int):
    def of(text: bytes):
        words = text.split()
        if len(words) < length:
            return None
        hashed = Hashed(words)
        return hashed, *runs(hashed, len(words), length, seed_words)

    def keys_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for text in texts(batch):
            if found := of(text):
                yield found[1]

    def suspects(batch: pa.RecordBatch, bits: np.ndarray) -> Iterator[dict]:
        rows = []
        for n, text in enumerate(texts(batch)):
            if not (found := of(text)):
                continue
            hashed, anchor, place, first, last = found
            keep = np.flatnonzero(holds(bits, anchor, log2_bits))
            if len(keep):
                anchor, place, first, last = anchor[keep], place[keep], first[keep], last[keep]
                # The extension with its place around the anchor tells runs of one anchor apart.
                shape = _mixed(((place - first) * length + last - first).astype(np.uint64) + np.uint64(1))
                run = _mixed(hashed.span(1, first, last + length) ^ shape)
                rows.append((np.full(len(keep), n), anchor.view(np.int64), run.view(np.int64), first, last))
        if rows:
            row, anchor, run, first, last = map(np.concatenate, zip(*rows))
            yield {
                "doc_id": batch.column("doc_id").take(pa.array(row)),
                "__copy": batch.column("__copy").take(pa.array(row)),
                "anchor": anchor,
                "run": run,
                "first": first,
                "last": last,
            }

    def extended(batch: pa.RecordBatch) -> Iterator[dict]:
        """The windows of chosen runs with their digests."""
        rows = []
        for n, (text, spans) in enumerate(zip(texts(batch), batch.column("spans").to_pylist())):
            hashed = Hashed(text.split())
            start = np.concatenate([np.arange(s["first"], s["last"] + 1) for s in spans])
            left, right = (hashed.span(lane, start, start + length).view(np.int64) for lane in range(2))
            rows.append((np.full(len(start), n), left, right, start))
        if rows:
            row, left, right, start = map(np.concatenate, zip(*rows))
            yield {
                "doc_id": batch.column("doc_id").take(pa.array(row)),
                "__copy": batch.column("__copy").take(pa.array(row)),
                "w1": left,
                "w2": right,
                "first": start,
                "last": start,
            }

    return keys_of, suspects, extended


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows that share a doc_id but not their text are told apart by ``__copy``."""
    return docs.withColumn("__copy", F.xxhash64("text"))


def repeated_windows(
    docs: DataFrame, length: int = LENGTH, seed_words: int = SEED_WORDS, log2_bits: int = LOG2_BITS
) -> DataFrame:
    """``doc_id, __copy, spans``: first and last start of the windows that a smaller doc_id also holds."""
    if not 1 <= seed_words <= length:
        raise ValueError("a seed has at least one word and at most those of a window")
    keys_of, suspects, extended = _tables(length, seed_words, log2_bits)
    known = docs.select("doc_id", "text").where("doc_id IS NOT NULL")
    bits = docs.sparkSession.sparkContext.broadcast(twice_seen(known.select("text"), keys_of, log2_bits))

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        return suspects(batch, bits.value)

    span = "first int, last int"
    seeds = written(
        map_batches(_keyed(known), work, f"doc_id long, __copy long, anchor long, run long, {span}"), "seeds"
    )
    classes = written(
        seeds.groupBy("anchor", "run").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("latest")), "classes"
    )
    covered = (
        seeds.join(classes.where("owner < latest").drop("latest"), ["anchor", "run"])
        .where("doc_id > owner")
        .select("doc_id", "__copy", "first", "last")
    )
    several = classes.groupBy("anchor").agg(F.count("*").alias("n"), F.min("owner").alias("least")).where("n > 1")
    # A class whose owner is the least of all cannot be covered, but covers others: all owners are extended.
    owners = seeds.join(
        classes.join(several.select("anchor"), "anchor").select("anchor", "run", "owner"), ["anchor", "run"]
    ).where("doc_id = owner")
    chosen = owners.groupBy("doc_id", "__copy").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    windows = written(
        map_batches(
            _keyed(known).join(chosen, ["doc_id", "__copy"]), extended, f"doc_id long, __copy long, w1 long, w2 long, {span}"
        ),
        "windows",
    )
    shared = _held_twice(windows, log2_bits)
    earliest = (
        shared.groupBy("w1", "w2")
        .agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("latest"))
        .where("owner < latest")
        .drop("latest")
    )
    more = shared.join(earliest, ["w1", "w2"]).where("doc_id > owner").select("doc_id", "__copy", "first", "last")
    return covered.union(more).groupBy("doc_id", "__copy").agg(F.collect_set(F.struct("first", "last")).alias("spans"))


def _held_twice(windows: DataFrame, log2_bits: int) -> DataFrame:
    """The windows that may be in two documents; the others need no shuffle."""

    def keys_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        ids, keys = batch.column("doc_id").to_numpy(), batch.column("w1").to_numpy().view(np.uint64)
        yield from np.split(keys, np.flatnonzero(np.diff(ids)) + 1)

    bits = windows.sparkSession.sparkContext.broadcast(twice_seen(windows.select("doc_id", "w1"), keys_of, log2_bits))

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        hit = pa.array(holds(bits.value, batch.column("w1").to_numpy().view(np.uint64), log2_bits))
        yield dict(zip(batch.schema.names, batch.filter(hit).columns))

    return map_batches(windows, work, windows.schema)


def removed_words(n_words: int, spans: list[dict] | None, length: int) -> np.ndarray:
    """A flag for each word that a repeated window covers."""
    change = np.zeros(n_words + 1, np.int64)
    for s in spans or ():
        change[s["first"]] += 1
        change[s["last"] + length] -= 1
    return np.cumsum(change[:-1]) > 0


def drop_repeats(
    docs: DataFrame, length: int = LENGTH, seed_words: int = SEED_WORDS, log2_bits: int = LOG2_BITS
) -> DataFrame:
    """``docs`` with ``n_words, n_removed, repeats, kept_text``: every document without its repeated words.

    ``repeats`` holds the maximal repeats as first word and number of words.
    """

    def rewrite(batch: pa.RecordBatch) -> dict:
        out = {"n_words": [], "n_removed": [], "repeats": [], "kept_text": []}
        for text, spans in zip(texts(batch), batch.column("__spans").to_pylist()):
            words = text.split()
            gone = removed_words(len(words), spans, length)
            if gone.any():
                edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                repeats = [{"at": int(a), "n": int(b - a)} for a, b in zip(edge[::2], edge[1::2])]
                kept = [words[n] for n in np.flatnonzero(~gone)]
            else:
                repeats, kept = [], words
            out["n_words"].append(len(words))
            out["n_removed"].append(int(gone.sum()))
            out["repeats"].append(repeats)
            out["kept_text"].append(b" ".join(kept).decode("utf-8", "replace"))
        return out

    spans = repeated_windows(docs, length, seed_words, log2_bits).withColumnRenamed("spans", "__spans")
    joined = _keyed(docs).join(spans, ["doc_id", "__copy"], "left")
    added = "n_words long, n_removed long, repeats array<struct<at: int, n: int>>, kept_text string"
    return extend_batches(joined, rewrite, added, ("__copy", "__spans"))


def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return drop_repeats(documents(spark, folder)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


ORACLE = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), starts AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS s FROM split WHERE len(words) >= 50
), windows AS (
  SELECT doc_id, s, md5(array_to_string(words[s:s + 49], ' ')) AS w FROM starts
), firsts AS (
  SELECT w, min(doc_id) AS owner FROM windows GROUP BY w
), covered AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS n FROM windows JOIN firsts USING (w) WHERE doc_id > owner
), words AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS n FROM split
), kept AS (
  SELECT doc_id, count(*) AS n_words, count(c.n) AS n_removed,
         string_agg(word, ' ' ORDER BY w.n) FILTER (c.n IS NULL) AS kept
  FROM words w LEFT JOIN covered c USING (doc_id, n) GROUP BY doc_id
)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN kept USING (doc_id)
"""
