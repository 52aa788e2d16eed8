"""Line dedup: two Bloom filters find suspects, only suspects are shuffled.

:mod:`.bloom` gives a filter that holds the keys of lines that occur in two documents,
and few others.  Keys that are not in it are never shuffled.  Suspects go, as 128-bit
digests, to an exact count of documents and the choice of the document that keeps them;
the lines are then dropped in their documents.

Cases: a null or empty text is one empty line; lines of a document that occur twice
in it count once; rows with the same doc_id are one document for counting and are
each rewritten; rows without doc_id are rewritten against the keys of the others but
do not count.  Other columns are kept.
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
from .tables import BLANKS, documents, extend_batches, map_batches, texts, written


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The stripped, A-Z-lowered line; ``None`` if it has too few code points."""
    key = line.strip(BLANKS).lower()
    if len(key) < min_chars or not key.isascii() and len(key.decode("utf-8", "replace")) < min_chars:
        return None
    return key


def key_digest(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def _document_digests(text: bytes, min_chars: int) -> set[bytes]:
    return {key_digest(key) for line in text.split(b"\n") if (key := line_key(line, min_chars)) is not None}


def _filter_keys(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), "<u8")[::2]


def repeated_lines(
    docs: DataFrame, min_chars: int = 20, min_docs: int = 3, log2_bits: int = LOG2_BITS
) -> DataFrame:
    """``doc_id, digests``: for each document the keys whose lines it loses.

    A key found in ``min_docs`` documents or more (2 at least) stays only in the
    largest doc_id that holds it.
    """
    if min_docs < 2:
        raise ValueError("min_docs is 2 at least")

    def keys_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for text in texts(batch):
            yield _filter_keys(list(_document_digests(text, min_chars)))

    seen = docs.sparkSession.sparkContext.broadcast(twice_seen(docs.select("text"), keys_of, log2_bits))

    def suspects(batch: pa.RecordBatch) -> Iterator[dict]:
        ids, found = [], []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
            digests = list(_document_digests(text, min_chars))
            if doc_id is None or not digests:
                continue
            hit = np.flatnonzero(holds(seen.value, _filter_keys(digests), log2_bits))
            ids += [doc_id] * len(hit)
            found += [digests[n] for n in hit]
        if ids:
            yield {"doc_id": ids, "digest": found}

    suspected = written(map_batches(docs.select("doc_id", "text"), suspects, "doc_id long, digest binary"), "suspects")
    # Written, so that both sides of the join are shuffled for it and a hot line is split among tasks.
    repeated = written(
        suspected.groupBy("digest")
        .agg(F.countDistinct("doc_id").alias("n"), F.max("doc_id").alias("keeper"))
        .where(F.col("n") >= min_docs)
        .select("digest", "keeper"),
        "repeated",
    )
    return (
        suspected.join(repeated, "digest")
        .where(F.col("doc_id") != F.col("keeper"))
        .groupBy("doc_id")
        .agg(F.collect_set("digest").alias("digests"))
    )


def drop_repeated_lines(
    docs: DataFrame, min_chars: int = 20, min_docs: int = 3, log2_bits: int = LOG2_BITS
) -> DataFrame:
    """``docs`` with ``n_lines, n_dropped, kept_text``: every document without the lines it loses."""

    def rewrite(batch: pa.RecordBatch) -> dict:
        all_lines, dropped, kept = [], [], []
        for text, lost in zip(texts(batch), batch.column("__digests").to_pylist()):
            lines = text.split(b"\n")
            all_lines.append(len(lines))
            if lost:
                gone = set(lost)
                lines = [x for x in lines if (key := line_key(x, min_chars)) is None or key_digest(key) not in gone]
            dropped.append(all_lines[-1] - len(lines))
            kept.append(b"\n".join(lines).decode("utf-8", "replace"))
        return {"n_lines": all_lines, "n_dropped": dropped, "kept_text": kept}

    lost = repeated_lines(docs, min_chars, min_docs, log2_bits).withColumnRenamed("digests", "__digests")
    joined = docs.join(lost, "doc_id", "left")
    return extend_batches(joined, rewrite, "n_lines long, n_dropped long, kept_text string", ("__digests",))


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return drop_repeated_lines(documents(spark, folder)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


#: A document's line is judged by its key; the documents that hold a key are counted by doc_id.
ORACLE = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS n
  FROM documents
), keyed AS (
  SELECT doc_id, n, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
  FROM lines
), repeated AS (
  SELECT line_key, max(doc_id) AS keeper FROM keyed WHERE length(line_key) >= 20
  GROUP BY line_key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT doc_id, n, line, coalesce(doc_id <> keeper, FALSE) AS dropped
  FROM keyed LEFT JOIN repeated USING (line_key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
