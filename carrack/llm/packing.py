"""Best-fit packing: documents as token sequences of a fixed length.

A document is its token ids and a closing id.  Only documents that are longer than a
sequence are cut, into whole sequences and a rest.  The pieces of a partition go, one
by one, to the open bin that they fill best.  The number of open bins is fixed; a bit
set keyed by free space finds the best one, and when a new bin is needed and all places
are taken, the fullest bin closes.

Pieces arrive in batches, the longest of a batch first, which fills nearly every bin;
bins stay open from batch to batch.  A partition packs some 25 batches, so the bins that
are open at its end are few against it.  Pieces are dealt by a hash, in an order that
depends on them alone: a task that runs again packs the same.

Cases: a null or empty text is the closing id alone; rows that repeat a doc_id are
packed each for itself; an empty table gives an empty table.
"""

from __future__ import annotations

import json
import os
import re
import struct
import sys
import zlib
from collections.abc import Iterator
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import documents, forget, map_batches, remember, ship_package, texts, written

if TYPE_CHECKING:
    from tokenizers import Tokenizer

SEQUENCE = 2048
OPEN_BINS = 4096
PIECES_PER_BATCH = 10_000
BATCHES_PER_PART = 25
#: Bytes of words with their ids that a Python worker remembers, about, in each of two generations.
KEPT_BYTES = 64 << 20
#: What an entry takes beside its word, an object of its own, and ids.
ENTRY_BYTES = 130
#: Tokenizers of this kind lower-case, and then cut between letters, digits and other characters.
PARTED = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
#: Letters of Latin-1: normalizing leaves their class as it is, and cases go one to one.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_PLAIN = re.compile(f"[{_LETTERS}]+").fullmatch
#: Parts that end where a token ends: letters or digits before ASCII, ASCII marks before
#: a letter, digit or blank (an apostrophe may belong to its letter), or the rest of a word.
_PARTS = re.compile(
    f"[{_LETTERS}]++(?![^\\0-\x7f])|(?!'[{_LETTERS}])[!-/:-@\\[-`{{-~]++(?=[0-9{_LETTERS} \t-\r]|\\Z)"
    "|[0-9]++(?![^\\0-\x7f])|[^ \t-\r]++"
).findall
_WORDS = re.compile("[^ \t-\r]+").findall


class WordEncoder:
    """Token ids of whole texts, word by word.

    For tokenizers whose tokens never span ASCII white space, which is then dropped:
    the ids of a text are those of its words, and words repeat.  With a tokenizer that
    is ``PARTED`` words are parts without the marks beside them, and repeat more often.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        #: Tokens that are found before anything else.
        self.added = [t.content for t in added]
        steps = {k: getattr(self.tokenizer, k) for k in PARTED}
        self.parted = all(steps[k] and json.loads(steps[k].__getstate__()) == v for k, v in PARTED.items())
        self.parted &= not any(t.normalized or _PLAIN(t.content) for t in added)
        #: The same model, for letters in lower case.
        self.bare = Tokenizer(self.tokenizer.model)
        self.bare.pre_tokenizer = ByteLevel(add_prefix_space=False, use_regex=False)
        #: Ids of words, of this generation and of the one before.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0

    def words(self, text: bytes) -> list[str]:
        """What the ids of a text are put together from."""
        if not self.parted:
            return _WORDS(text.decode("utf-8", "replace"))
        given = lower = text.decode("utf-8", "replace")
        try:
            given.encode("latin-1")
            lower = given.lower()
        except UnicodeEncodeError:  # a capital may not compose as its small letter does
            pass
        if any(a in given or a in lower for a in self.added):
            return _WORDS(given)
        return _PARTS(lower)

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        split = [self.words(t) for t in texts]
        if self.held > KEPT_BYTES:  # words that are met again move to the new generation
            self.older, self.known, self.held = self.known, {}, 0
        met = set().union(*split) - self.known.keys()
        again = met & self.older.keys()
        self._know({w: self.older[w] for w in again})
        new = met - again
        plain = [w for w in new if self.parted and _PLAIN(w)]
        other = list(new.difference(plain))
        self._know(self._encoded(self.bare, plain, [w.lower() for w in plain]))
        self._know(self._encoded(self.tokenizer, other, other))
        return [b"".join(map(self.known.__getitem__, words)) for words in split]

    def _encoded(self, tokenizer: Tokenizer, words: list[str], texts: list[str]) -> dict[str, bytes]:
        found = (e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False))
        return {w: struct.pack(f"<{len(n)}I", *n) for w, n in zip(words, found)}

    def _know(self, found: dict[str, bytes]) -> None:
        self.known.update(found)
        self.held += ENTRY_BYTES * len(found) + sum(map(sys.getsizeof, found)) + sum(map(len, found.values()))


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a vocabulary file, loaded once."""
    return remember(path, lambda: WordEncoder(path))


def token_pieces(
    docs: DataFrame, vocabulary: str, length: int = SEQUENCE, closing_id: int = 0, keep_ids: bool = False
) -> DataFrame:
    """``doc_id, row, piece, start, length, ids_crc32`` and, if wanted, ``ids``.

    ``row`` tells rows apart that repeat a doc_id.
    """
    closing = np.array([closing_id], "<u4").tobytes()

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        out = {k: [] for k in ("at", "row", "piece", "start", "length", "ids_crc32", "ids")}
        for n, ids in enumerate(encoder(vocabulary).ids(texts(batch))):
            ids += closing
            for piece, at in enumerate(range(0, len(ids), 4 * length)):
                part = ids[at : at + 4 * length]
                out["at"].append(n)
                out["piece"].append(piece)
                out["start"].append(at // 4)
                out["length"].append(len(part) // 4)
                out["ids_crc32"].append(zlib.crc32(part))
                if keep_ids:
                    out["ids"].append(np.frombuffer(part, "<u4"))
        at = pa.array(out.pop("at"), pa.int64())
        yield out | {"doc_id": batch.column("doc_id").take(at), "row": batch.column("row").take(at)}

    schema = "doc_id long, row long, piece int, start long, length long, ids_crc32 long"
    numbered = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    return map_batches(numbered, work, schema + ", ids array<long>" * keep_ids, vocabulary)


class OpenBins:
    """A fixed number of open bins, found by their free space."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.bits, self.count, self.opened = 0, 0, 0
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def place(self, size: int) -> tuple[int, int]:
        """Number of the bin that an item goes to, and its offset there."""
        fitting = self.bits >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            if self.count == self.most and size < self.capacity:  # a full bin needs no place; the fullest has the least free space
                self._take((self.bits & -self.bits).bit_length() - 1)
            free, number = self.capacity, self.opened
            self.opened += 1
        if free > size:
            self.bins[free - size].append(number)
            self.bits |= 1 << (free - size)
            self.count += 1
        return number, self.capacity - free

    def _take(self, free: int) -> int:
        number = self.bins[free].pop()
        self.count -= 1
        if not self.bins[free]:
            self.bits &= ~(1 << free)
        return number


def packed(pieces: DataFrame, capacity: int = SEQUENCE, open_bins: int = OPEN_BINS) -> DataFrame:
    """``pieces``, a written table, with ``sequence_id`` and ``offset``."""
    ship_package(pieces.sparkSession)
    n_batches = max(1, -(-pieces.count() // PIECES_PER_BATCH))
    n_parts = -(-n_batches // BATCHES_PER_PART)
    batch = F.pmod(F.xxhash64("doc_id", "row", "piece"), F.lit(n_batches))
    order = ["__batch", F.desc("length"), "doc_id", "row", "piece"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        bins, base = OpenBins(capacity, open_bins), TaskContext.get().partitionId() << 40
        for batch in batches:
            placed = [bins.place(n) for n in batch.column("length").to_pylist()]
            numbers, offsets = zip(*placed) if placed else ((), ())
            added = [pa.array([base + n for n in numbers], pa.int64()), pa.array(offsets, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *added], names)

    schema = T.StructType([*pieces.schema.fields]).add("sequence_id", "long").add("offset", "long")
    names = schema.names
    dealt = pieces.withColumn("__batch", batch).repartition(n_parts, "__batch").sortWithinPartitions(*order)
    return dealt.mapInArrow(work, schema)


def pack_documents(docs: DataFrame, vocabulary: str, length: int = SEQUENCE, keep_ids: bool = False) -> DataFrame:
    """The pieces of all documents with their place in the sequences."""
    pieces = written(token_pieces(docs, vocabulary, length, keep_ids=keep_ids), "pieces")
    return packed(pieces, length).drop("row")


def op8_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(documents(spark, folder), public_tokenizers.path("word_bpe_49k.json"))
