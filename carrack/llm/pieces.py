"""SentencePiece encoding and decoding by vectorised merge rounds.

The model file gives the pieces and their scores; the merging is done here.  A text is
cut before each run of word marks, where no piece of the model crosses, and every new
word becomes a stretch of one flat array of symbols.  A round looks up the rank of each
adjacent pair, takes the smallest rank of each word, merges its pairs from the left
in all words at once, and compacts the array.  Rounds go on until no pair is left.

Merging at several places of a word at once equals merging one by one, as the model
asks for, unless a merge makes a pair that is better than the rest or equal to it.  Each
round looks at the pairs that its merges make, and a word with such a pair merges at its
leftmost place alone.

Encoded words are kept by the worker, as words repeat; decoding works on arrays of ids.

Cases: a null or empty text has no ids; characters outside the model become byte
pieces; long runs of spaces and words of any length are encoded whole; rows that repeat
are kept; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .tables import documents, map_batches, remember, texts

MARK = "▁"
#: Bytes of words with their ids that a Python worker remembers, about, in each of two generations.
KEPT_BYTES = 96 << 20
#: What an entry takes beside its words and ids.
ENTRY_BYTES = 300
#: Symbols that are merged in one flat array, beside one longer word.
FLAT_SYMBOLS = 1 << 20
_WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_NONE = np.iinfo(np.int64).max


class PieceModel:
    """Pieces, merge ranks and byte pieces of a BPE model with byte fallback and a dummy prefix."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        self.byte_ids = np.zeros(256, np.int64)
        special = np.zeros(n, bool)
        for i in range(n):
            if model.is_byte(i):
                self.byte_ids[int(self.pieces[i][1:-1], 16)] = i
            special[i] = model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
        score = np.array([model.get_score(i) for i in range(n)])
        self.ids = {piece: i for i, piece in enumerate(self.pieces) if not special[i]}
        crossing = [p for p in self.ids if MARK in p.lstrip(MARK)]
        if crossing:
            raise ValueError(f"pieces of the model cross words: {crossing[:3]}")
        #: Dense ranks, the best score first; equal scores have equal ranks.
        rank = np.unique(-score, return_inverse=True)[1]
        pairs = []
        for piece, i in self.ids.items():
            for cut in range(1, len(piece)):
                left, right = self.ids.get(piece[:cut]), self.ids.get(piece[cut:])
                if left is not None and right is not None:
                    pairs.append((left * n + right, rank[i], i))
        keys, ranks, merged = map(np.array, zip(*sorted(pairs)))
        self.n, self.keys, self.ranks, self.merged = n, keys, ranks, merged
        self.marks = self._mark_run()
        # What each id decodes to; byte pieces are single bytes.
        decoded = [
            bytes([int(p[1:-1], 16)]) if model.is_byte(i) else p.replace(MARK, " ").encode()
            for i, p in enumerate(self.pieces)
        ]
        for i in range(n):
            if model.is_control(i):
                decoded[i] = b""
            elif model.is_unknown(i):
                decoded[i] = " ⁇ ".encode()
        self.sizes = np.array([len(x) for x in decoded])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(decoded), np.uint8)
        self.is_control = np.array([model.is_control(i) for i in range(n)])
        self.decimal = [str(i).encode() for i in range(n)]
        #: Ids and decimals of words, of this generation and of the one before.
        self.known: dict[str, tuple[bytes, bytes]] = {}
        self.older: dict[str, tuple[bytes, bytes]] = {}
        self.held = 0

    def _mark_run(self) -> int:
        """How many marks a long run can be cut into without changing its ids; 0: it is not cut.

        All runs of marks share the lowest rank and a run grows from its left end, so each
        time it first reaches the longest piece of marks.
        """
        runs = [p for p in self.ids if set(p) == {MARK}]
        longest = max(map(len, runs), default=0)
        if longest < 2:
            return 0
        worst = self.ranks.max()
        own = {rank for key, rank, i in zip(self.keys, self.ranks, self.merged) if set(self.pieces[i]) == {MARK}}
        whole, once = self._merge([MARK * (2 * longest)])[0].tolist(), self._merge([MARK * longest])[0].tolist()
        return longest if own == {worst} and len(once) == 1 and whole == once * 2 else 0

    def _split(self, text: str) -> list[str]:
        """Words of a text with its dummy prefix; none crosses a boundary of pieces."""
        if not text:
            return []
        marked, limit = MARK + text.replace(" ", MARK), self.marks
        words = _WORDS.findall(marked)
        if not limit or MARK * (limit + 1) not in marked:
            return words
        cut = []
        for word in words:
            run = len(word) - len(word.lstrip(MARK))
            while run > limit:
                cut.append(MARK * limit)
                word, run = word[limit:], run - limit
            cut.append(word)
        return cut

    def _merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words and where each ends: merge rounds over one flat array."""
        flat = "".join(words)
        points = np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), "<u4")
        chars, where = np.unique(points, return_inverse=True)
        # A character outside the model gets a number that no pair has, and becomes bytes at the end.
        symbols = np.array([self.ids.get(chr(c), self.n + int(c)) for c in chars], np.int64)[where]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        word = np.repeat(np.arange(len(words)), lengths)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols) > 1:
            rank, at = self._rank(symbols[:-1], symbols[1:])
            rank[word[:-1] != word[1:]] = _NONE
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            least = np.minimum.reduceat(np.append(rank, _NONE), first)
            live = least < _NONE
            if not live.any():
                break
            best = np.repeat(least, np.diff(np.append(first, len(symbols))))[:-1]
            chosen = np.flatnonzero((rank == best) & (rank < _NONE))
            # Equal neighbours overlap: of a chain of adjacent pairs every other one merges, from the left.
            chain = np.concatenate([[True], np.diff(chosen) != 1])
            head = np.maximum.accumulate(np.where(chain, np.arange(len(chosen)), 0))
            chosen = chosen[(np.arange(len(chosen)) - head) % 2 == 0]
            fresh = np.concatenate([[True], word[chosen[1:]] != word[chosen[:-1]]])
            if not fresh.all():
                # From left to right, each merge makes a pair with what is before and what is behind it then.
                piece = self.merged[at[chosen]]
                before, behind = symbols[np.maximum(chosen - 1, 0)], np.append(symbols, [0, 0])[chosen + 2]
                touching = np.flatnonzero(np.diff(chosen) == 2) + 1
                before[touching] = piece[touching - 1]
                around = np.append(word, [-1, -1])
                better = (self._rank(before, piece)[0] <= rank[chosen]) & (chosen > 0) & (around[chosen - 1] == word[chosen])
                better |= (self._rank(piece, behind)[0] <= rank[chosen]) & (around[chosen + 2] == word[chosen])
                held = np.logical_or.reduceat(better, np.flatnonzero(fresh))[np.cumsum(fresh) - 1]
                chosen = chosen[fresh | ~held]
            symbols = symbols.copy()
            symbols[chosen] = self.merged[at[chosen]]
            stay = np.ones(len(symbols), bool)
            stay[chosen + 1] = False
            symbols, word = symbols[stay], word[stay]
            # Words without a pair are finished and leave the array.
            unfinished = np.zeros(len(words), bool)
            unfinished[word[np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))][live]] = True
            going = unfinished[word]
            if not going.all():
                done.append((word[~going], symbols[~going]))
                symbols, word = symbols[going], word[going]
        done.append((word, symbols))
        word = np.concatenate([w for w, _ in done])
        symbols = np.concatenate([s for _, s in done])
        order = np.argsort(word, kind="stable")
        word, symbols = word[order], symbols[order]
        outside = np.flatnonzero(symbols >= self.n)
        if len(outside):
            parts, at = [], 0
            for k in outside.tolist():
                spelled = self.byte_ids[list(chr(int(symbols[k]) - self.n).encode("utf-8", "replace"))]
                parts += [(symbols[at:k], word[at:k]), (spelled, np.full(len(spelled), word[k]))]
                at = k + 1
            parts.append((symbols[at:], word[at:]))
            symbols, word = (np.concatenate(x) for x in zip(*parts))
        return symbols, np.searchsorted(word, np.arange(len(words)), side="right")

    def _rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair, and where its piece is in the table."""
        key = np.where((left < self.n) & (right < self.n), left * self.n + right, -1)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE), at

    def _learn(self, words: set[str]) -> None:
        """Encode new words, in flat arrays of bounded size."""
        group, size = [], 0
        for word in [*words, None]:
            if word is None or size + len(word) > FLAT_SYMBOLS:
                if group:
                    symbols, ends = self._merge(group)
                    raw, decimal, start = symbols.astype("<u4").tobytes(), [self.decimal[i] for i in symbols.tolist()], 0
                    for known, end in zip(group, ends.tolist()):
                        entry = raw[4 * start : 4 * end], b",".join(decimal[start:end])
                        self.known[known] = entry
                        self.held += ENTRY_BYTES + 4 * len(known) + len(entry[0]) + len(entry[1])
                        start = end
                group, size = [], 0
            if word is not None:
                group.append(word)
                size += len(word)

    def _words(self, batch: list[str]) -> list[list[str]]:
        split = [self._split(t) for t in batch]
        if self.held > KEPT_BYTES:  # words that are met again move to the new generation
            self.older, self.known, self.held = self.known, {}, 0
        new = set().union(*split) - self.known.keys()
        again = new & self.older.keys()
        self.known.update((w, self.older[w]) for w in again)
        self.held += sum(ENTRY_BYTES + 4 * len(w) + sum(map(len, self.older[w])) for w in again)
        self._learn(new - again)
        return split

    def encode(self, batch: list[str]) -> list[np.ndarray]:
        """Ids of each text, without begin and end."""
        return [self._joined(words) for words in self._words(batch)]

    def _joined(self, words: list[str]) -> np.ndarray:
        return np.frombuffer(b"".join([self.known[w][0] for w in words]), "<u4").astype(np.int64)

    def encode_decimal(self, batch: list[str]) -> list[tuple[np.ndarray, bytes]]:
        """Ids of each text, also as decimals joined by commas."""
        return [(self._joined(words), b",".join([self.known[w][1] for w in words])) for words in self._words(batch)]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; the dummy prefix goes, bytes that are no UTF-8 become U+FFFD each."""
        if not len(ids):
            return ""
        control = self.is_control[ids]
        if control.any():  # such an id has no text, but ends a run of byte pieces
            parts = [x[~self.is_control[x]] for x in np.split(ids, np.flatnonzero(control))]
            first = next((n for n, x in enumerate(parts) if len(x)), 0)
            return "".join(self._text(x, n == first) for n, x in enumerate(parts))
        return self._text(ids, True)

    def _text(self, ids: np.ndarray, at_start: bool) -> str:
        if not len(ids):
            return ""
        sizes = self.sizes[ids]
        total = np.cumsum(sizes)
        flat = self.bytes[np.arange(total[-1]) + np.repeat(self.starts[ids] - (total - sizes), sizes)]
        raw = flat.tobytes()
        if at_start and self.pieces[ids[0]].startswith(MARK):
            raw = raw[1:]
        try:
            return raw.decode("utf-8")
        except UnicodeDecodeError:
            return raw.decode("utf-8", "one_by_one")


def _one_by_one(error: UnicodeError) -> tuple[str, int]:
    return "�", error.start + 1


def model(path: str) -> PieceModel:
    """The worker's model for a file, loaded once."""

    def load() -> PieceModel:
        import codecs

        codecs.register_error("one_by_one", _one_by_one)
        return PieceModel(path)

    return remember(path, load)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids``: the ids of each text."""

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        ids = model(path).encode([t.decode("utf-8", "replace") for t in texts(batch)])
        yield {"doc_id": batch.column("doc_id"), "ids": [x.astype(np.int32) for x in ids]}

    return map_batches(docs.select("doc_id", "text"), work, "doc_id long, ids array<int>", path)


def decoded(tokens: DataFrame, path: str) -> DataFrame:
    """``doc_id, text``: the text of each list of ids; null is empty."""

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        lists = [np.array(x or [], np.int64) for x in batch.column("ids").to_pylist()]
        yield {"doc_id": batch.column("doc_id"), "text": [model(path).decode(x) for x in lists]}

    return map_batches(tokens.select("doc_id", "ids"), work, "doc_id long, text string", path)


def op2_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        pieces, out = model(path), {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for ids, decimal in pieces.encode_decimal([t.decode("utf-8", "replace") for t in texts(batch)]):
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(hashlib.sha256(decimal).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(pieces.decode(ids).encode()).hexdigest())
        yield out | {"doc_id": batch.column("doc_id")}

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_batches(documents(spark, folder), work, schema, path)
