"""Language identification from averaged, hashed subword embeddings.

The letters of a text form words; each word, with marks at its ends, gives its 1- to
5-grams of characters, which are hashed to rows of an embedding table.  A text is the
mean of all its rows, a linear layer and a softmax give the languages.  Table and layer
are trained together by stochastic gradient descent in numpy.

Training takes a bounded sample, ``SAMPLE`` labelled documents and ``SAMPLE_WORDS``
words spread evenly over each; the model is a few megabytes.  A fifth of the sample is
kept aside to calibrate: a temperature makes the score a probability, and documents
are rejected whose score is below that of all but 1 - ``KEEP`` of the right predictions.
Texts of random letters are learned as a class of their own, which takes from the score
of what is in no language, also if one or two languages are learned; a text for which it
is the best class is rejected.

Scoring reads whole texts.  The model being linear, a word adds the same to every text,
so each worker keeps what its words add.

Cases: null texts and texts without a letter are ``und`` with score 0 and rejected;
labels that are null are not learned; without any label every text is ``und``; rows
that repeat are predicted alike; an empty table gives an empty table.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import documents, extend_batches, map_batches, remember, texts

UNKNOWN = "und"
SAMPLE = 4096
SAMPLE_WORDS = 96
LOG2_ROWS = 16
DIMENSIONS = 16
GRAMS = (1, 2, 3, 4, 5)
#: SGD: steps at least, documents a step, and first rates of the table and of the layer.
STEPS = 400
BATCH = 32
TABLE_RATE = 200.0
LAYER_RATE = 1.0
KEEP = 0.99
#: Texts of random letters for each document of the sample.
NOISE = 0.25
#: Bytes of words that a Python worker remembers with what they add, about, and what an entry takes beside its word.
KEPT_BYTES = 48 << 20
ENTRY_BYTES = 180
#: Characters of new words that are looked up at a time, but for one longer word.
LEARNT_CHARS = 150_000
_LETTERS = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class LanguageModel:
    """Languages, what each row of the table adds to their logits, offsets and the calibration."""

    languages: tuple[str, ...]
    rows: np.ndarray
    offsets: np.ndarray
    temperature: float
    threshold: float

    def probabilities(self, totals: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return _softmax((totals / np.maximum(counts, 1)[:, None] + self.offsets) / self.temperature)


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters; empty if there is no letter."""
    words = _LETTERS.findall(text.lower())
    return words if any(c.isalpha() for w in words for c in w) else []


def gram_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of all n-grams of the words, and the word that each belongs to."""
    marked = [f"<{w}>" for w in words]
    points = np.frombuffer("".join(marked).encode("utf-32-le", "replace"), "<u4").astype(np.uint64)
    word = np.repeat(np.arange(len(words)), np.fromiter(map(len, marked), np.int64, len(words)))
    value, rows, owners = np.zeros(len(points), np.uint64), [], []
    for n in GRAMS:
        if len(points) < n:
            break
        at = len(points) - n + 1
        value = value[:at] * np.uint64(0x100000001B3) + points[n - 1 :] + np.uint64(n)
        inside = word[:at] == word[n - 1 :]
        mixed = (value ^ (value >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        rows.append((mixed >> np.uint64(64 - LOG2_ROWS)).astype(np.int64)[inside])
        owners.append(word[:at][inside])
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows, owners = np.concatenate(rows), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return rows[order], owners[order]


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(1, keepdims=True))
    return x / x.sum(1, keepdims=True)


def noise_words(words: list[list[str]], seed: int = 11) -> list[list[str]]:
    """Texts of random letters with word lengths of the given ones, letters as in them or all alike in turn."""
    random = np.random.default_rng(seed)
    given = [w for w in words if w]
    if not given:
        return []
    letters = np.array(list("".join("".join(w) for w in given)))
    alphabet = np.unique(letters)
    made = []
    for n in range(int(np.ceil(NOISE * len(given)))):
        lengths = np.array([len(w) for w in given[random.integers(len(given))]])
        drawn = "".join(random.choice(alphabet if n % 2 else letters, lengths.sum()))
        ends = np.cumsum(lengths)
        made.append([drawn[a:b] for a, b in zip(ends - lengths, ends)])
    return made


def train(bags: list[np.ndarray], labels: list[str], seed: int = 7, noise: list[np.ndarray] = ()) -> LanguageModel | None:
    """Fit on bags of table rows, with those of ``noise`` as a last class; ``None`` if there is nothing to learn."""
    labelled = [(bag, label) for bag, label in zip(bags, labels) if len(bag) and label is not None]
    if not labelled:
        return None
    languages = tuple(sorted({label for _, label in labelled}))
    random = np.random.default_rng(seed)
    order = random.permutation(len(labelled))
    aside = order[: len(order) // 5]
    fitted = order[len(aside) :]
    number = {label: n for n, label in enumerate(languages)}
    y = np.array([number[label] for _, label in labelled] + [len(languages)] * len(noise))
    fitted = np.concatenate([fitted, np.arange(len(labelled), len(y))])
    labelled += [(bag, None) for bag in noise]
    classes = len(languages) + bool(len(noise))
    table = random.normal(0, 0.1, (1 << LOG2_ROWS, DIMENSIONS)).astype(np.float32)
    layer = random.normal(0, 0.5, (DIMENSIONS, classes)).astype(np.float32)
    offsets = np.zeros(classes, np.float32)
    epochs = max(1, -(-STEPS * BATCH // len(fitted)))
    steps = epochs * -(-len(fitted) // BATCH)
    step = 0
    for _ in range(epochs):
        shuffled = random.permutation(fitted)
        for at in range(0, len(shuffled), BATCH):
            chosen = shuffled[at : at + BATCH]
            left = np.float32(1 - step / steps)
            step += 1
            bag = np.concatenate([labelled[n][0] for n in chosen])
            sizes = np.array([len(labelled[n][0]) for n in chosen])
            starts = np.cumsum(sizes) - sizes
            mean = np.add.reduceat(table[bag], starts) / sizes[:, None].astype(np.float32)
            error = _softmax(mean @ layer + offsets).astype(np.float32)
            error[np.arange(len(chosen)), y[chosen]] -= 1
            error /= len(chosen)
            change = (error @ layer.T) / sizes[:, None].astype(np.float32)
            layer -= left * np.float32(LAYER_RATE) * (mean.T @ error)
            offsets -= left * np.float32(LAYER_RATE) * error.sum(0)
            np.subtract.at(table, bag, left * np.float32(TABLE_RATE) * np.repeat(change, sizes, 0))
    rows = table @ layer
    model = LanguageModel(languages, rows, offsets, 1.0, 0.0)
    tested = aside if len(aside) else fitted[fitted < len(labelled) - len(noise)]
    totals = np.stack([rows[labelled[n][0]].sum(0) for n in tested])
    counts = np.array([len(labelled[n][0]) for n in tested])
    scales = np.geomspace(0.5, 4, 33)
    losses = []
    for scale in scales:
        p = LanguageModel(languages, rows, offsets, scale, 0.0).probabilities(totals, counts)
        losses.append(-np.log(np.maximum(p[np.arange(len(tested)), y[tested]], 1e-12)).mean())
    scale = float(scales[int(np.argmin(losses))])
    p = LanguageModel(languages, rows, offsets, scale, 0.0).probabilities(totals, counts)
    right = np.sort(p.max(1)[p.argmax(1) == y[tested]])
    least = float(right[int((1 - KEEP) * len(right))]) if len(right) else 0.0
    return LanguageModel(languages, model.rows, model.offsets, scale, least)


def fit(labelled: DataFrame, sample: int = SAMPLE) -> LanguageModel | None:
    """A model from ``doc_id, text, lang``; which documents are sampled depends on their doc_id alone."""
    usable = labelled.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
    ids = usable.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = usable.join(F.broadcast(ids.distinct()), "doc_id", "left_semi").select("doc_id", "lang", "text")

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        spread = []
        for text in texts(batch):
            words = words_of(text.decode("utf-8", "replace"))
            places = np.linspace(0, len(words) - 1, min(len(words), SAMPLE_WORDS)).astype(int)
            spread.append([words[n] for n in places])
        yield {"doc_id": batch.column("doc_id"), "lang": batch.column("lang"), "words": spread}

    found = map_batches(rows, work, "doc_id long, lang string, words array<string>")
    taken = found.orderBy(F.xxhash64("doc_id"), "doc_id", "lang", "words").limit(sample).collect()
    bags, noise = (
        [gram_rows(words)[0].astype(np.int32) for words in some]
        for some in ([r["words"] for r in taken], noise_words([r["words"] for r in taken]))
    )
    return train(bags, [r["lang"] for r in taken], noise=noise)


class _Scorer:
    """A worker's model with what the words that it has met add to the logits."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.known: dict[str, int] = {}
        self.held = 0
        self.added = np.zeros((1024, model.rows.shape[1] + 1), np.float32)

    def _learn(self, new: list[str]) -> None:
        ends = np.cumsum(np.fromiter(map(len, new), np.int64, len(new)))
        cuts = np.searchsorted(ends, np.arange(LEARNT_CHARS, ends[-1] if len(new) else 0, LEARNT_CHARS), "right").tolist()
        for a, b in zip([0, *cuts], [*cuts, len(new)]):
            part = new[a:b]
            if not part:
                continue
            self.held += ENTRY_BYTES * len(part) + 2 * sum(map(len, part))
            rows, owners = gram_rows(part)
            sums = np.zeros((len(part), self.added.shape[1]), np.float32)
            starts = np.searchsorted(owners, np.arange(len(part)))
            sums[:, :-1] = np.add.reduceat(self.model.rows[rows], starts)
            sums[:, -1] = np.bincount(owners, minlength=len(part))
            size = len(self.known)
            if size + len(part) > len(self.added):
                grown = np.zeros((2 * (size + len(part)), self.added.shape[1]), np.float32)
                grown[:size] = self.added[:size]
                self.added = grown
            self.added[size : size + len(part)] = sums
            self.known.update(zip(part, range(size, size + len(part))))

    def predict(self, batch: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and whether it is rejected, for each text."""
        split = [words_of(t) for t in batch]
        met = set().union(*split)
        if self.held > KEPT_BYTES:
            self.known.clear()
            self.held = 0
        self._learn(sorted(met - self.known.keys()))
        totals = np.zeros((len(batch), self.added.shape[1]))
        for n, words in enumerate(split):
            if words:
                at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
                totals[n] = self.added[at].sum(0, dtype=np.float64)
        p = self.model.probabilities(totals[:, :-1], totals[:, -1])
        none = totals[:, -1] == 0
        known = p[:, : len(self.model.languages)]
        best = known.argmax(1)
        score = np.where(none, 0.0, p[np.arange(len(batch)), best])
        found = [UNKNOWN if no else self.model.languages[b] for no, b in zip(none, best)]
        return found, score, none | (score < self.model.threshold) | (p.max(1) > score)


def identified(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``docs`` with ``lang_pred, score, rejected``, which replace columns so named; only the text is read for them."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = f"scorer-{uuid.uuid4().hex}"

    def work(batch: pa.RecordBatch) -> dict:
        if shared.value is None:
            found = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows), np.ones(batch.num_rows, bool)
        else:
            scorer = remember(key, lambda: _Scorer(shared.value))
            found = scorer.predict([t.decode("utf-8", "replace") for t in texts(batch)])
        return dict(zip(("lang_pred", "score", "rejected"), found))

    return extend_batches(docs, work, "lang_pred string, score double, rejected boolean", keeps=key)


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    kept_aside = F.coalesce(held_out(F.col("doc_id")), F.lit(False))
    docs = documents(spark, folder, "doc_id", "text", "lang").withColumn("held_out", kept_aside)
    model = fit(docs.where("NOT held_out"))
    return identified(docs.select("doc_id", "text", "held_out"), model).drop("text")
