"""Language of texts by averaged hashed subword embeddings and a linear softmax.

A word stands for itself and the character sequences in it, with marks at its ends; each is
hashed to a row of an embedding table. A text is the mean of all its rows, and a linear layer
gives a score to each language. Table and layer are trained together by stochastic gradient
descent. On a part of the sample that training doesn't see, a temperature is fitted so that
the highest probability is the share of right answers, and a threshold is found under which
an answer is better rejected.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from formlake.llm.batches import named, text_slices
from formlake.llm.labelled import held_out
from formlake.llm.written import written

TRAIN_ROWS = 4_000  # documents of the sample, in all languages
TRAIN_CHARACTERS = 4_000  # of each that training takes; scoring takes whole texts
LANGUAGES = 512  # at most; the most frequent of the training rows
BUCKETS = 1 << 16
WIDTH = 16
LENGTHS = (1, 2, 3, 4)  # of character sequences
LONGEST = 64  # characters of a piece; longer words are cut into pieces
UNKNOWN = "und"

_SEED = 11
_BATCH, _EPOCHS, _STEPS = 32, 8, 800  # the more passes, the fewer texts there are
_TABLE_RATE, _LAYER_RATE, _OFFSET_RATE, _SHRINK = 50.0, 1.0, 0.1, 1e-4
_PARTS = 5  # one of so many is kept for calibration
_SNIPPETS = (1, 3, 8, 30, 100)  # words of a text that training sees, in turn
_ACCEPTED = 0.95  # of the right answers of the calibration part are kept

_AT_ONCE = 1 << 20  # characters whose words are listed at once
_CACHED = 1 << 22  # numbers that a worker keeps of words it has seen
_WORD = re.compile(r"[^\W\d_]+")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)  # of the polynomial that hashes characters
_POWERS = np.cumprod(np.full(LONGEST + 2, _FACTOR, np.uint64), dtype=np.uint64)


def words_of(text: str) -> Counter[str]:
    """Words with a letter, in lower case, in pieces of at most ``LONGEST`` characters, with their counts."""
    text = text.lower()
    found = _WORD.findall(text) if len(text) < _AT_ONCE else (m.group() for m in _WORD.finditer(text))
    counts = Counter(found)
    for word in [w for w in counts if len(w) > LONGEST or not w.isalpha()]:
        times = counts.pop(word)
        if any(map(str.isalpha, word)):  # the pattern also takes signs such as fractions
            for at in range(0, len(word), LONGEST):
                counts[word[at : at + LONGEST]] += times
    return counts


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and of the sequences in them, and the place of the word each belongs to."""
    text = "".join([f"<{w}>" for w in words])
    signs = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    word = np.repeat(np.arange(len(words)), sizes)
    starts = np.cumsum(sizes) - sizes
    at = np.arange(len(signs)) - np.repeat(starts, sizes)
    hashes, places = [np.add.reduceat(signs * _POWERS[at], starts)], [np.arange(len(words))]
    running = np.zeros(len(signs), np.uint64)
    for n in range(1, max(LENGTHS) + 1):
        running = running[: len(signs) - n + 1] * _FACTOR + signs[n - 1 :]
        if n in LENGTHS:
            inside = word[: len(running)] == word[n - 1 :]
            hashes.append((running + np.uint64(n))[inside])
            places.append(word[: len(running)][inside])
    mixed = np.concatenate(hashes)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * _FACTOR
    return (mixed >> np.uint64(40)).astype(np.int64) % BUCKETS, np.concatenate(places)


class WordScores(dict):
    """Words' shares of every language's score and their numbers of subwords, as rows of a table.

    All words are forgotten when they hold too much, but not within a text.
    """

    def __init__(self, scores: np.ndarray):
        super().__init__()
        self.scores, self.most = scores, max(1024, _CACHED // (scores.shape[1] + 1))
        self.rows = np.empty((1024, scores.shape[1] + 1))

    def of(self, words: Counter[str]) -> np.ndarray:
        if len(self) >= self.most:
            self.clear()
            self.rows = self.rows[:1024].copy()
        new = [w for w in words if w not in self]
        if new:
            buckets, word = subwords(new)
            first, last = len(self), len(self) + len(new)
            while last > len(self.rows):
                self.rows = np.concatenate([self.rows, np.empty_like(self.rows)])
            order = np.argsort(word, kind="stable")
            counts = np.bincount(word)
            starts = np.cumsum(counts) - counts
            self.rows[first:last, :-1] = np.add.reduceat(self.scores[buckets[order]], starts, axis=0)
            self.rows[first:last, -1] = counts
            self.update(zip(new, range(first, last)))
        return self.rows[np.fromiter(map(self.__getitem__, words), np.int64, len(words))]


@dataclass
class LanguageModel:
    """Sizes follow from the parameters, not from the corpus."""

    languages: list[str]
    table: np.ndarray  # bucket by width, single precision
    layer: np.ndarray  # width by language
    offset: np.ndarray
    temperature: float
    accept: float  # answers of a lower probability are rejected

    @cached_property
    def words(self) -> WordScores:  # made once in each worker
        return WordScores(self.table.astype(np.float64) @ self.layer)

    def logits(self, text: str) -> np.ndarray | None:
        """Nothing for a text without a letter."""
        words = words_of(text)
        if not words:
            return None
        total = np.fromiter(words.values(), np.float64, len(words)) @ self.words.of(words)
        return total[:-1] / total[-1] + self.offset

    def predict(self, text: str) -> tuple[str, float, bool]:
        """Language, its probability, and whether the answer is accepted."""
        logits = self.logits(text)
        if logits is None or not self.languages:
            return UNKNOWN, 0.0, False
        shares = _softmax(logits[None] / self.temperature)[0]
        best = int(np.argmax(shares))
        return self.languages[best], float(shares[best]), bool(shares[best] >= self.accept)


def _softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def train(texts: list[str], answers: list[int], languages: int, seed: int = _SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embedding table, layer and offset, by gradient descent over parts of the texts.

    Each epoch sees another part of a text, from one word to a hundred, so that short texts
    are learned too. Languages weigh alike, however many texts they have.
    """
    pick = np.random.default_rng(seed)
    table = (pick.random((BUCKETS, WIDTH)) - 0.5) / WIDTH
    layer, offset = np.zeros((WIDTH, languages)), np.zeros(languages)
    words = [[w[:LONGEST] for w in _WORD.findall(t.lower())] for t in texts]
    answers = np.array(answers)
    weight = 1 / np.maximum(np.bincount(answers, minlength=languages), 1)[answers]
    weight /= weight.mean()
    batches, done = -(-len(texts) // _BATCH), 0
    epochs = max(_EPOCHS, -(-_STEPS // batches))
    for epoch in range(epochs):
        order = pick.permutation(len(texts))
        for first in range(0, len(order), _BATCH):
            some = order[first : first + _BATCH]
            parts = []
            for i in some:
                size = _SNIPPETS[(epoch + i) % len(_SNIPPETS)]
                at = int(pick.integers(0, max(1, len(words[i]) - size + 1)))
                parts.append(words[i][at : at + size])
            buckets, word = subwords([w for part in parts for w in part])
            text = np.repeat(np.arange(len(parts)), [len(part) for part in parts])[word]
            used, row = np.unique(buckets, return_inverse=True)
            # How often each text has each bucket, as shares: the mean is one product.
            shares = np.bincount(text * len(used) + row, minlength=len(parts) * len(used)).reshape(len(parts), -1)
            shares = shares / shares.sum(axis=1, keepdims=True)
            means = shares @ table[used]
            error = _softmax(means @ layer + offset)
            error[np.arange(len(some)), answers[some]] -= 1
            error *= (weight[some] / len(some))[:, None]
            rate = 1 - done / (epochs * batches)
            step = rate * _TABLE_RATE * (shares.T @ (error @ layer.T))
            table[used] -= step / max(1.0, float(np.abs(step).max()))  # no number moves by more than 1
            layer -= rate * _LAYER_RATE * (means.T @ error + _SHRINK * layer)
            offset -= rate * _OFFSET_RATE * error.sum(axis=0)
            done += 1
    return table.astype(np.float32), layer, offset


def fitted_temperature(logits: np.ndarray, answers: np.ndarray) -> float:
    """The divisor of the logits under which the answers are likeliest."""
    tried = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
    picked = np.arange(len(answers)), answers
    loss = [-np.log(np.maximum(_softmax(logits / t)[picked], 1e-300)).sum() for t in tried]
    return float(tried[int(np.argmin(loss))])


def fit_language(
    docs: DataFrame,
    folds: int = 4,
    fold: int = 2,
    train_rows: int = TRAIN_ROWS,
    characters: int = TRAIN_CHARACTERS,
    id_column: str = "doc_id",
    text_column: str = "text",
    language_column: str = "lang",
) -> LanguageModel:
    """Train on at most ``train_rows`` rows with a language outside the held-out fold.

    They are picked by a hash of the id, the same number for each of the languages, of which
    the ``LANGUAGES`` most frequent are learned; ties go to the lesser name. Of each text,
    at most ``characters`` characters from its middle are sent to the driver. Texts without a
    letter teach nothing.
    """
    known = docs.select(
        named(id_column).cast("bigint").alias("doc_id"),
        named(text_column).alias("text"),
        named(language_column).cast("string").alias("lang"),
    ).where("lang is not null and text is not null")
    known = known.where(~held_out(F.col("doc_id"), folds, fold)).withColumn("place", F.xxhash64("doc_id", "text"))
    counts = known.groupBy("lang").agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "lang").limit(LANGUAGES)
    languages = sorted((r["lang"], r["rows"]) for r in counts.collect())
    if not languages:
        return LanguageModel([], np.zeros((BUCKETS, WIDTH), np.float32), np.zeros((WIDTH, 0)), np.zeros(0), 1.0, 0.0)
    share = max(1, train_rows // len(languages))
    # Hashes are spread evenly, so a bound on them leaves about twice the rows that are needed.
    span = 1 << 62
    bounds = [(name, int(min(1.0, 2 * share / rows) * span) - 1, rows) for name, rows in languages]
    picked = known.withColumn("place", F.shiftrightunsigned("place", 2)).join(
        F.broadcast(docs.sparkSession.createDataFrame(bounds, "lang string, bound bigint, rows bigint")), "lang"
    )
    cut = F.greatest(F.lit(0), F.floor((F.length("text") - characters) / 2)).cast("int")
    picked = picked.where("place <= bound").select("lang", "place", F.substring("text", cut + 1, F.lit(characters)).alias("text"))
    # Repeated rows of an id are one, so that no more than about 2 * share rows of a language are ranked.
    picked = picked.groupBy("lang", "place").agg(F.min("text").alias("text"))
    order = F.row_number().over(Window.partitionBy("lang").orderBy("place"))
    sample = written(picked.withColumn("rank", order).where(F.col("rank") <= share), "language-sample")
    rows = sample.orderBy("lang", "rank").collect()  # at most train_rows rows of ``characters``
    rows = [r for r in rows if _WORD.search(r["text"])]
    names = [name for name, _ in languages]
    number = {name: i for i, name in enumerate(names)}
    kept = [r["rank"] % _PARTS == 0 and r["rank"] >= _PARTS for r in rows]
    taught = [r for r, k in zip(rows, kept) if not k]
    if not taught:
        return LanguageModel([], np.zeros((BUCKETS, WIDTH), np.float32), np.zeros((WIDTH, 0)), np.zeros(0), 1.0, 0.0)
    model = LanguageModel(names, *train([r["text"] for r in taught], [number[r["lang"]] for r in taught], len(names)), 1.0, 0.0)
    unseen = [r for r, k in zip(rows, kept) if k]
    if unseen:
        logits = np.array([model.logits(r["text"]) for r in unseen])
        answers = np.array([number[r["lang"]] for r in unseen])
        model.temperature = fitted_temperature(logits, answers)
        shares = _softmax(logits / model.temperature)
        right = shares.argmax(axis=1) == answers
        if right.any():
            model.accept = float(np.quantile(shares.max(axis=1)[right], 1 - _ACCEPTED, method="lower"))
    model.__dict__.pop("words", None)  # each worker makes its own
    return model


_PREDICTED = "doc_id bigint, held_out boolean, lang_pred string, score double, accepted boolean"


def predict_language(docs: DataFrame, folds: int = 4, fold: int = 2, **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score and accepted of every row.

    A null text, and one without a letter, is ``und`` with score 0; so is every text where no
    row teaches a language. score is the calibrated probability of lang_pred; accepted is
    false where it is below the calibrated threshold. A null id is not held out, and such rows
    teach like others; repeated rows give repeated rows; other columns are not read; an empty
    table gives no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit_language(docs, folds, fold, **options))  # 4 MB at most, and the layer

    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            found = [model.value.predict(t) for t in texts]
            columns = [
                batch.column("doc_id"),
                batch.column("held_out"),
                pa.array([f[0] for f in found], pa.string()),
                pa.array([f[1] for f in found], pa.float64()),
                pa.array([f[2] for f in found], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _PREDICTED.split(", ")])

    texts = docs.select(
        named(options.get("id_column", "doc_id")).cast("bigint").alias("doc_id"),
        F.coalesce(named(options.get("text_column", "text")), F.lit("")).alias("text"),
    )
    return texts.withColumn("held_out", held_out(F.col("doc_id"), folds, fold)).mapInArrow(predict, _PREDICTED)
