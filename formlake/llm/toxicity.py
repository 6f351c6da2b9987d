"""Toxicity by the nearest labelled examples in exact TF-IDF cosine.

Terms are all words in a bounded sample of labelled rows, and those beginnings of words that
the sample ties to label 1. Terms tied to label 1 weigh more, by the strength of the tie.
Document frequencies come from all documents; words of a text that no example has count in its
length as the rarest.
Neighbours vote with weights that fall with distance, and votes become probabilities by a
monotone fit to the examples' own votes, each without itself.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formlake.llm.batches import id_and_text, named, text_slices
from formlake.llm.block_index import BlockMaxIndex, Vector, spans
from formlake.llm.labelled import TRAIN_ROWS, held_out, training_labels
from formlake.llm.workers import enter, give_back
from formlake.llm.written import written

EVIDENCE = 1.5  # log-likelihood ratio of a full tie, over the log of the terms looked at
UNTIED = 0.05  # weight of a term without a tie; a full tie weighs 1
NEIGHBOURS = 10
PRIOR = 0.2  # weight of the vote that every document gets for the base rate
TIED = 0.25  # squared tie from which a beginning is a term beside its words
THRESHOLD = 0.3
CLOSE = 0.02  # added to the distance that a vote is divided by
_SPREAD = 1024  # examples searched in a task
_BEGINNINGS = (3, 4, 5, 6)
_WORD = re.compile(r"\w+")

_COUNTED = "numbers binary, counts binary, words bigint, outside bigint"
_SCORED = (
    "doc_id bigint, held_out boolean, score double, predicted int, "
    "evidence array<struct<doc_id: bigint, similarity: double, label: int>>"
)


def word_terms(word: str) -> list[str]:
    return [word, *(f"{word[:k]}*" for k in _BEGINNINGS if len(word) > k)]


#: Terms of a text, their counts, the words, and the distinct words outside the vocabulary.
Counted = tuple[np.ndarray, np.ndarray, int, int]


class _Numbers(dict):
    """Numbers of vocabulary terms; any other term has the number past them."""

    def __missing__(self, term: str) -> int:
        return self.none


class Terms:
    """Counts of vocabulary terms in texts."""

    def __init__(self, vocabulary: list[str]):
        self.number = _Numbers((term, i) for i, term in enumerate(vocabulary))
        self.size = self.number.none = len(vocabulary)
        begun = [i for i, term in enumerate(vocabulary) if term.endswith("*")]
        self.begun = np.array(begun, np.int64)
        self.begins = {vocabulary[i]: k for k, i in enumerate(begun)}
        # Few words share their first letters with a beginning that is a term.
        self.heads = {term[: _BEGINNINGS[0]] for term in self.begins}
        # The beginnings of vocabulary words are looked up once: word i has own[first[i] : first[i + 1]].
        own: list[int] = []
        sizes = np.zeros(self.size + 1, np.int64)
        for i, word in enumerate(vocabulary):
            if word[: _BEGINNINGS[0]] in self.heads and not word.endswith("*"):
                found = self.beginnings(word)
                sizes[i + 1] = len(found)
                own += found
        self.first, self.own = np.cumsum(sizes), np.array(own, np.int32)

    def beginnings(self, word: str) -> list[int]:
        """Places among the beginnings of those that the word has."""
        return [self.begins[term] for term in word_terms(word)[1:] if term in self.begins]

    def arrays(self, text: str) -> Counted:
        words = Counter(_WORD.findall(text.lower()))
        numbers = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        counts = np.fromiter(words.values(), np.int64, len(words))
        total, inside = int(counts.sum()), numbers < self.size
        outside = len(words) - int(inside.sum())
        heads, first = self.heads, _BEGINNINGS[0]
        begun: list[int] = []
        times: list[int] = []
        if outside:
            for word in compress(words, (~inside).tolist()):
                if word[:first] in heads:
                    found = self.beginnings(word)
                    begun += found
                    times += [words[word]] * len(found)
            numbers, counts = numbers[inside], counts[inside]
        if len(self.begun):
            begin, size = self.first[numbers], self.first[numbers + 1] - self.first[numbers]
            places = np.concatenate([self.own[spans(begin, size)], np.array(begun, np.int32)])
            often = np.concatenate([np.repeat(counts, size), np.array(times, np.int64)])
            seen = np.bincount(places, often, minlength=len(self.begun)).astype(np.int64)
            some = np.flatnonzero(seen)
            numbers, counts = np.concatenate([numbers, self.begun[some]]), np.concatenate([counts, seen[some]])
        return numbers, counts, total, outside

    def count(self, text: str) -> tuple[list[int], list[int], int]:
        terms, counts, words, _ = self.arrays(text)
        order = np.argsort(terms)
        return terms[order].tolist(), counts[order].tolist(), words


@dataclass
class Vocabulary:
    """Terms as they are sent, a line each, compressed; every executor keeps what is sent."""

    lines: bytes

    @cached_property
    def terms(self) -> Terms:  # made once in each worker
        return Terms(zlib.decompress(self.lines).decode().split("\n"))


def with_counts(batches: Iterable[pa.RecordBatch], terms: Terms) -> Iterator[pa.RecordBatch]:
    """The text's terms, as steps from the one before, and their counts in its place."""
    for batch, texts in text_slices(batches):
        found = [terms.arrays(text) for text in texts]
        orders = [np.argsort(f[0]) for f in found]
        columns = {name: batch.column(name) for name in batch.schema.names if name != "text"}
        columns |= {
            "numbers": pa.array([np.diff(f[0][o], prepend=0).astype("<i4").tobytes() for f, o in zip(found, orders)], pa.binary()),
            "counts": pa.array([f[1][o].astype("<i4").tobytes() for f, o in zip(found, orders)], pa.binary()),
            "words": pa.array([f[2] for f in found], pa.int64()),
            "outside": pa.array([f[3] for f in found], pa.int64()),
        }
        yield pa.RecordBatch.from_pydict(columns)


def read_counts(batch: pa.RecordBatch) -> list[Counted]:
    columns = [batch.column(name).to_pylist() for name in ("numbers", "counts", "words", "outside")]
    return [
        (np.cumsum(np.frombuffer(n, "<i4"), dtype=np.int32), np.frombuffer(c, "<i4"), words, outside)
        for n, c, words, outside in zip(*columns)
    ]


@dataclass
class ToxicityModel:
    """All that a search needs; its size is bounded by the sample's texts.

    Every executor keeps what is sent, so examples go compressed, and workers build the index
    from them.
    """

    weights: np.ndarray  # of terms
    rarest: float  # weight of a term that no example has
    numbers: bytes  # each example's terms as steps from the one before, compressed
    counts: bytes  # and their counts
    sizes: np.ndarray  # terms of each example
    outside: np.ndarray
    labels: np.ndarray
    doc_ids: list[int]
    base: float

    @cached_property
    def index(self) -> BlockMaxIndex:
        ends = np.cumsum(self.sizes)[:-1]
        numbers = np.split(np.frombuffer(zlib.decompress(self.numbers), "<i4"), ends)
        counts = np.split(np.frombuffer(zlib.decompress(self.counts), "<i4"), ends)
        vectors = [
            self.vector(np.cumsum(n, dtype=np.int32), c, o) for n, c, o in zip(numbers, counts, self.outside.tolist())
        ]
        made = BlockMaxIndex(vectors, len(self.weights))
        del vectors
        give_back()  # the vectors took as much as the index
        return made

    def vector(self, terms: np.ndarray, counts: np.ndarray, outside: int) -> Vector:
        weights = (1 + np.log(counts)) * self.weights[terms]
        return terms, weights / max(1e-300, math.sqrt(float(weights @ weights) + outside * self.rarest**2))

    def votes(self, vectors: list[Vector], without: list[int] | None = None) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """For each vector the neighbours' vote, their numbers and similarities."""
        out = []
        for found, likeness in self.index.nearest_many(vectors, NEIGHBOURS, without):
            weights = likeness**2 / (1 + CLOSE - likeness**2)
            total = float(weights @ self.labels[found]) + PRIOR * self.base / 2
            out.append((total / (float(weights.sum()) + PRIOR), found, likeness))
        return out


@dataclass
class Scorer:
    """A shared model with its calibration: votes and the probabilities there."""

    shared: Broadcast[ToxicityModel] | None
    vocabulary: Broadcast[Vocabulary] | None = None
    unmarked: float = 0.0  # score of a text without a word
    steps: np.ndarray | None = None
    heights: np.ndarray | None = None

    def scores_of_texts(self, texts: list[str]) -> np.ndarray:
        if self.vocabulary is None:
            return np.zeros(len(texts))
        terms = self.vocabulary.value.terms
        return self.scores([terms.arrays(text) for text in texts])[0]

    def scores(self, counted: list[Counted]) -> tuple[np.ndarray, list[Vector]]:
        """Each text's probability, and the numbers and similarities of the examples it rests on."""
        nothing = np.zeros(0, np.int64), np.zeros(0)
        if self.shared is None:
            return np.zeros(len(counted)), [nothing] * len(counted)
        model = self.shared.value
        worded = [i for i, (_, _, words, _) in enumerate(counted) if words]
        votes = model.votes([model.vector(*counted[i][:2], counted[i][3]) for i in worded])
        scores, found = np.full(len(counted), self.unmarked), [nothing] * len(counted)
        scores[worded] = np.interp([v[0] for v in votes], self.steps, self.heights) if votes else []
        for i, (_, numbers, likeness) in zip(worded, votes):
            found[i] = numbers, likeness
        return scores, found

    def evidence(self, found: list[Vector]) -> pa.Array:
        """Examples with their similarity and label, as a list for each text."""
        numbers = np.concatenate([n for n, _ in found]) if found else np.zeros(0, np.int64)
        doc_ids, labels = np.zeros(0, np.int64), np.zeros(0, np.int32)
        if self.shared is not None:
            doc_ids, labels = np.array(self.shared.value.doc_ids, np.int64), self.shared.value.labels
        rows = pa.StructArray.from_arrays(
            [
                pa.array(doc_ids[numbers], pa.int64()),
                pa.array(np.concatenate([s for _, s in found]) if found else np.zeros(0), pa.float64()),
                pa.array(labels[numbers].astype(np.int32), pa.int32()),
            ],
            names=["doc_id", "similarity", "label"],
        )
        return pa.ListArray.from_arrays(np.cumsum([0, *(len(n) for n, _ in found)]).astype(np.int32), rows)


def monotone_fit(votes: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: votes and the shares of label 1 there, smoothed by one half each."""
    blocks: list[list[float]] = []  # sum of labels, rows, sum of votes
    for i in np.argsort(votes, kind="stable"):
        blocks.append([float(labels[i]), 1.0, float(votes[i])])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    heights = np.maximum.accumulate([(y + 0.5) / (n + 1) for y, n, _ in blocks])
    return np.array([v / n for _, n, v in blocks]), heights


def tied_terms(examples: DataFrame) -> tuple[list[str], np.ndarray, int, int]:
    """Terms of a bounded sample (text, label), each one's tie to label 1, and the rows of labels 1 and 0.

    All words are terms, and the beginnings of words that are tied. A tie goes from 0 to 1.
    Each task returns one row per term it has seen.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter[str], Counter[str]] = (Counter(), Counter())
        for batch, texts in text_slices(batches):
            for text, label in zip(texts, batch.column(1).to_pylist()):
                terms = {t for word in set(_WORD.findall(text.lower())) for t in word_terms(word)}
                seen[label].update(terms)
                seen[label][""] += 1  # the rows themselves
        terms = list(seen[0].keys() | seen[1].keys())
        for first in range(0, len(terms), 50_000):
            some = terms[first : first + 50_000]
            yield pa.RecordBatch.from_pydict(
                {
                    "term": pa.array(some, pa.string()),
                    "toxic": pa.array([seen[1][t] for t in some], pa.int64()),
                    "clean": pa.array([seen[0][t] for t in some], pa.int64()),
                }
            )

    parts = examples.select("text", "label").mapInArrow(count, "term string, toxic bigint, clean bigint")
    # One row a term of the sample, in Arrow's compact form.
    counts = parts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).toArrow()
    counts = counts.sort_by("term")
    vocabulary = counts.column("term").to_pylist()
    if not vocabulary:
        return [], np.zeros(0), 0, 0
    with_term = [counts.column(name).to_numpy().astype(float) for name in ("toxic", "clean")]
    toxic, clean = (int(seen[0]) for seen in with_term)  # "" sorts first
    if not toxic or not clean:
        return [], np.zeros(0), toxic, clean
    toxic_with, clean_with = (seen[1:] for seen in with_term)
    both, share = toxic_with + clean_with, toxic / (toxic + clean)

    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, 2 * seen * np.log(np.maximum(seen, 1) / np.maximum(expected, 1e-300)), 0.0)

    ratio = (
        part(toxic_with, both * share)
        + part(clean_with, both * (1 - share))
        + part(toxic - toxic_with, (toxic + clean - both) * share)
        + part(clean - clean_with, (toxic + clean - both) * (1 - share))
    )
    full = EVIDENCE * math.log(max(2, len(both)))
    ties = np.where(toxic_with > both * share, np.clip(ratio / full, 0, 1), 0.0) ** 2
    words = [not term.endswith("*") for term in vocabulary[1:]]
    kept = np.flatnonzero(np.array(words) | (ties >= TIED))
    return [vocabulary[1 + i] for i in kept.tolist()], ties[kept], toxic, clean


def document_frequencies(rows: DataFrame, vocabulary: Broadcast[Vocabulary], size: int) -> tuple[np.ndarray, int]:
    """In how many rows each of ``size`` terms is, and how many rows there are.

    Rows have counts already, or a text.
    """
    ready = "text" not in rows.columns

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("toxicity")
        seen = np.zeros(size + 1, np.int64)
        for batch in batches if ready else with_counts(batches, vocabulary.value.terms):
            found = [numbers for numbers, _, _, _ in read_counts(batch)]
            if found:
                seen[:size] += np.bincount(np.concatenate(found), minlength=size)
            seen[size] += batch.num_rows
        some = np.flatnonzero(seen)
        for first in range(0, len(some), 50_000):
            part = some[first : first + 50_000]
            yield pa.RecordBatch.from_pydict({"term": pa.array(part, pa.int64()), "rows": pa.array(seen[part], pa.int64())})

    parts = rows.mapInArrow(count, "term bigint, rows bigint")
    summed = parts.groupBy("term").agg(F.sum("rows").alias("rows")).toArrow()  # one row a term
    frequency = np.zeros(size + 1)
    frequency[summed.column("term").to_numpy()] = summed.column("rows").to_numpy()
    return frequency[:size], int(frequency[size])


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = 4,
    fold: int = 2,
    train_rows: int = TRAIN_ROWS,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    keep_counts: bool = False,
) -> tuple[Scorer, DataFrame | None]:
    """A scorer, and with ``keep_counts`` every row's id and term counts, written.

    Examples are at most ``train_rows`` labelled rows outside the held-out fold.
    All of them are searched, over all their terms. Without rows of both labels nothing is
    known against any document, every score is 0, and no counts are kept.
    """
    spark = docs.sparkSession
    texts = id_and_text(docs, id_column, text_column)
    train = written(training_labels(labels, label_column, folds, fold, train_rows), "training-labels")
    # At most train_rows rows of two numbers. Repeated rows of an id are one example.
    sample = texts.join(F.broadcast(train), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    examples = written(sample, "examples")
    tasks = max(1, -(-examples.count() // _SPREAD))
    spread = examples.repartition(tasks)
    vocabulary, ties, toxic, clean = tied_terms(spread)
    if not vocabulary:
        return Scorer(None), None
    shared_terms = spark.sparkContext.broadcast(Vocabulary(zlib.compress("\n".join(vocabulary).encode(), 1)))

    def counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("toxicity")
        yield from with_counts(batches, shared_terms.value.terms)

    counted = written(texts.mapInArrow(counts, f"doc_id bigint, {_COUNTED}"), "term-counts") if keep_counts else None
    frequency, documents = document_frequencies(
        texts.select("text") if counted is None else counted, shared_terms, len(vocabulary)
    )
    idf = np.log((2 + documents) / (1 + frequency))  # next to nothing for a word of all documents
    kind = f"doc_id bigint, label int, {_COUNTED}"
    packed_rows = written(spread.select("doc_id", "label", "text").mapInArrow(counts, kind), "example-counts")
    # Eight bytes a term of an example.
    packed = packed_rows.toArrow().sort_by([("doc_id", "ascending"), ("label", "ascending")])
    with_words = pc.greater(packed.column("words"), 0)
    plain = packed.filter(pc.invert(with_words)).column("label").to_pylist()
    packed = packed.filter(with_words)
    numbers, times = packed.column("numbers").to_pylist(), packed.column("counts").to_pylist()
    model = ToxicityModel(
        idf * (UNTIED + (1 - UNTIED) * ties), UNTIED * math.log(2 + documents),
        zlib.compress(b"".join(numbers), 1), zlib.compress(b"".join(times), 1),
        np.array([len(n) // 4 for n in numbers], np.int64), packed.column("outside").to_numpy(),
        packed.column("label").to_numpy(), packed.column("doc_id").to_pylist(), (toxic + 0.5) / (toxic + clean + 1),
    )
    shared = spark.sparkContext.broadcast(model)

    def vote(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("toxicity")
        model = shared.value
        place = {pair: i for i, pair in enumerate(zip(model.doc_ids, model.labels.tolist()))}
        for batch in batches:
            pairs = zip(batch.column("doc_id").to_pylist(), batch.column("label").to_pylist())
            at = [place.get(pair, -1) for pair in pairs]  # none for a text without a word
            rows = [(i, found) for i, found in zip(at, read_counts(batch)) if i >= 0]
            votes = model.votes([model.vector(v[0], v[1], v[3]) for _, v in rows], [i for i, _ in rows])
            yield pa.RecordBatch.from_pydict(
                {"place": pa.array([i for i, _ in rows], pa.int64()), "vote": pa.array([v[0] for v in votes], pa.float64())}
            )

    # Files of examples are small, and a search is long.
    voted = packed_rows.repartition(tasks).mapInArrow(vote, "place bigint, vote double").toArrow().sort_by("place")  # two numbers an example
    steps, heights = monotone_fit(voted.column("vote").to_numpy(), model.labels[voted.column("place").to_numpy()])
    unmarked = (sum(plain) + 0.5 * model.base) / (len(plain) + 0.5)
    return Scorer(shared, shared_terms, unmarked, steps, heights), counted


def score_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 4, fold: int = 2, **options) -> DataFrame:
    """doc_id, held_out, score, predicted and evidence of every row.

    A null or empty text has no terms and the score of examples without any; where the labels
    are all alike all scores are 0. A null id is not held out; repeated rows give repeated
    rows; other columns are not read; an empty table gives no rows.
    """
    scorer, counted = fit_toxicity(docs, labels, folds, fold, keep_counts=True, **options)
    if counted is None:  # every score is 0, whatever the text
        ids = id_and_text(docs, options.get("id_column", "doc_id"), options.get("text_column", "text")).select("doc_id")
        return ids.select(
            "doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), F.lit(0.0).alias("score"),
            F.lit(0).alias("predicted"), F.expr("cast(array() as array<struct<doc_id: bigint, similarity: double, label: int>>)").alias("evidence"),
        )

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("toxicity")
        for batch in batches:
            scores, found = scorer.scores(read_counts(batch))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "held_out": batch.column("held_out"),
                    "score": pa.array(scores, pa.float64()),
                    "predicted": pa.array((scores >= THRESHOLD).astype(np.int32), pa.int32()),
                    "evidence": scorer.evidence(found),
                }
            )

    return counted.withColumn("held_out", held_out(F.col("doc_id"), folds, fold)).mapInArrow(score, _SCORED)


def drop_toxic(docs: DataFrame, labels: DataFrame, text_column: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose score is under the threshold, with their columns.

    Odd rows are scored as ``score_toxicity`` says; columns of any name pass through.
    """
    scorer, _ = fit_toxicity(docs, labels, text_column=text_column, **options)

    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        enter("toxicity")
        for array in texts:
            table = pa.RecordBatch.from_arrays([array.cast(pa.string())], names=["text"])
            out = [scorer.scores_of_texts(part) for _, part in text_slices([table])]
            yield pa.array(np.concatenate(out) if out else [], pa.float64())

    score.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    toxicity = F.arrow_udf(score, "double")
    return docs.where(toxicity(F.coalesce(named(text_column), F.lit(""))) < THRESHOLD)
