"""Text quality by an additive model over features of the whole text."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formlake.llm import additive_model
from formlake.llm.additive_model import AdditiveModel
from formlake.llm.batches import id_and_text, named, text_slices
from formlake.llm.labelled import TRAIN_ROWS, held_out, training_labels
from formlake.llm.workers import enter

THRESHOLD = 0.3
_SCORED = "doc_id bigint, held_out boolean, score double, predicted int"

# Bytes of each kind; a feature is their share of the text.
_KINDS = {
    "pipes": b"|",
    "symbols": b"#$%&*@^~=+_\\",
    "calls": b"!?",
    "stops": b".,;:",
    "brackets": b"<>{}[]()",
    "digits": b"0123456789",
    "capitals": bytes(range(65, 91)),
    "spaces": b" \t\r\n",
    "beyond_ascii": bytes(range(128, 256)),
}
_KIND_OF = np.full(256, len(_KINDS))
for _number, _members in enumerate(_KINDS.values()):
    _KIND_OF[list(_members)] = _number
FEATURES = (*_KINDS, "log_words", "word_length", "variety", "stutter", "line_length", "repeated_lines")


def features(text: str) -> list[float]:
    """Numbers about a whole text; all zero for an empty one."""
    if not text:
        return [0.0] * len(FEATURES)
    raw = np.bincount(np.frombuffer(text.encode("utf-8"), np.uint8), minlength=256)
    size = float(raw.sum())
    shares = np.bincount(_KIND_OF, raw, minlength=len(_KINDS) + 1)[:-1] / size
    words = text.split()
    count = max(1, len(words))
    lines = text.split("\n")
    return [
        *shares.tolist(),
        float(np.log(count)),
        len(text) / count,
        float(np.log(max(1, len(set(words)))) / np.log(count + 1)),
        sum(map(str.__eq__, words, words[1:])) / count,
        float(np.log(size / len(lines) + 1)),
        1 - len(set(lines)) / len(lines),
    ]


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = 5,
    fold: int = 0,
    train_rows: int = TRAIN_ROWS,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
) -> AdditiveModel:
    """Fit on at most ``train_rows`` labelled rows outside the held-out fold.

    Repeated rows of an id are one example. Without rows of both labels nothing can be
    learned, and every score is one half, which passes.
    """
    train = training_labels(labels, label_column, folds, fold, train_rows)
    # At most train_rows rows of two numbers are broadcast.
    sample = id_and_text(docs, id_column, text_column).join(F.broadcast(train), "doc_id")

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(0),
                    "label": batch.column(2),
                    "x": pa.array([features(t) for t in texts], pa.list_(pa.float64())),
                }
            )

    measured = sample.mapInArrow(measure, "doc_id bigint, label int, x array<double>")
    rows = measured.groupBy("doc_id", "label").agg(F.min("x").alias("x")).orderBy("doc_id", "label").collect()
    table = np.array([r["x"] for r in rows], float).reshape(-1, len(FEATURES))
    known = np.array([r["label"] for r in rows], float)
    return additive_model.fit(table, known) if len(set(known)) == 2 else AdditiveModel(0.0)


def score_quality(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0, **options) -> DataFrame:
    """doc_id, held_out, score and predicted of every row.

    A null or empty text is scored by its features, which are all zero; a null id is not
    held out; repeated rows give repeated rows; other columns are not read; an empty table
    gives no rows.
    """
    model = fit_quality(docs, labels, folds, fold, **options)
    names = {k: options[k] for k in ("id_column", "text_column") if k in options}

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("quality")
        for batch, texts in text_slices(batches):
            scores = model.score(np.array([features(t) for t in texts]))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(0),
                    "held_out": batch.column(2),
                    "score": pa.array(scores, pa.float64()),
                    "predicted": pa.array((scores >= THRESHOLD).astype(np.int32), pa.int32()),
                }
            )

    texts = id_and_text(docs, **names).withColumn("held_out", held_out(F.col("doc_id"), folds, fold))
    return texts.mapInArrow(score, _SCORED)


def drop_low_quality(docs: DataFrame, labels: DataFrame, text_column: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, with their columns.

    Odd rows are scored as ``score_quality`` says; columns of any name pass through.
    """
    model = fit_quality(docs, labels, text_column=text_column, **options)

    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        enter("quality")
        for array in texts:
            table = pa.RecordBatch.from_arrays([array.cast(pa.string())], names=["text"])
            rows = [features(t) for _, part in text_slices([table]) for t in part]
            yield pa.array(model.score(np.array(rows).reshape(-1, len(FEATURES))), pa.float64())

    score.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    quality = F.arrow_udf(score, "double")
    return docs.where(quality(F.coalesce(named(text_column), F.lit(""))) >= THRESHOLD)
