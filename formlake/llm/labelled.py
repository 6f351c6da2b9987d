"""Bounded samples of labelled rows, and held-out rows by a checksum of the document id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formlake.llm.batches import named

TRAIN_ROWS = 10_000
_PLACES = 1 << 30


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def training_labels(
    labels: DataFrame, label_column: str, folds: int, fold: int, rows: int = TRAIN_ROWS, id_column: str = "doc_id"
) -> DataFrame:
    """At most ``rows`` rows (doc_id, label) outside the held-out fold, picked by a hash of the id.

    Null ids and labels other than 0 and 1 are left out.
    """
    known = labels.select(named(id_column).cast("bigint").alias("doc_id"), named(label_column).cast("int").alias("label"))
    known = known.where("doc_id is not null and label in (0, 1)").where(~held_out(F.col("doc_id"), folds, fold))
    known = known.withColumn("place", F.pmod(F.xxhash64("doc_id"), F.lit(_PLACES)))
    # The places are spread evenly, so twice the share that is needed goes into the sort.
    share = 2 * rows / max(1, known.count())
    picked = known.where(F.col("place") < int(min(1.0, share) * _PLACES)).distinct()
    return picked.orderBy("place", "doc_id", "label").limit(rows).drop("place")
