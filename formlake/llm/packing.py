"""Packing documents into token sequences by the linear grouping scheme.

The plan is made from the histogram of piece lengths, which has at most as many rows as a
sequence has tokens. Pieces are numbered by falling length without gathering a length in
one task, and each looks its place up in the plan.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formlake.llm.batches import id_and_text, text_slices
from formlake.llm.grouping_plan import best_plan
from formlake.llm.library_ids import word_end_ids
from formlake.llm.workers import enter
from formlake.llm.written import written
from formlake.operators.chunks import number_rows

_PIECES = "doc_id bigint, row_no bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
_PACKED = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"


def cut_pieces(
    docs: DataFrame, tokenizer: str, capacity: int, end_id: int, id_column: str, text_column: str, added_tokens: bool
) -> DataFrame:
    """Every document's ids and its end id in pieces of at most ``capacity``."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("packing")
        ids_of, end = word_end_ids(tokenizer, added_tokens), np.array([end_id], "<u4")
        for batch, texts in text_slices(batches):
            out = []
            for doc_id, row_no, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), texts):
                ids = np.concatenate([np.frombuffer(ids_of(text), ids_of.kind).astype("<u4"), end])
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    out.append((doc_id, row_no, piece, start, len(part), zlib.crc32(part.tobytes())))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ["doc_id", "row_no", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    rows = id_and_text(docs, id_column, text_column).withColumn("row_no", F.monotonically_increasing_id())
    return rows.mapInArrow(cut, _PIECES)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    end_id: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
    added_tokens: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is its end id alone; a null id stays null; repeated rows are
    packed each by itself; other columns are not read; an empty table gives no rows.
    With ``added_tokens`` the strings of a tokenizer's added tokens get their ids, as the
    library does by default; otherwise they are ordinary text.
    """
    spark = docs.sparkSession
    pieces = written(cut_pieces(docs, tokenizer, capacity, end_id, id_column, text_column, added_tokens), "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # <= capacity rows
    segments = np.array(sorted(best_plan(histogram, capacity).segments), np.int64).reshape(-1, 4)
    plan = spark.sparkContext.broadcast(segments)  # bounded by the capacity, whatever the number of pieces

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, _, bins, offsets = plan.value.T
        for batch in batches:
            position = batch.column("row_position").to_numpy() - 1
            at = np.searchsorted(first, position, side="right") - 1
            kept = batch.select(["doc_id", "piece", "start", "length", "ids_crc32"])
            yield kept.append_column("sequence_id", pa.array(bins[at] + position - first[at])).append_column(
                "offset", pa.array(offsets[at])
            )

    falling = pieces.withColumn("falling", -F.col("length"))
    numbered = number_rows(falling, "falling", "doc_id", "row_no", "piece")
    return numbered.mapInArrow(place, _PACKED)
