"""Reading id and text columns in bounded Arrow batches inside Spark tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BATCH_BYTES = 1 << 20  # text held as Python strings at a time, unless one text alone is longer


def named(column: str) -> Column:
    """The column of this exact name, whatever characters the name holds."""
    return F.col("`" + column.replace("`", "``") + "`")


def id_and_text(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Only the two columns an operator reads, as doc_id and text; a null text counts as empty."""
    return docs.select(
        named(id_column).cast("bigint").alias("doc_id"),
        F.coalesce(named(text_column), F.lit("")).alias("text"),
    )


def text_slices(
    batches: Iterable[pa.RecordBatch], size: int = BATCH_BYTES, column: str = "text"
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Split Arrow batches so that each slice holds about ``size`` bytes of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.schema.get_field_index(column)
        lengths = pc.binary_length(batch.column(at)).to_pylist()
        start = held = 0
        for row, length in enumerate(lengths):
            held += length
            if held >= size:
                part = batch.slice(start, row + 1 - start)
                yield part, part.column(at).to_pylist()
                start, held = row + 1, 0
        if start < batch.num_rows:
            part = batch.slice(start)
            yield part, part.column(at).to_pylist()
        pa.default_memory_pool().release_unused()  # workers live on between tasks
