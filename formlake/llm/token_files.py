"""Writing token ids as binary files in ascending document order, and reading them back.

Texts are encoded where they are read; only their ids are shuffled, into ranges of
document ids, one task each. Files go through Spark's own text writer, one record a file
with the bytes as they are, so they land atomically on any file system that Spark can
write, and are read back with the binaryFile source.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from formlake.llm.batches import id_and_text, text_slices
from formlake.llm.library_ids import byte_level_ids
from formlake.llm.packed_ids import COUNT_AT, RANGE_AT, TokenFile

FILE_IDS = 1 << 21  # a file is closed when it holds so many ids
_TRAILER = "\n"  # the text writer puts it behind each record
_SAMPLE = 100  # rows sampled for each range


Key = tuple[bool, int, int]


def _key(doc_id: int | None, tie: int) -> Key:
    """Sorts like the files: null ids first."""
    return doc_id is not None, doc_id or 0, tie


def _boundaries(keys: DataFrame, ranges: int) -> list[Key]:
    """Upper bounds of ranges of (doc_id, tie), from a sample of at most about 100 rows a range.

    They only set how evenly tasks are loaded; an id that holds many rows is cut by its ties.
    """
    rows = keys.count()
    share = min(1.0, _SAMPLE * ranges / max(1, rows))
    picked = keys.where(F.pmod(F.xxhash64("doc_id", "tie"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    sample = sorted(_key(r["doc_id"], r["tie"]) for r in picked.limit(4 * _SAMPLE * ranges).collect())
    return [sample[len(sample) * i // ranges] for i in range(1, ranges)] if sample else []


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 0,
    ranges: int | None = None,
    percentile: float = 0.95,
    id_column: str = "doc_id",
    text_column: str = "text",
    added_tokens: bool = False,
) -> None:
    """Write every document's ids and ``end_id`` in ascending order of document ids.

    A null or empty text is its end id alone. Null ids come first. Rows with equal ids
    stay whole and adjacent, in the order they were read. An empty table
    writes no record. ``ranges`` defaults to the shuffle partitions.
    With ``added_tokens`` the strings of a tokenizer's added tokens get their ids, as the
    library does by default; otherwise they are ordinary text.
    """
    spark = docs.sparkSession
    texts = id_and_text(docs, id_column, text_column).withColumn("tie", F.monotonically_increasing_id())
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = _boundaries(texts.select("doc_id", "tie"), ranges)

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = byte_level_ids(tokenizer, added_tokens)
        kind = ids_of.kind if end_id <= np.iinfo(ids_of.kind).max else np.dtype("<u4")
        end = np.array([end_id], kind).tobytes()
        for batch, slice_texts in text_slices(batches):
            doc_ids, ties = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            part = [bisect_left(bounds, _key(d, t)) for d, t in zip(doc_ids, ties)]
            ids = [ids_of(t) for t in slice_texts]
            if kind != ids_of.kind:
                ids = [np.frombuffer(i, ids_of.kind).astype(kind).tobytes() for i in ids]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(0),
                    "tie": batch.column(2),
                    "part": pa.array(part, pa.int32()),
                    "width": pa.array([kind.itemsize] * len(ids), pa.int32()),
                    "ids": pa.array([i + end for i in ids], pa.binary()),
                }
            )

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, np.ndarray]] = []
        size = first = file_no = range_no = 0

        def close() -> pa.RecordBatch:
            nonlocal held, size, first, file_no
            file = TokenFile(
                range_no, file_no, first, [d for d, _ in held],
                np.array([len(i) for _, i in held], np.uint32), np.concatenate([i for _, i in held]).astype(np.uint32),
            )
            first, file_no, held, size = first + size, file_no + 1, [], 0
            return pa.RecordBatch.from_pydict({"content": pa.array([file.to_bytes(percentile)], pa.binary())})

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "part", "width", "ids"))
            for doc_id, part, width, ids in zip(*columns):
                range_no = part
                held.append((doc_id, np.frombuffer(ids, f"<u{width}")))
                size += len(held[-1][1])
                if size >= FILE_IDS:
                    yield close()
        if held:
            yield close()

    encoded = texts.mapInArrow(encode, "doc_id bigint, tie bigint, part int, width int, ids binary")
    ordered = encoded.repartitionById(ranges, F.col("part")).sortWithinPartitions("doc_id", "tie")
    files = ordered.mapInArrow(write, "content binary")
    files.select(F.col("content").cast("string")).write.option("lineSep", _TRAILER).option(
        "maxRecordsPerFile", 1
    ).option("compression", "none").text(path)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, if asked for, ids.

    The ranges' first positions come from the files' headers: one number for each range.
    """
    files = spark.read.format("binaryFile").load(path).where("length > 1").select("content")

    def number(at: int) -> Column:
        return F.conv(F.hex(F.substring("content", at, 8)), 16, 10).cast("bigint")

    totals = files.select(number(RANGE_AT).alias("part"), number(COUNT_AT).alias("n"))
    totals = totals.groupBy("part").agg(F.sum("n").alias("n"))
    counted = sorted((r["part"], r["n"]) for r in totals.collect())  # one row a range
    before = dict(zip([p for p, _ in counted], accumulate([0, *[n for _, n in counted]])))

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                file = TokenFile.from_bytes(content.as_buffer().to_pybytes())
                ends = np.cumsum(file.lengths.astype(np.int64))
                starts = ends - file.lengths
                ids = file.ids.astype("<u4")
                crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts.tolist(), ends.tolist())]
                columns = {
                    "doc_id": pa.array(file.doc_ids, pa.int64()),
                    "start": pa.array(starts + file.first + before[file.range_no], pa.int64()),
                    "n_tokens": pa.array(file.lengths.astype(np.int64), pa.int64()),
                    "ids_crc32": pa.array(crcs, pa.int64()),
                }
                if with_ids:
                    offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32), pa.int32())
                    columns["ids"] = pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32), pa.int32()))
                yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    return files.mapInArrow(decode, schema + ", ids array<int>" * with_ids)
