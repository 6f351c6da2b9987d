"""Token counts by a piece vocabulary, from a two-tier lookup of pre-token lengths.

Tier one is a broadcast table of the frequent pre-tokens' lengths; tier two is a cache in
each Python worker, filled by the library. No pre-token is shuffled: every row is counted
where it is read.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formlake.llm.batches import id_and_text, text_slices
from formlake.llm.segments import SPACE_LED, SegmentCache
from formlake.llm.written import written

SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"


@lru_cache(maxsize=2)
def _library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=2)
def _cache(path: str) -> SegmentCache:
    encode = _library(path).encode
    # A line break never merges with what follows, nor with the space mark put in front.
    return SegmentCache(lambda segment: len(encode("\n" + segment)) - 2)


def _segments(text: str) -> list[str]:
    """The pre-tokens of a text behind the space that the library puts in front of it."""
    return SPACE_LED.findall(" " + text) if text else []


def frequent_pretokens(
    texts: DataFrame, entries: int = 32_768, sample_rows: int | None = None, longest: int = 48
) -> list[str]:
    """The most frequent pre-tokens of all rows, by exact counts.

    At most ``entries`` strings of ``longest`` characters, so the table that is broadcast
    has a fixed bound; one that occurs once is not frequent. It only decides where a length is
    looked up, never the length. A task hands its counts on whenever it holds many, and all
    are added up. With ``sample_rows`` only about so many rows are counted, by a hash of the row.
    """
    picked = texts.select("text")
    if sample_rows is not None:
        every = max(1, texts.count() // sample_rows)
        picked = texts.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(every)) == 0).select("text")

    def handed(seen: Counter[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {"segment": pa.array(seen.keys(), pa.string()), "n": pa.array(seen.values(), pa.int64())}
        )

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for _, slice_texts in text_slices(batches):
            seen.update(s for s in chain.from_iterable(map(_segments, slice_texts)) if len(s) <= longest)
            if len(seen) > 8 * entries:
                yield handed(seen)
                seen = Counter()
        yield handed(seen)

    counted = picked.mapInArrow(count, "segment string, n bigint").groupBy("segment").agg(F.sum("n").alias("n")).where("n > 1")
    counted = written(counted, "pretokens")
    # The counts' own distribution tells from which count on the entries fit: some hundred
    # rows, where a sort would send the top of every task to the driver.
    size = F.floor(F.log2("n") * 16).alias("size")
    least, fit = 0, 0
    for row in counted.groupBy(size).count().orderBy(F.desc("size")).collect():
        fit += row["count"]
        if fit > entries:
            least = row["size"] + 1
            break
    top = counted.where(size >= least).select("segment", "n").collect()
    return [row["segment"] for row in sorted(top, key=lambda row: (-row["n"], row["segment"]))]


def count_tokens(
    docs: DataFrame,
    model: str,
    limit: int = 4096,
    id_column: str = "doc_id",
    text_column: str = "text",
    entries: int = 32_768,
    sample_rows: int | None = None,
) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens, over_limit.

    A null or empty text has 0 bytes and 0 tokens; a null id stays null; repeated rows give
    repeated rows; other columns are not read. An empty table gives no rows.
    """
    texts = id_and_text(docs, id_column, text_column)
    spark = docs.sparkSession
    frequent = frequent_pretokens(texts, entries, sample_rows)
    lengths = [len(x) - 2 for x in _library(model).encode(["\n" + s for s in frequent], num_threads=1)]
    shared = spark.sparkContext.broadcast((frequent, bytes(lengths)))  # a pre-token has under 256 tokens

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _cache(model)
        cache.update(zip(*shared.value))
        for batch, texts in text_slices(batches):
            counts = [sum(map(cache.__getitem__, _segments(text))) for text in texts]
            sizes = pc.binary_length(batch.column(1)).cast(pa.int64())
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(0),
                    "n_bytes": sizes,
                    "n_tokens": pa.array(counts, pa.int64()),
                    "over_limit": pa.array([n > limit for n in counts], pa.bool_()),
                }
            )

    return texts.mapInArrow(count, SCHEMA)
