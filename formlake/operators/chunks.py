"""Chunks of record IDs, their status, and the figures of a transfer."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formlake.operators.ids import distinct_ids
from formlake.session import materialise, scratch_path

DEFAULT_CHUNK_SIZE = 1000

# Kinds of log entries, also used as chunk statuses.
INFO, SUCCESS, WARNING, ERROR = "INFO", "SUCCESS", "WARNING", "ERROR"

_ROW_BITS = 33  # monotonically_increasing_id keeps the partition above these bits


def number_rows(df: DataFrame, *order: str, name: str = "row_position") -> DataFrame:
    """Number rows from 1 in sorted order without gathering them in one partition.

    The sorted rows are checkpointed with their place inside the partition; one
    count per partition then gives each partition's offset.
    """
    return number_sorted(df.orderBy(*order), name)


def number_sorted(df: DataFrame, name: str = "row_position") -> DataFrame:
    """Number the rows of a table from 1 in the order it has."""
    placed = materialise(df.withColumn("_place", F.monotonically_increasing_id()))
    partition = F.shiftright("_place", _ROW_BITS)
    counts = placed.groupBy(partition.alias("_part")).count().orderBy("_part").collect()
    before = [0, *accumulate(r["count"] for r in counts)]
    offsets = df.sparkSession.createDataFrame(
        [(r["_part"], b) for r, b in zip(counts, before)], "_part bigint, _before bigint"
    )
    within = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1
    # One offset per partition of the sort.
    return (
        placed.withColumn("_part", partition)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + within)
        .drop("_part", "_before", "_place")
    )


def assign_chunks(
    ids: DataFrame,
    record_id: str,
    chunk_size: int = DEFAULT_CHUNK_SIZE,
    already_distinct: bool = False,
) -> DataFrame:
    """Distinct IDs with their chunk number; a chunk holds at most ``chunk_size`` IDs."""
    once = ids.select(record_id) if already_distinct else distinct_ids(ids, record_id)
    numbered = number_rows(once, record_id)
    return numbered.select(
        record_id, F.ceil(F.col("row_position") / F.lit(chunk_size)).cast("int").alias("chunk")
    )


def laid_out_in_waves(chunks: DataFrame, wave_chunks: int) -> DataFrame:
    """Numbered IDs with the wave of their chunk (from 0), written once with a partition for each wave.

    IDs are numbered in sorted order, so a task has rows of few waves, and reading one wave
    opens that wave's files alone.
    """
    path = scratch_path(chunks.sparkSession, "waves")
    wave = F.floor((F.col("chunk") - 1) / wave_chunks).cast("int").alias("wave")
    chunks.select("*", wave).write.partitionBy("wave").parquet(path)
    schema = f"{chunks._jdf.schema().toDDL()}, wave int"
    return chunks.sparkSession.read.schema(schema).parquet(path)


def chunk_label(chunk: Column) -> Column:
    """Chunk number as written in log messages."""
    text = chunk.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(4)), F.lit("0"))


def delivered_status(rows: DataFrame, chunks: DataFrame, record_id: str) -> DataFrame:
    """Status of each chunk from the rows that arrived for its IDs.

    Rows are counted per ID before the join, so an ID with very many rows meets
    its chunk as one row.
    """
    return counted_status(rows.groupBy(record_id).agg(F.count("*").alias("n_rows")), chunks, record_id)


def counted_status(counts: DataFrame, chunks: DataFrame, record_id: str) -> DataFrame:
    """Status of each chunk from the ``n_rows`` of each ID that arrived."""
    per_id = counts.select(record_id, F.col("n_rows").alias("_rows"))
    return (
        chunks.join(per_id, record_id, "left")
        .groupBy("chunk")
        .agg(
            F.count("*").alias("n_ids"),
            F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias("n_rows"),
        )
        .withColumn("status", F.when(F.col("n_rows") > 0, SUCCESS).otherwise(ERROR))
        .withColumn("error", F.when(F.col("n_rows") == 0, "returned no data"))
    )


def chunk_messages(status: DataFrame) -> DataFrame:
    """The log entry of each chunk, beside its status."""
    label = chunk_label(F.col("chunk"))
    done = F.concat(
        F.lit("Chunk "), label, F.lit(": "), F.col("n_rows").cast("string"), F.lit(" rows"),
    )
    failed = F.concat(
        F.lit("Chunk "), label, F.lit(": failed, "),
        F.coalesce(F.col("error"), F.lit("unknown error")),
    )
    return status.select(
        "*",
        F.col("status").alias("type"),
        F.when(F.col("status") == SUCCESS, done).otherwise(failed).alias("message"),
    )


def failed_ids(chunks: DataFrame, status: DataFrame, record_id: str) -> DataFrame:
    """IDs of the chunks that failed."""
    failed = status.filter(F.col("status") == ERROR).select("chunk")
    return chunks.join(failed, "chunk", "left_semi").select(record_id, "chunk")


def tallies(status: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Figures of a transfer, or of several told apart by the ``by`` columns."""
    ok, bad = F.col("status") == SUCCESS, F.col("status") == ERROR
    timed = [F.sum("seconds").alias("seconds")] if "seconds" in status.columns else []
    return status.groupBy(*(by or [])).agg(
        F.count("*").alias("n_chunks"),
        F.count_if(ok).alias("successful_chunks"),
        F.count_if(bad).alias("failed_chunks"),
        F.coalesce(F.sum(F.when(ok, F.col("n_rows"))), F.lit(0)).cast("bigint").alias("rows"),
        *timed,
    )


def outcome(figures: DataFrame) -> DataFrame:
    """Success flag and closing message for tallied transfers."""
    count = F.col("n_chunks").cast("string")
    parts = [
        F.lit(" with "), F.col("successful_chunks").cast("string"), F.lit(" of "), count,
        F.lit(" chunks successful, "), F.col("failed_chunks").cast("string"), F.lit(" failed"),
    ]
    failed = F.col("failed_chunks") > 0
    nothing = F.col("n_chunks") == 0
    return figures.withColumn("success", ~failed & ~nothing).withColumn(
        "message",
        F.when(nothing, F.lit("Transfer of nothing"))
        .when(failed, F.concat(F.lit("Transfer incomplete"), *parts))
        .otherwise(F.concat(F.lit("Transfer completed"), *parts)),
    )
