"""The transfer log: append-only entries that also tell whether a load is complete."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formlake.functions.text import stamp_literal
from formlake.operators.chunks import ERROR, INFO
from formlake.operators.lookup import sort_spread

# Columns of the log and the messages its state is read from.
JOURNAL_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("type", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)
STARTED = "Transfer started"
COMPLETED = "Transfer completed in"


def now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class Journal:
    """Driver-side entries, buffered and appended once per stage."""

    def __init__(self, spark: SparkSession, append=None) -> None:
        self._spark, self._append, self._rows = spark, append, []

    def add(self, kind: str, message: str) -> None:
        if self._append is not None:
            self._rows.append((now(), kind, message))

    def add_many(self, entries: DataFrame) -> None:
        """Append a table of entries as it is, never through the driver."""
        if self._append is not None:
            self.flush()
            self._append(entries.select(*JOURNAL_SCHEMA.names))

    def flush(self) -> None:
        if self._rows:
            self._append(self._spark.createDataFrame(self._rows, JOURNAL_SCHEMA).coalesce(1))
            self._rows = []


def in_time_order(log: DataFrame) -> DataFrame:
    return sort_spread(log.select(*JOURNAL_SCHEMA.names), F.col("timestamp"))


def counts_by_type(log: DataFrame) -> DataFrame:
    return log.groupBy("type").agg(F.count("*").alias("n"))


def transfer_status(log: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Completions, errors and the resulting state, in one aggregation.

    ``complete`` needs a completion and no error; a completion with errors is
    ``resume_with_errors``; anything else is ``resume``.
    """
    done = (F.col("type") == INFO) & F.col("message").like(COMPLETED + "%")
    counted = log.groupBy(*(by or [])).agg(
        F.count_if(done).alias("completed"), F.count_if(F.col("type") == ERROR).alias("errors")
    )
    return counted.withColumn(
        "status",
        F.when((F.col("completed") > 0) & (F.col("errors") == 0), "complete")
        .when(F.col("completed") > 0, "resume_with_errors")
        .otherwise("resume"),
    )


def since_last_start(log: DataFrame) -> DataFrame:
    """Entries of the latest run only."""
    start = log.filter(F.col("message") == STARTED).agg(F.max("timestamp")).first()[0]
    return log if start is None else log.filter(F.col("timestamp") >= stamp_literal(start))
