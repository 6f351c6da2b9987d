"""The audit log: whole-day ranges, day windows, daily counts, duplicates."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns of the audit log.
AUDIT_COLUMNS = ["timestamp", "username", "action", "details", "record", "project_id"]
AUDIT_SCHEMA = T.StructType(
    [
        T.StructField(c, T.TimestampNTZType() if c == "timestamp" else T.StringType())
        for c in AUDIT_COLUMNS
    ]
)
DEFAULT_DAYS_BACK = 6


def conform_audit(df: DataFrame) -> DataFrame:
    """The fixed columns, the time stamp typed and everything else text."""
    return df.select(
        *[
            (F.col(c) if c in df.columns else F.lit(None))
            .cast("timestamp_ntz" if c == "timestamp" else "string")
            .alias(c)
            for c in AUDIT_COLUMNS
        ]
    )


def default_range(today: date | None = None) -> tuple[date, date]:
    """Seven days ending today."""
    end = today or date.today()
    return end - timedelta(days=DEFAULT_DAYS_BACK), end


def audit_range(log: DataFrame, begin: date | str | None = None, end: date | str | None = None):
    """Entries of whole days, both end days included; without dates the last seven days."""
    first, last = default_range()
    begin_day = F.lit(str(begin or first)).cast("date")
    after = F.date_add(F.lit(str(end or last)).cast("date"), 1)
    stamp = F.col("timestamp")
    return log.filter(
        (stamp >= begin_day.cast("timestamp_ntz")) & (stamp < after.cast("timestamp_ntz"))
    )


def day_windows(bounds: DataFrame) -> DataFrame:
    """One row per day from ``begin`` to ``end`` with the first and last second of it."""
    day = F.explode(F.sequence(F.col("begin"), F.col("end"), F.expr("interval 1 day")))
    start = F.col("day").cast("timestamp_ntz")
    return bounds.select(day.alias("day")).select(
        "day",
        start.alias("begin_time"),
        (F.date_add("day", 1).cast("timestamp_ntz") - F.expr("interval 1 second")).alias("end_time"),
    )


def day_windows_between(spark: SparkSession, begin: date, end: date) -> DataFrame:
    bounds = spark.range(1).select(
        F.lit(str(begin)).cast("date").alias("begin"), F.lit(str(end)).cast("date").alias("end")
    )
    return day_windows(bounds)


def log_bounds(log: DataFrame) -> DataFrame:
    """First and last day that occur in the log."""
    day = F.col("timestamp").cast("date")
    return log.agg(F.min(day).alias("begin"), F.max(day).alias("end"))


def daily_counts(log: DataFrame) -> DataFrame:
    return log.groupBy(F.col("timestamp").cast("date").alias("day")).agg(F.count("*").alias("n"))


def daily_counts_all_days(log: DataFrame) -> DataFrame:
    """Day windows of the log's own range with their number of entries, quiet days too."""
    return (
        day_windows(log_bounds(log))
        .join(daily_counts(log), "day", "left")
        .withColumn("n", F.coalesce("n", F.lit(0)))
    )


def distinct_entries(log: DataFrame) -> DataFrame:
    """Each entry once, however often its day was requested."""
    return log.dropDuplicates(AUDIT_COLUMNS)


def stamp_text(stamp: Column) -> Column:
    """Time stamps as the source's requests write them."""
    return F.date_format(stamp, "yyyy-MM-dd HH:mm:ss")
