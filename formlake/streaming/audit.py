"""The audit log as a stream: every entry once, and daily counts, however late entries come.

Both keep their state in the landed table itself, by day: a batch reads only the days that
it brings entries for. A watermark would drop what is older than it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from formlake.operators.audit import AUDIT_COLUMNS, daily_counts
from formlake.operators.lookup import attach
from formlake.project import Project
from formlake.session import materialise

DAY = "day"
_ENTRY = "_entry"


def _marked(entries: DataFrame) -> DataFrame:
    """Entries with a digest of all their columns, nulls told apart from empty texts."""
    cells = F.to_json(F.struct(*[F.col(c).cast("string") for c in AUDIT_COLUMNS]))
    return entries.withColumn(_ENTRY, F.sha2(cells, 256))


def _landed_days(log: DataFrame, days: DataFrame) -> DataFrame:
    """Landed entries of the listed days; the list, one row a day, prunes the partitions."""
    listed = [r[DAY] for r in days.collect()]
    named = [day for day in listed if day is not None]
    undated = F.col(DAY).isNull() if None in listed else F.lit(False)
    return log.filter(F.col(DAY).isin(named) | undated) if named else log.filter(undated)


def land_new_entries(project: Project, batch: DataFrame) -> DataFrame:
    """Append the entries of a batch that have not landed yet; returns the days it touched.

    A batch that is run again finds its own entries landed.
    """
    fresh = _marked(batch.select(*AUDIT_COLUMNS).dropDuplicates())
    fresh = materialise(fresh.withColumn(DAY, F.col("timestamp").cast("date")))
    days = fresh.select(DAY).distinct()
    if project.exists(project.audit_log):
        landed = _landed_days(project.read(project.audit_log), days)
        known = materialise(_marked(landed.select(*AUDIT_COLUMNS)).select(_ENTRY).distinct())
        fresh = attach(fresh, known, [_ENTRY], "left_anti")
    project.write(fresh.drop(_ENTRY), project.audit_log, "append", DAY)
    return days


def _each_batch(stream: DataFrame, checkpoint: str, handle) -> StreamingQuery:
    query = (
        stream.writeStream.foreachBatch(lambda batch, _: handle(batch))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def land_distinct_entries(stream: DataFrame, project: Project, checkpoint: str) -> StreamingQuery:
    """Land every available entry once in the project's audit log, days in any order."""
    return _each_batch(stream, checkpoint, lambda batch: land_new_entries(project, batch))


def land_daily_counts(
    stream: DataFrame, project: Project, counts: str, checkpoint: str
) -> StreamingQuery:
    """Land entries and keep the table ``counts`` (n by day) right for every day so far.

    Days are counted again when entries come for them, the last ones like all others.
    """

    def handle(batch: DataFrame) -> None:
        days = land_new_entries(project, batch)
        log = _landed_days(project.read(project.audit_log), days)
        project.replace_partitions(daily_counts(log), counts, DAY)

    return _each_batch(stream, checkpoint, handle)


def read_daily_counts(project: Project, counts: str) -> DataFrame:
    return project.read(counts).select(DAY, "n")
