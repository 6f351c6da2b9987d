"""Structured Streaming twins, run to the end of what is available."""

from __future__ import annotations

from pyspark.sql import functions as F

from formlake.operators.narrowing import as_text
from formlake.plans.catalogue.projects import AUDIT_SQL, audit_log
from formlake.plans.catalogue.registry import query, table
from formlake.project import Project
from formlake.session import scratch_path
from formlake.streaming.audit import land_daily_counts, land_distinct_entries, read_daily_counts
from formlake.streaming.folder import land_available, stream_exports


@query("""
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(ts AS VARCHAR) AS ts,
       CAST(user_id AS VARCHAR) AS user_id, event_type, CAST(value AS VARCHAR) AS value, props
FROM events
""")
def stream_resume(spark, folder):
    """Exports dropped in two instalments, loaded in three runs; nothing lands twice."""
    events = as_text(table(spark, folder, "events"))
    drop, landed, state = (scratch_path(spark, n) for n in ("drop", "landed", "state"))
    options = {"header": "true", "quote": '"', "escape": '"'}
    early = F.col("ts") < "2024-01-15"
    events.filter(early).write.options(**options).csv(drop)
    for load in range(3):
        if load == 1:
            events.filter(~early).write.mode("append").options(**options).csv(drop)
        land_available(stream_exports(spark, drop, events.columns), landed, state)
    return spark.read.parquet(landed)


def _audit_stream(spark, folder, copies: int):
    """The audit log as a stream of files, each day's entries ``copies`` times."""
    drop = scratch_path(spark, "drop")
    log = audit_log(spark, folder)
    for _ in range(copies):
        log.write.mode("append").parquet(drop)
    return spark.readStream.schema(log.schema).parquet(drop)


def _log_project(spark) -> Project:
    return Project(spark, root=scratch_path(spark, "project"))


@query(f"SELECT DISTINCT * FROM ({AUDIT_SQL})")
def stream_audit_dedup(spark, folder):
    project = _log_project(spark)
    land_distinct_entries(_audit_stream(spark, folder, 2), project, scratch_path(spark, "state"))
    return project.audit()


@query(f"SELECT DISTINCT * FROM ({AUDIT_SQL})")
def stream_audit_late_days(spark, folder):
    """The newest days first, then the oldest, then all again; every entry once."""
    log, drop, state = audit_log(spark, folder), scratch_path(spark, "drop"), scratch_path(spark, "state")
    project, stamp = _log_project(spark), F.col("timestamp")
    for part in (stamp >= "2024-01-20", stamp < "2024-01-04", F.lit(True)):
        log.filter(part).write.mode("append").parquet(drop)
        land_distinct_entries(spark.readStream.schema(log.schema).parquet(drop), project, state)
    return project.audit()


@query(f"""
SELECT CAST("timestamp" AS DATE) AS day, count(*) AS n
FROM (SELECT DISTINCT * FROM ({AUDIT_SQL})) GROUP BY 1
""")
def stream_audit_daily_counts(spark, folder):
    """Counts of every day there is, the last ones like all others."""
    project, state = _log_project(spark), scratch_path(spark, "state")
    land_daily_counts(_audit_stream(spark, folder, 2), project, "daily_counts", state)
    return read_daily_counts(project, "daily_counts")
