"""Transfer log and audit log."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from formlake.operators import audit as A
from formlake.operators import journal as J
from formlake.operators.chunks import number_sorted
from formlake.operators.lookup import attach
from formlake.plans.catalogue.projects import AUDIT_SQL, JOURNAL_SQL, audit_log, journal
from formlake.plans.catalogue.registry import query

_STATUS_SQL = """
  count_if(type = 'INFO' AND message LIKE 'Transfer completed in%') AS completed,
  count_if(type = 'ERROR') AS errors,
  CASE WHEN count_if(type = 'INFO' AND message LIKE 'Transfer completed in%') = 0 THEN 'resume'
       WHEN count_if(type = 'ERROR') = 0 THEN 'complete'
       ELSE 'resume_with_errors' END AS status
"""


@query(f"""
SELECT "timestamp", type, message, rank() OVER (ORDER BY "timestamp") AS time_rank FROM ({JOURNAL_SQL})
""")
def transfer_log_scan(spark, folder):
    """The log with the place of each time stamp in it, taken from the sorted log itself."""
    placed = number_sorted(J.in_time_order(journal(spark, folder)))
    first = placed.groupBy("timestamp").agg(F.min("row_position").alias("time_rank"))
    return attach(placed.drop("row_position"), first, ["timestamp"])


@query(f"""
SELECT * FROM ({AUDIT_SQL})
WHERE "timestamp" >= TIMESTAMP '2024-01-09' AND "timestamp" < TIMESTAMP '2024-01-16'
""")
def audit_log_default_range(spark, folder):
    """The seven days up to a given today."""
    begin, end = A.default_range(today=date(2024, 1, 15))
    return A.audit_range(audit_log(spark, folder), begin, end)


@query(f"SELECT user_id, {_STATUS_SQL} FROM ({JOURNAL_SQL}) GROUP BY user_id")
def transfer_log_status(spark, folder):
    """State of many projects' loads, one per user."""
    return J.transfer_status(journal(spark, folder), by=["user_id"])


@query(f"""
SELECT {_STATUS_SQL} FROM ({JOURNAL_SQL}) WHERE "timestamp" >=
  (SELECT max("timestamp") FROM ({JOURNAL_SQL}) WHERE message = 'Transfer started')
""")
def transfer_log_last_run(spark, folder):
    return J.transfer_status(J.since_last_start(journal(spark, folder)))


@query(f"SELECT type, count(*) AS n FROM ({JOURNAL_SQL}) GROUP BY type")
def transfer_log_counts_by_type(spark, folder):
    return J.counts_by_type(journal(spark, folder))


@query(AUDIT_SQL)
def audit_log_scan(spark, folder):
    return A.conform_audit(audit_log(spark, folder))


@query(f"""
SELECT * FROM ({AUDIT_SQL})
WHERE "timestamp" >= TIMESTAMP '2024-01-05' AND "timestamp" < TIMESTAMP '2024-01-12'
""")
def audit_log_range(spark, folder):
    return A.audit_range(audit_log(spark, folder), "2024-01-05", "2024-01-11")


@query(f"""
WITH days AS (SELECT unnest(generate_series(min(CAST("timestamp" AS DATE)),
                max(CAST("timestamp" AS DATE)), INTERVAL 1 DAY)) AS d FROM ({AUDIT_SQL}))
SELECT CAST(d AS DATE) AS day, CAST(d AS TIMESTAMP) AS begin_time,
       CAST(d AS TIMESTAMP) + INTERVAL 1 DAY - INTERVAL 1 SECOND AS end_time
FROM days
""")
def audit_log_day_windows(spark, folder):
    """One request window per day of the range the log covers."""
    return A.day_windows(A.log_bounds(audit_log(spark, folder)))


@query(f"""
SELECT CAST("timestamp" AS DATE) AS day, count(*) AS n FROM ({AUDIT_SQL}) GROUP BY 1
""")
def audit_log_daily_counts(spark, folder):
    counts = A.daily_counts_all_days(audit_log(spark, folder))
    return counts.select("day", "n")


@query(f"SELECT DISTINCT * FROM ({AUDIT_SQL})")
def audit_log_dedup(spark, folder):
    """Days requested twice land once."""
    log = audit_log(spark, folder)
    again = log.filter(F.col("timestamp") >= "2024-01-10")
    return A.distinct_entries(log.unionByName(again))
