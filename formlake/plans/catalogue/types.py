"""Type narrowing of all-text tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from formlake.operators.narrowing import as_text, narrow, profile_report, profile_types
from formlake.plans.catalogue.registry import query, table

# The SQL twins of the text patterns.
_DATE = r"^[0-9]{4}[-/][0-9]{1,2}[-/][0-9]{1,2}$"
_STAMP = (
    r"^[0-9]{4}[-/][0-9]{1,2}[-/][0-9]{1,2}"
    r"[ T][0-9]{1,2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?$"
)


def _profile_sql(text_sql: str) -> str:
    """Per column, the first type that every non-missing, non-blank cell fits."""
    return f"""
WITH cells AS (UNPIVOT ({text_sql}) ON COLUMNS(*) INTO NAME column_name VALUE v),
checks AS (
  SELECT column_name, count(*) AS n_present, count_if(v = '') AS n_blank,
    count_if(v <> '' AND NOT regexp_matches(v, '^-?[0-9]+$')) AS bad_int,
    count_if(regexp_matches(v, '^-?[0-9]+$') AND TRY_CAST(v AS INTEGER) IS NULL) AS big,
    count_if(v <> '' AND NOT regexp_matches(v, '^-?[0-9]+(\\.[0-9]+)?$')) AS bad_num,
    count_if(v <> '' AND NOT (regexp_matches(v, '{_DATE}')
      AND TRY_CAST(v AS DATE) IS NOT NULL)) AS bad_date,
    count_if(v <> '' AND NOT (regexp_matches(v, '{_DATE}') OR regexp_matches(v, '{_STAMP}'))
      OR v <> '' AND TRY_CAST(v AS TIMESTAMP) IS NULL) AS bad_stamp
  FROM cells GROUP BY column_name),
named AS (
  SELECT *, CASE WHEN bad_int = 0 THEN 'INTEGER' WHEN bad_num = 0 THEN 'DOUBLE'
    WHEN bad_date = 0 THEN 'DATE' WHEN bad_stamp = 0 THEN 'TIMESTAMP'
    ELSE 'VARCHAR' END AS candidate FROM checks)
SELECT column_name, n_present, n_blank, candidate,
  CASE WHEN n_blank > 0 OR (candidate = 'INTEGER' AND big > 0) THEN 'VARCHAR'
       ELSE candidate END AS final_type,
  CASE WHEN candidate <> 'VARCHAR' AND (n_blank > 0 OR (candidate = 'INTEGER' AND big > 0))
       THEN 'WARNING' ELSE 'INFO' END AS level
FROM named
"""


_REPORTED = ["column_name", "n_present", "n_blank", "candidate", "final_type", "level"]


@query(_profile_sql(
    "SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(ts AS VARCHAR) AS ts, "
    "CAST(user_id AS VARCHAR) AS user_id, event_type, CAST(value AS VARCHAR) AS value, props "
    "FROM events"
))
def type_profile(spark, folder):
    events = as_text(table(spark, folder, "events"))
    return profile_report(spark, profile_types(events)).select(*_REPORTED)


@query(_profile_sql("""
SELECT CASE WHEN event_type = 'error' THEN '' ELSE CAST(event_id AS VARCHAR) END AS with_blanks,
  CAST(event_id * 1000000 AS VARCHAR) AS beyond_32_bits,
  CASE WHEN event_type = 'view' THEN CAST(CAST(ts AS DATE) AS VARCHAR)
       ELSE CAST(ts AS VARCHAR) END AS dates_and_times,
  replace(CAST(CAST(ts AS DATE) AS VARCHAR), '-', '/') AS slashed_dates,
  CASE WHEN event_type = 'click' THEN 'n/a' ELSE CAST(user_id AS VARCHAR) END AS mixed,
  CASE WHEN event_type = 'click' THEN CAST(user_id AS VARCHAR)
       ELSE CAST(value AS VARCHAR) END AS whole_and_decimal
FROM events
"""))
def type_fallback(spark, folder):
    """Blank cells and 32-bit overflow keep a column as text with a warning."""
    kind, event = F.col("event_type"), F.col("event_id").cast("string")
    day = F.col("ts").cast("date").cast("string")
    text = table(spark, folder, "events").select(
        F.when(kind == "error", "").otherwise(event).alias("with_blanks"),
        (F.col("event_id") * 1000000).cast("string").alias("beyond_32_bits"),
        F.when(kind == "view", day).otherwise(F.col("ts").cast("string")).alias("dates_and_times"),
        F.translate(day, "-", "/").alias("slashed_dates"),
        F.when(kind == "click", "n/a").otherwise(F.col("user_id").cast("string")).alias("mixed"),
        F.when(kind == "click", F.col("user_id").cast("string"))
        .otherwise(F.col("value").cast("string"))
        .alias("whole_and_decimal"),
    )
    return profile_report(spark, profile_types(text)).select(*_REPORTED)


@query("""
SELECT CAST(l_orderkey AS INTEGER) AS l_orderkey, CAST(l_partkey AS INTEGER) AS l_partkey,
       CAST(l_suppkey AS INTEGER) AS l_suppkey, l_linenumber, l_quantity, l_extendedprice,
       l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
FROM lineitem
""")
def type_optimize(spark, folder):
    return narrow(as_text(table(spark, folder, "lineitem")))


@query("""
SELECT CAST(event_id AS INTEGER) AS event_id, CAST(ts AS DATE) AS day, ts,
       CAST(event_id * 1000000 AS BIGINT) AS big, value
FROM events
""")
def type_optimize_options(spark, folder):
    """Dates beside time stamps, slashed dates, and integers beyond 32 bits as BIGINT."""
    stamp = F.col("ts")
    text = table(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.translate(stamp.cast("date").cast("string"), "-", "/").alias("day"),
        stamp.cast("string").alias("ts"),
        (F.col("event_id") * 1000000).cast("string").alias("big"),
        F.col("value").cast("string").alias("value"),
    )
    return narrow(text, overflow="bigint")
