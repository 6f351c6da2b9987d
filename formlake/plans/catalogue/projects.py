"""Projects that Spark derives from the given tables, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formlake.functions.text import elapsed_text
from formlake.operators.dictionary import DICTIONARY_COLUMNS, conform, with_config_row
from formlake.plans.catalogue.registry import table

# --- customers as a project of two forms ------------------------------------------

SEGMENT_CHOICES = "AUTOMOBILE, Cars | BUILDING, Construction, housing | MACHINERY, Machines"
FLAG_CHOICES = "1, Overdrawn | 2, High balance"

CUSTOMER_PROJECT_SQL = """
SELECT c_custkey AS record_id, c_name AS name, c_nationkey AS nation,
       c_mktsegment AS segment, c_acctbal AS balance,
       CAST(c_acctbal < 0 AS INTEGER) AS flag___1,
       CAST(c_acctbal > 5000 AS INTEGER) AS flag___2,
       CAST(c_custkey % 3 AS INTEGER) AS profile_complete,
       CAST((c_custkey + 1) % 3 AS INTEGER) AS finance_and_risk_complete
FROM customer
"""


def customer_project(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        key.alias("record_id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
        (F.col("c_acctbal") < 0).cast("int").alias("flag___1"),
        (F.col("c_acctbal") > 5000).cast("int").alias("flag___2"),
        (key % 3).cast("int").alias("profile_complete"),
        ((key + 1) % 3).cast("int").alias("finance_and_risk_complete"),
    )


def _dictionary(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    schema = (
        "position int, field_name string, form_name string, field_type string, "
        "field_label string, select_choices_or_calculations string"
    )
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema)


def customer_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    """Choices of ``nation`` come from the nation table."""
    listed = table(spark, folder, "nation").agg(
        F.array_join(
            F.transform(
                F.sort_array(F.collect_list(F.struct("n_nationkey", "n_name"))),
                lambda n: F.concat(n["n_nationkey"].cast("string"), F.lit(", "), n["n_name"]),
            ),
            " | ",
        ).alias("_nations")
    )
    rows = _dictionary(
        spark,
        [
            ("record_id", "profile", "text", "Customer number", None),
            ("name", "profile", "text", "Name", None),
            ("nation", "profile", "radio", "Home nation", None),
            ("segment", "profile", "radio", "Market segment", SEGMENT_CHOICES),
            ("balance", "finance_and_risk", "calc", "Balance", "round([balance], 2)"),
            ("flag", "finance_and_risk", "checkbox", "Flags", FLAG_CHOICES),
        ],
    )
    # The one-row list of choices belongs to one dictionary row.
    keyed = listed.select(F.lit("nation").alias("field_name"), "_nations")
    filled = rows.join(F.broadcast(keyed), "field_name", "left").select(
        "position",
        "field_name",
        "form_name",
        "field_type",
        "field_label",
        F.coalesce("_nations", "select_choices_or_calculations").alias(
            "select_choices_or_calculations"
        ),
    )
    return with_config_row(filled, "record_id")


FAMILY_PROJECT_SQL = f"""
SELECT *, 'survey_' || CAST(record_id AS VARCHAR) AS project_survey_identifier,
       CAST('2024-01-01' AS VARCHAR) AS profile_timestamp,
       'group_' || CAST(nation AS VARCHAR) AS project_data_access_group,
       'visit_' || CAST(profile_complete AS VARCHAR) AS project_event_name
FROM ({CUSTOMER_PROJECT_SQL})
"""


def family_project(spark: SparkSession, folder: str) -> DataFrame:
    """The customer project with the columns a source adds by itself."""
    return customer_project(spark, folder).select(
        "*",
        F.concat(F.lit("survey_"), F.col("record_id").cast("string")).alias(
            "project_survey_identifier"
        ),
        F.lit("2024-01-01").alias("profile_timestamp"),
        F.concat(F.lit("group_"), F.col("nation").cast("string")).alias(
            "project_data_access_group"
        ),
        F.concat(F.lit("visit_"), F.col("profile_complete").cast("string")).alias(
            "project_event_name"
        ),
    )


# --- line items as longitudinal records -------------------------------------------

RETURN_CHOICES = "A, Accepted | N, Not returned"
LINE_CHOICES = "1, First | 2, Second | 3, Third"


def lineitem_dictionary(spark: SparkSession) -> DataFrame:
    rows = _dictionary(
        spark,
        [
            ("l_orderkey", "shipment", "text", "Order", None),
            ("l_linenumber", "shipment", "radio", "Line", LINE_CHOICES),
            ("l_returnflag", "shipment", "radio", "Returned?", RETURN_CHOICES),
            ("l_linestatus", "shipment", "radio", "Line status", "F, Filled | O, Open"),
            ("l_shipdate", "shipment", "text", "Shipped on", None),
            ("l_quantity", "pricing", "text", "Quantity", None),
            ("l_extendedprice", "pricing", "text", "Extended price", None),
            ("l_discount", "pricing", "text", "Discount", None),
            ("l_tax", "pricing", "text", "Tax", None),
        ],
    )
    return with_config_row(rows, "l_orderkey")


# --- a dictionary that grows: one field per part ----------------------------------

PART_DICTIONARY_SQL = """
SELECT p_partkey AS position,
       'field_' || CAST(p_partkey AS VARCHAR) AS field_name,
       CASE WHEN p_size = 2 THEN '' ELSE 'forms_of_' || replace(lower(p_brand), '#', '_and_')
       END AS form_name,
       CASE p_size % 3 WHEN 0 THEN 'checkbox' WHEN 1 THEN 'radio' ELSE 'text' END AS field_type,
       CASE WHEN p_size = 5 THEN '' ELSE p_name END AS field_label,
       CASE WHEN p_size % 3 = 2 THEN NULL ELSE
         '1, ' || p_type || ' |2,' || p_brand || ', ' || p_name || ' | none |  '
         || CAST(p_size AS VARCHAR) || ' , size  '
       END AS select_choices_or_calculations
FROM part
"""


def part_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    size, text = F.col("p_size"), F.col("p_size").cast("string")
    kind = F.when(size % 3 == 0, "checkbox").when(size % 3 == 1, "radio").otherwise("text")
    form = F.concat(F.lit("forms_of_"), F.replace(F.lower("p_brand"), F.lit("#"), F.lit("_and_")))
    choices = F.concat(
        F.lit("1, "), "p_type", F.lit(" |2,"), "p_brand", F.lit(", "), "p_name",
        F.lit(" | none |  "), text, F.lit(" , size  "),
    )
    return conform(
        table(spark, folder, "part").select(
            F.col("p_partkey").alias("position"),
            F.concat(F.lit("field_"), F.col("p_partkey").cast("string")).alias("field_name"),
            F.when(size == 2, "").otherwise(form).alias("form_name"),
            kind.alias("field_type"),
            F.when(size == 5, "").otherwise(F.col("p_name")).alias("field_label"),
            F.when(size % 3 != 2, choices).alias("select_choices_or_calculations"),
        )
    )


# A SQL column list for the fixed dictionary columns that the part dictionary leaves empty.
EMPTY_COLUMNS_SQL = ", ".join(
    f"CAST(NULL AS VARCHAR) AS {c}"
    for c in DICTIONARY_COLUMNS
    if c
    not in (
        "field_name", "form_name", "field_type", "field_label", "select_choices_or_calculations",
    )
)

PART_COLUMNS_SQL = """
SELECT 'field_' || CAST(p_partkey AS VARCHAR) ||
       CASE WHEN p_size % 3 = 0 THEN '___' || CAST(u.n AS VARCHAR) ELSE '' END AS column_name
FROM part, (VALUES (1), (2), (7)) AS u(n)
WHERE p_size % 3 = 0 OR u.n = 1
UNION
SELECT 'forms_of_' || replace(lower(p_brand), '#', '_and_') || '_complete' FROM part
"""


def part_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Column names of a table with the part dictionary's fields."""
    part = table(spark, folder, "part")
    name = F.concat(F.lit("field_"), F.col("p_partkey").cast("string"))
    marks = F.when(F.col("p_size") % 3 == 0, F.array(F.lit("___1"), F.lit("___2"), F.lit("___7")))
    fields = part.select(name.alias("_f"), F.explode(F.coalesce(marks, F.array(F.lit("")))).alias("_m"))
    form = F.concat(F.lit("forms_of_"), F.replace(F.lower("p_brand"), F.lit("#"), F.lit("_and_")))
    status = part.select(F.concat(form, F.lit("_complete")).alias("column_name")).distinct()
    return fields.select(F.concat("_f", "_m").alias("column_name")).unionByName(status)


# --- events as transfer log and audit log -----------------------------------------

JOURNAL_SQL = """
SELECT ts AS "timestamp",
       CASE event_type WHEN 'view' THEN 'SUCCESS' WHEN 'click' THEN 'WARNING'
                       WHEN 'error' THEN 'ERROR' ELSE 'INFO' END AS type,
       CASE event_type
         WHEN 'purchase' THEN 'Transfer completed in ' ||
           CASE WHEN value < 60 THEN CAST(CAST(round_even(value, 0) AS BIGINT) AS VARCHAR) || 's'
           ELSE CAST(CAST(floor(value / 60) AS BIGINT) AS VARCHAR) || 'm ' ||
                CAST(CAST(round_even(value % 60, 0) AS BIGINT) AS VARCHAR) || 's' END
         WHEN 'signup' THEN 'Transfer started'
         ELSE event_type || ' ' || props END AS message,
       user_id
FROM events
"""


def journal(spark: SparkSession, folder: str) -> DataFrame:
    """Events read as transfer logs, one project per user."""
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        F.col("ts").alias("timestamp"),
        F.when(kind == "view", "SUCCESS")
        .when(kind == "click", "WARNING")
        .when(kind == "error", "ERROR")
        .otherwise("INFO")
        .alias("type"),
        F.when(
            kind == "purchase",
            F.concat(F.lit("Transfer completed in "), elapsed_text(F.col("value"))),
        )
        .when(kind == "signup", "Transfer started")
        .otherwise(F.concat_ws(" ", kind, "props"))
        .alias("message"),
        "user_id",
    )


AUDIT_SQL = """
SELECT ts AS "timestamp", 'user_' || CAST(user_id AS VARCHAR) AS username,
       event_type AS action, props AS details, CAST(user_id AS VARCHAR) AS record,
       '1' AS project_id
FROM events
"""


def audit_log(spark: SparkSession, folder: str) -> DataFrame:
    user = F.col("user_id").cast("string")
    return table(spark, folder, "events").select(
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("user_"), user).alias("username"),
        F.col("event_type").alias("action"),
        F.col("props").alias("details"),
        user.alias("record"),
        F.lit("1").alias("project_id"),
    )
