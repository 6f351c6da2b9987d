"""Scans, projections, filters, sorts, splits and exports of record tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from formlake.functions.text import elapsed_text
from formlake.operators import columns as col_ops
from formlake.operators import verbs
from formlake.operators.audit import stamp_text
from formlake.operators.chunks import number_sorted
from formlake.operators.forms import split_forms, split_forms_labeled
from formlake.operators.ids import restrict_to_ids
from formlake.operators.narrowing import as_text, narrow
from formlake.plans.catalogue.projects import (
    CUSTOMER_PROJECT_SQL,
    FAMILY_PROJECT_SQL,
    customer_dictionary,
    customer_project,
    family_project,
    lineitem_dictionary,
)
from formlake.plans.catalogue.registry import query, table
from formlake.session import scratch_path
from formlake.sinks.inspect import inspect
from formlake.sinks.parquet import publish_views, save_parquet, save_query
from formlake.sources.csv_files import append_aligned, read_csv_text
from formlake.sources.export_folder import read_folder

_CSV_WRITE = {"header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false",
              "ignoreTrailingWhiteSpace": "false"}


@query("""
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(ts AS VARCHAR) AS ts,
       CAST(user_id AS VARCHAR) AS user_id, event_type, CAST(value AS VARCHAR) AS value, props
FROM events
""")
def scan_text_landing(spark, folder):
    """CSV exports read back with every column as text."""
    path = scratch_path(spark, "csv")
    as_text(table(spark, folder, "events")).write.options(**_CSV_WRITE).csv(path)
    return read_csv_text(spark, path)


@query("""
SELECT CAST(doc_id AS VARCHAR) AS doc_id,
       nullif(nullif(trim("text", ' ' || chr(9)), ''), 'NA') AS "text",
       nullif(nullif(trim(lang, ' ' || chr(9)), ''), 'NA') AS lang,
       nullif(nullif(trim(source, ' ' || chr(9)), ''), 'NA') AS source,
       CAST(n_chars AS VARCHAR) AS n_chars
FROM documents
""")
def scan_export_folder(spark, folder):
    """Whole texts with quotes and line breaks through the folder data source."""
    path = scratch_path(spark, "csv")
    as_text(table(spark, folder, "documents")).write.options(**_CSV_WRITE).csv(path)
    return read_folder(spark, path)


@query("SELECT * FROM customer")
def table_scan(spark, folder):
    return table(spark, folder, "customer")


@query("SELECT count(*) AS n FROM lineitem")
def table_row_count(spark, folder):
    return table(spark, folder, "lineitem").agg(F.count("*").alias("n"))


@query("""
SELECT * FROM (VALUES
  (0, 'l_orderkey', 'INTEGER', FALSE, CAST(NULL AS VARCHAR), FALSE),
  (1, 'l_partkey', 'INTEGER', FALSE, NULL, FALSE),
  (2, 'l_suppkey', 'INTEGER', FALSE, NULL, FALSE),
  (3, 'l_linenumber', 'INTEGER', FALSE, NULL, FALSE),
  (4, 'l_quantity', 'DOUBLE', FALSE, NULL, FALSE),
  (5, 'l_extendedprice', 'DOUBLE', FALSE, NULL, FALSE),
  (6, 'l_discount', 'DOUBLE', FALSE, NULL, FALSE),
  (7, 'l_tax', 'DOUBLE', FALSE, NULL, FALSE),
  (8, 'l_returnflag', 'VARCHAR', FALSE, NULL, FALSE),
  (9, 'l_linestatus', 'VARCHAR', FALSE, NULL, FALSE),
  (10, 'l_shipdate', 'TIMESTAMP', FALSE, NULL, FALSE)
) AS t(cid, name, type, "notnull", dflt_value, pk)
""")
def inspect_schema(spark, folder):
    """Columns of the narrowed line items, whose types follow from all of their cells."""
    return inspect(narrow(as_text(table(spark, folder, "lineitem"))))


@query(f"SELECT record_id, name, balance FROM ({CUSTOMER_PROJECT_SQL})")
def project_fields(spark, folder):
    return col_ops.project_fields(customer_project(spark, folder), ["name", "balance"], "record_id")


@query(f"""
SELECT record_id, balance, flag___1, flag___2, finance_and_risk_complete
FROM ({CUSTOMER_PROJECT_SQL})
""")
def project_forms(spark, folder):
    return col_ops.project_forms(
        customer_project(spark, folder), customer_dictionary(spark, folder), ["finance_and_risk"]
    )


@query(f"""
SELECT record_id, name, nation, segment, balance, flag___1, flag___2, profile_complete,
       finance_and_risk_complete, project_survey_identifier, profile_timestamp, project_event_name
FROM ({FAMILY_PROJECT_SQL})
""")
def project_column_families(spark, folder):
    """Survey columns asked for, access groups not."""
    return col_ops.project_families(
        family_project(spark, folder), customer_dictionary(spark, folder), survey_fields=True
    )


@query(f"""
SELECT record_id, name, nullif(greatest(balance, 0), 0) AS balance, profile_complete,
       CASE WHEN balance < 0 THEN 0 ELSE flag___1 END AS flag___1,
       CASE WHEN balance > 0 THEN finance_and_risk_complete END AS finance_and_risk_complete
FROM ({CUSTOMER_PROJECT_SQL})
""")
def blank_gray_status(spark, folder):
    """A form's status is blank where none of its fields has a value."""
    records = customer_project(spark, folder)
    touched = records.withColumns(
        {
            "flag___1": F.when(F.col("balance") < 0, 0).otherwise(F.col("flag___1")),
            "balance": F.nullif(F.greatest("balance", F.lit(0)), F.lit(0)),
        }
    )
    shown = col_ops.blank_gray_status(touched, customer_dictionary(spark, folder), "record_id")
    return shown.select(
        "record_id", "name", "balance", "profile_complete", "flag___1", "finance_and_risk_complete"
    )


@query(f"SELECT name, segment FROM ({CUSTOMER_PROJECT_SQL})")
def select_columns(spark, folder):
    return verbs.select_fields(customer_project(spark, folder), "name", "segment")


@query(f"SELECT record_id, name, segment FROM ({CUSTOMER_PROJECT_SQL})")
def select_keep_record_id(spark, folder):
    return verbs.select_fields(
        customer_project(spark, folder),
        "name",
        "segment",
        dictionary=customer_dictionary(spark, folder),
        keep_record_id=True,
    )


@query(f"SELECT * FROM ({CUSTOMER_PROJECT_SQL}) WHERE segment = 'BUILDING'")
def filter_equals(spark, folder):
    return verbs.filter_rows(customer_project(spark, folder), F.col("segment") == "BUILDING")


@query(f"SELECT * FROM ({CUSTOMER_PROJECT_SQL}) WHERE flag___2 = 1 AND profile_complete <> 0")
def filter_logic(spark, folder):
    return col_ops.filter_logic(
        customer_project(spark, folder), "flag___2 = 1 AND profile_complete <> 0"
    )


@query("SELECT * FROM orders WHERE o_orderdate > '1996-03-01' AND o_orderdate < '1998-07-01'")
def filter_datetime_range(spark, folder):
    return col_ops.filter_modified(
        table(spark, folder, "orders"), "o_orderdate", "1996-03-01 00:00:00", "1998-07-01 00:00:00"
    )


@query("SELECT * FROM orders WHERE o_orderdate > '1999-12-31'")
def filter_datetime_open(spark, folder):
    return col_ops.filter_modified(
        table(spark, folder, "orders"), "o_orderdate", begin="1999-12-31 00:00:00"
    )


@query("""
SELECT l_orderkey, l_linenumber, l_quantity,
       'visit_' || CAST(l_linenumber AS VARCHAR) AS study_event_name
FROM lineitem WHERE l_linenumber IN (1, 3)
""")
def filter_events(spark, folder):
    records = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        F.concat(F.lit("visit_"), F.col("l_linenumber").cast("string")).alias("study_event_name"),
    )
    return col_ops.filter_events(records, ["visit_1", "visit_3"])


@query("""
SELECT * FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')
""")
def filter_record_ids(spark, folder):
    ids = table(spark, folder, "orders").filter("o_orderpriority = '1-URGENT'")
    return restrict_to_ids(
        table(spark, folder, "lineitem"),
        ids.select(F.col("o_orderkey").alias("l_orderkey")),
        "l_orderkey",
    )


@query("""
SELECT c_custkey, c_nationkey, c_acctbal FROM
  (SELECT *, avg(c_acctbal) OVER (PARTITION BY c_nationkey) AS m FROM customer)
WHERE c_acctbal < m
""")
def grouped_filter_below_mean(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return verbs.below_group_mean(customer, ["c_nationkey"], "c_acctbal")


@query("""
SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity FROM
  (SELECT *, avg(l_quantity) OVER (PARTITION BY l_returnflag, l_linestatus) AS m FROM lineitem)
WHERE l_quantity < m
""")
def grouped_filter_large_groups(spark, folder):
    """Groups that each hold a large share of the rows."""
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_quantity"
    )
    return verbs.below_group_mean(rows, ["l_returnflag", "l_linestatus"], "l_quantity").drop(
        "l_linestatus"
    )


@query("""
SELECT l_returnflag, round(avg(l_extendedprice), 6) AS mean_price FROM lineitem GROUP BY 1
""")
def group_mean(spark, folder):
    means = verbs.group_mean(
        table(spark, folder, "lineitem"), ["l_returnflag"], "l_extendedprice", "mean_price"
    )
    return means.withColumn("mean_price", F.round("mean_price", 6))


@query("""
SELECT c_custkey, nullif(c_nationkey, 3) AS nation,
       row_number() OVER (ORDER BY nullif(c_nationkey, 3) DESC NULLS LAST, c_custkey) AS row_position
FROM customer
""")
def arrange_nulls_last(spark, folder):
    rows = table(spark, folder, "customer").select(
        "c_custkey", F.nullif("c_nationkey", F.lit(3)).alias("nation")
    )
    # Positions are those of the sorted table, so they show its order.
    return number_sorted(verbs.arrange(rows, "nation", "c_custkey", descending=[True, False]))


@query(f"SELECT record_id, name, nation, segment, profile_complete FROM ({CUSTOMER_PROJECT_SQL})")
def instrument_split(spark, folder):
    forms = split_forms(customer_project(spark, folder), customer_dictionary(spark, folder))
    return forms["profile"]


@query(f"""
SELECT record_id, balance, flag___1, flag___2, finance_and_risk_complete
FROM ({CUSTOMER_PROJECT_SQL})
""")
def instrument_split_second_form(spark, folder):
    forms = split_forms(customer_project(spark, folder), customer_dictionary(spark, folder))
    return forms["finance_and_risk"]


@query(f"SELECT record_id, balance, flag___2 FROM ({CUSTOMER_PROJECT_SQL})")
def instrument_split_selected(spark, folder):
    """Only columns present in the table come back."""
    chosen = customer_project(spark, folder).select("flag___2", "record_id", "balance", "segment")
    return split_forms(chosen, customer_dictionary(spark, folder))["finance_and_risk"]


@query(f"""
SELECT record_id, balance,
       CASE WHEN flag___1 = 1 THEN 'Overdrawn' END AS flag___1,
       CASE WHEN flag___2 = 1 THEN 'High balance' END AS flag___2,
       CASE finance_and_risk_complete WHEN 0 THEN 'Incomplete' WHEN 1 THEN 'Unverified'
         ELSE 'Complete' END AS finance_and_risk_complete
FROM ({CUSTOMER_PROJECT_SQL})
""")
def instrument_split_labeled(spark, folder):
    forms = split_forms_labeled(customer_project(spark, folder), customer_dictionary(spark, folder))
    return forms["finance_and_risk"]


@query(f"""
SELECT record_id, name, coalesce(n_name, CAST(nation AS VARCHAR)) AS nation,
       CASE segment WHEN 'AUTOMOBILE' THEN 'Cars' WHEN 'BUILDING' THEN 'Construction, housing'
         WHEN 'MACHINERY' THEN 'Machines' ELSE segment END AS segment,
       CASE profile_complete WHEN 0 THEN 'Incomplete' WHEN 1 THEN 'Unverified'
         ELSE 'Complete' END AS profile_complete
FROM ({CUSTOMER_PROJECT_SQL}) LEFT JOIN nation ON nation = n_nationkey
""")
def instrument_split_labeled_profile(spark, folder):
    """The other form; segments without a label keep their code."""
    forms = split_forms_labeled(customer_project(spark, folder), customer_dictionary(spark, folder))
    return forms["profile"]


@query("""
SELECT l_orderkey, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem
""")
def instrument_split_longitudinal(spark, folder):
    """Several rows per record ID split without a shuffle."""
    forms = split_forms(table(spark, folder, "lineitem"), lineitem_dictionary(spark))
    return forms["pricing"]


@query(f"SELECT segment, count(*) AS n FROM ({CUSTOMER_PROJECT_SQL}) GROUP BY segment")
def instrument_views(spark, folder):
    """Forms published as views and queried by name."""
    forms = split_forms(customer_project(spark, folder), customer_dictionary(spark, folder))
    publish_views(forms, prefix="split_")
    return spark.sql("SELECT segment, count(*) AS n FROM split_profile GROUP BY segment")


@query("SELECT * FROM customer")
def save_parquet_table(spark, folder):
    path = scratch_path(spark, "export")
    save_parquet(table(spark, folder, "customer"), path)
    return spark.read.parquet(path)


@query("""
SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM orders GROUP BY o_orderstatus
""")
def save_parquet_query(spark, folder):
    path = scratch_path(spark, "export")
    table(spark, folder, "orders").createOrReplaceTempView("export_orders")
    save_query(
        spark,
        "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total "
        "FROM export_orders GROUP BY o_orderstatus",
        path,
    )
    return spark.read.parquet(path)


@query("""
SELECT o_orderkey, o_custkey, o_totalprice,
       CASE WHEN o_orderdate >= '1998-01-01' THEN o_orderpriority END AS o_orderpriority
FROM orders
""")
def append_schema_align(spark, folder):
    """A later load brings a column that the earlier one lacks."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderdate"
    )
    early = orders.filter("o_orderdate < '1998-01-01'").drop("o_orderpriority", "o_orderdate")
    late = orders.filter("o_orderdate >= '1998-01-01'").drop("o_orderdate")
    return append_aligned(early, late)


@query("""
SELECT o_orderkey,
       CASE WHEN s < 60 THEN CAST(CAST(round_even(s, 0) AS BIGINT) AS VARCHAR) || 's'
            ELSE CAST(CAST(floor(s / 60) AS BIGINT) AS VARCHAR) || 'm ' ||
                 CAST(CAST(round_even(s % 60, 0) AS BIGINT) AS VARCHAR) || 's' END AS elapsed
FROM (SELECT o_orderkey, o_totalprice / 500 AS s FROM orders)
""", name="elapsed_text")
def elapsed_time_text(spark, folder):
    orders = table(spark, folder, "orders")
    return orders.select("o_orderkey", elapsed_text(F.col("o_totalprice") / 500).alias("elapsed"))


@query("""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day,
       CAST(o_orderdate AS DATE) - 6 AS six_days_before,
       CAST(datediff('day', CAST(o_orderdate AS DATE), DATE '2001-08-01') AS INTEGER) AS days_left,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS stamp,
       strftime(o_orderdate - INTERVAL 1 SECOND, '%Y-%m-%d %H:%M:%S') AS second_before
FROM orders
""")
def date_functions(spark, folder):
    stamp, day = F.col("o_orderdate"), F.col("o_orderdate").cast("date")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        day.alias("day"),
        F.date_sub(day, 6).alias("six_days_before"),
        F.datediff(F.lit("2001-08-01").cast("date"), day).alias("days_left"),
        stamp_text(stamp).alias("stamp"),
        stamp_text(stamp - F.expr("interval 1 second")).alias("second_before"),
    )


@query("""
SELECT p_partkey, regexp_matches(p_brand, '#[0-9]+$') AS numbered,
       regexp_replace(p_brand, '#[0-9]+$', '') AS base,
       string_split(p_name, ' ')[1] AS first_word,
       CAST(instr(p_brand, '#') AS INTEGER) AS mark_at,
       substr(p_brand, instr(p_brand, '#') + 1) AS number,
       trim('  ' || p_type || ' ') AS trimmed,
       CAST(length(p_name) AS INTEGER) AS n_chars,
       p_brand || ', ' || p_type AS joined,
       lower(p_type) AS lowered,
       lpad(CAST(p_size AS VARCHAR), 4, '0') AS padded,
       p_name LIKE 'small%' AS small
FROM part
""")
def string_functions(spark, folder):
    brand = F.col("p_brand")
    return table(spark, folder, "part").select(
        "p_partkey",
        brand.rlike(r"#[0-9]+\z").alias("numbered"),
        F.regexp_replace(brand, "#[0-9]+$", "").alias("base"),
        F.get(F.split("p_name", " "), F.lit(0)).alias("first_word"),
        F.instr(brand, "#").alias("mark_at"),
        F.substr(brand, F.instr(brand, "#") + 1).alias("number"),
        F.trim(F.concat(F.lit("  "), "p_type", F.lit(" "))).alias("trimmed"),
        F.length("p_name").alias("n_chars"),
        F.concat_ws(", ", brand, "p_type").alias("joined"),
        F.lower("p_type").alias("lowered"),
        F.lpad(F.col("p_size").cast("string"), 4, "0").alias("padded"),
        F.col("p_name").like("small%").alias("small"),
    )


@query("""
SELECT c_custkey, coalesce(s, 'none') AS segment, s IS NULL AS missing,
       CASE WHEN s IS NULL THEN 'blank' ELSE 'filled' END AS kind
FROM (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS s FROM customer)
""")
def null_functions(spark, folder):
    segment = F.nullif("c_mktsegment", F.lit("BUILDING"))
    return table(spark, folder, "customer").select(
        "c_custkey",
        F.coalesce(segment, F.lit("none")).alias("segment"),
        segment.isNull().alias("missing"),
        F.when(segment.isNull(), "blank").otherwise("filled").alias("kind"),
    )
