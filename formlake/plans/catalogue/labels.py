"""Column labels, value labels and decoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from formlake.operators import labels as L
from formlake.operators.dictionary import conform
from formlake.operators.lookup import attach
from formlake.plans.catalogue.dictionary import _BLANKS_SQL, CHOICE_ROWS_SQL
from formlake.plans.catalogue.projects import (
    _dictionary,
    CUSTOMER_PROJECT_SQL,
    PART_COLUMNS_SQL,
    PART_DICTIONARY_SQL,
    customer_dictionary,
    customer_project,
    lineitem_dictionary,
    part_columns,
    part_dictionary,
)
from formlake.plans.catalogue.registry import query, table

_STATUS_SQL = """CASE {0} WHEN 0 THEN 'Incomplete' WHEN 1 THEN 'Unverified'
         WHEN 2 THEN 'Complete' END"""

_SEGMENT_SQL = """CASE segment WHEN 'AUTOMOBILE' THEN 'Cars'
         WHEN 'BUILDING' THEN 'Construction, housing' WHEN 'MACHINERY' THEN 'Machines'
         ELSE segment END"""

_FULL_SQL = f"""
SELECT record_id, name, coalesce(n_name, CAST(nation AS VARCHAR)) AS nation,
       {_SEGMENT_SQL} AS segment, balance,
       CASE WHEN flag___1 = 1 THEN 'Overdrawn' END AS flag___1,
       CASE WHEN flag___2 = 1 THEN 'High balance' END AS flag___2,
       {_STATUS_SQL.format('profile_complete')} AS profile_complete,
       {_STATUS_SQL.format('finance_and_risk_complete')} AS finance_and_risk_complete
FROM ({CUSTOMER_PROJECT_SQL}) LEFT JOIN nation ON nation = n_nationkey
"""

# Choices of the part dictionary with the fields they belong to.
_CHOICES_SQL = CHOICE_ROWS_SQL.format(source=PART_DICTIONARY_SQL, blanks=_BLANKS_SQL)

# Each column name with its dictionary row, its kind and the choice its name stands for.
_DESCRIBED_SQL = f"""
WITH d AS ({PART_DICTIONARY_SQL}), choices AS ({_CHOICES_SQL}),
named AS (
  SELECT column_name, regexp_matches(column_name, '___[0-9]+$') AS is_choice,
         regexp_replace(column_name, '___[0-9]+$', '') AS base,
         regexp_replace(column_name, '^.*___', '') AS code
  FROM ({PART_COLUMNS_SQL})),
described AS (
  SELECT n.column_name, n.base, n.code, d.field_label,
         CASE WHEN d.field_name IS NULL THEN 'status' WHEN n.is_choice THEN 'checkbox'
              ELSE 'regular' END AS kind, c.label AS chosen
  FROM named n LEFT JOIN d ON n.base = d.field_name
  LEFT JOIN (SELECT field_name, code, arg_min(label, position) AS label
             FROM choices GROUP BY 1, 2) c
    ON n.is_choice AND c.field_name = n.base AND c.code = n.code)
"""


@query(_DESCRIBED_SQL + """
SELECT column_name, kind,
       CASE kind
         WHEN 'status' THEN 'Complete? Forms of Brand and ' ||
           regexp_extract(column_name, '_and_(.*)_complete$', 1)
         WHEN 'checkbox' THEN CASE WHEN field_label <> '' THEN
           field_label || ' (' || coalesce(chosen, 'Choice ' || code) || ')' END
         ELSE nullif(field_label, '') END AS label
FROM described
""")
def column_labels(spark, folder):
    """Labels for every column name, against a dictionary of one field per part."""
    described = L.describe_columns(part_columns(spark, folder), part_dictionary(spark, folder))
    return described.select("column_name", "kind", "label")


@query(_DESCRIBED_SQL + """
, listed AS (
  SELECT column_name, 0 AS position, code, chosen AS label, TRUE AS one
  FROM described WHERE kind = 'checkbox' AND chosen IS NOT NULL
  UNION ALL
  SELECT d.column_name, c.position, c.code, c.label, FALSE
  FROM described d JOIN choices c ON d.kind = 'regular' AND c.field_name = d.column_name
  UNION ALL
  SELECT column_name, u.p, u.c, u.l, FALSE FROM described,
    (VALUES (1, '0', 'Incomplete'), (2, '1', 'Unverified'), (3, '2', 'Complete')) AS u(p, c, l)
  WHERE kind = 'status')
SELECT column_name,
       string_agg(CASE WHEN one THEN '1' ELSE code END || '=' || label, ' | ' ORDER BY position)
         AS value_labels
FROM listed GROUP BY column_name
""")
def value_labels(spark, folder):
    """Codes and labels of every coded column, written out."""
    described = L.describe_columns(part_columns(spark, folder), part_dictionary(spark, folder))
    written = F.transform("value_labels", lambda v: F.concat(v["code"], F.lit("="), v["label"]))
    return described.filter("value_labels IS NOT NULL").select(
        "column_name", F.array_join(written, " | ").alias("value_labels")
    )


@query(f"""
SELECT 'nation' AS column_name, max(nation IN (SELECT n_nationkey FROM nation)) AS present
FROM ({CUSTOMER_PROJECT_SQL})
UNION ALL
SELECT 'segment', max(segment IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY'))
FROM ({CUSTOMER_PROJECT_SQL})
UNION ALL SELECT 'balance', max(CAST(balance AS VARCHAR) IN ('round([balance]'))
FROM ({CUSTOMER_PROJECT_SQL})
""")
def coded_value_guard(spark, folder):
    """Which coded columns hold any of their codes; a formula's junk code never occurs."""
    records = customer_project(spark, folder)
    known = L.column_labels(spark, records.columns, customer_dictionary(spark, folder))
    coded = {
        n: [c for c, _ in k.value_labels]
        for n, k in known.items()
        if k.kind == "regular" and k.value_labels
    }
    present = L.coded_columns(records, coded)
    return spark.createDataFrame(list(present.items()), "column_name string, present boolean")


@query("""
SELECT c_custkey, coalesce(n_name, CAST(c_nationkey AS VARCHAR)) AS nation
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
""")
def decode_numeric(spark, folder):
    records = table(spark, folder, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"))
    return L.label(records, customer_dictionary(spark, folder))


@query("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Filled'
                   ELSE o_orderstatus END AS o_orderstatus
FROM orders
""")
def decode_text(spark, folder):
    """A code that the list leaves out keeps its text."""
    dictionary = spark.createDataFrame(
        [("o_orderstatus", "order", "radio", "Status", "O, Open | F, Filled")],
        "field_name string, form_name string, field_type string, field_label string, "
        "select_choices_or_calculations string",
    )
    records = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return L.label(records, conform(dictionary))


@query("""
SELECT l_orderkey, l_partkey,
       CASE l_linenumber WHEN 1 THEN 'First' WHEN 2 THEN 'Second' WHEN 3 THEN 'Third'
         ELSE CAST(l_linenumber AS VARCHAR) END AS l_linenumber,
       l_quantity,
       CASE l_returnflag WHEN 'A' THEN 'Accepted' WHEN 'N' THEN 'Not returned'
         ELSE l_returnflag END AS l_returnflag,
       CASE l_linestatus WHEN 'F' THEN 'Filled' WHEN 'O' THEN 'Open'
         ELSE l_linestatus END AS l_linestatus
FROM lineitem
""")
def decode_longitudinal(spark, folder):
    """Numeric and text codes of longitudinal records, with codes left out of the lists."""
    records = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus"
    )
    return L.label(records, lineitem_dictionary(spark))


@query("""
SELECT o_orderkey, coalesce(c_name, CAST(o_custkey AS VARCHAR)) AS o_custkey
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) ON o_custkey = c_custkey
""")
def decode_by_table(spark, folder):
    """A code list that is itself a table and grows with the data."""
    codes = table(spark, folder, "customer").filter("c_acctbal >= 0")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return L.decode_by_table(orders, "o_custkey", codes, "c_custkey", "c_name")


@query("""
SELECT l_orderkey, l_linenumber, s_name FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey
""")
def lookup_shuffled(spark, folder):
    """The lookup's way beyond the broadcast bound: hot keys spread over salted copies."""
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_name"
    )
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return attach(rows, suppliers, ["l_suppkey"], rows=0).drop("l_suppkey")


@query("""
SELECT l_orderkey, l_linenumber, s_name FROM lineitem
LEFT JOIN supplier ON CASE WHEN l_linenumber <= 2 THEN 1 ELSE l_suppkey END = s_suppkey
""")
def lookup_hot_key(spark, folder):
    """About half of the rows have one key; it gets salts by its share."""
    suppliers = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("key"), "s_name")
    key = F.when(F.col("l_linenumber") <= 2, F.lit(1)).otherwise(F.col("l_suppkey")).alias("key")
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", key)
    return attach(rows, suppliers, ["key"], rows=0).drop("key")


@query("""
SELECT o_orderkey, coalesce(first_label, CAST(o_custkey AS VARCHAR)) AS o_custkey
FROM orders LEFT JOIN (
  SELECT o_custkey AS code, arg_min(o_orderpriority, o_orderkey) AS first_label
  FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) ON o_custkey = code
""")
def decode_first_label(spark, folder):
    """Codes with many labels: the first by the order column wins, not the least."""
    orders = table(spark, folder, "orders")
    codes = orders.filter("o_orderstatus = 'F'").select(
        F.col("o_custkey").alias("code"), F.col("o_orderpriority").alias("label"), "o_orderkey"
    )
    cells = orders.select("o_orderkey", "o_custkey")
    return L.decode_by_table(cells, "o_custkey", codes, order="o_orderkey")


@query(f"""
SELECT record_id, CASE WHEN flag___1 = 1 THEN 'Overdrawn' END AS flag___1,
       CASE WHEN flag___2 = 1 THEN 'High balance' END AS flag___2
FROM ({CUSTOMER_PROJECT_SQL})
""")
def decode_checkbox(spark, folder):
    records = customer_project(spark, folder).select("record_id", "flag___1", "flag___2")
    return L.label(records, customer_dictionary(spark, folder))


@query(f"""
SELECT record_id, {_STATUS_SQL.format('profile_complete')} AS profile_complete,
       {_STATUS_SQL.format('finance_and_risk_complete')} AS finance_and_risk_complete
FROM ({CUSTOMER_PROJECT_SQL})
""")
def decode_status(spark, folder):
    """Status codes as numbers in one form and as text in the other."""
    records = customer_project(spark, folder).select(
        "record_id",
        "profile_complete",
        F.col("finance_and_risk_complete").cast("string").alias("finance_and_risk_complete"),
    )
    return L.label(records, customer_dictionary(spark, folder))


@query(_FULL_SQL)
def labeled_full(spark, folder):
    """Labels on columns, codes decoded."""
    return L.label(customer_project(spark, folder), customer_dictionary(spark, folder))


@query(_FULL_SQL)
def labeled_values_decoded(spark, folder):
    """Codes decoded, columns without labels."""
    return L.label(customer_project(spark, folder), customer_dictionary(spark, folder), cols=False)


@query(CUSTOMER_PROJECT_SQL)
def labeled_vals_only(spark, folder):
    """Value labels as metadata, raw codes in the cells."""
    return L.label(
        customer_project(spark, folder), customer_dictionary(spark, folder), cols=False, convert=False
    )


@query(CUSTOMER_PROJECT_SQL)
def labeled_cols_only(spark, folder):
    """Without value labels there is nothing to decode."""
    return L.label(customer_project(spark, folder), customer_dictionary(spark, folder), vals=False)


@query(CUSTOMER_PROJECT_SQL)
def labeled_raw(spark, folder):
    """Both kinds of labels as metadata, raw codes in the cells."""
    return L.label(customer_project(spark, folder), customer_dictionary(spark, folder), convert=False)


@query("""
SELECT * FROM (VALUES
  (0, 'record_id', 'Customer number', CAST(NULL AS VARCHAR)),
  (1, 'name', 'Name', NULL),
  (2, 'nation', 'Home nation',
     (SELECT string_agg(CAST(n_nationkey AS VARCHAR) || '=' || n_name, ' | ' ORDER BY n_nationkey)
      FROM nation)),
  (3, 'segment', 'Market segment',
     'AUTOMOBILE=Cars | BUILDING=Construction, housing | MACHINERY=Machines'),
  (4, 'balance', 'Balance', NULL),
  (5, 'flag___1', 'Flags (Overdrawn)', '1=Overdrawn'),
  (6, 'flag___2', 'Flags (High balance)', '1=High balance'),
  (7, 'profile_complete', 'Complete? Profile', '0=Incomplete | 1=Unverified | 2=Complete'),
  (8, 'finance_and_risk_complete', 'Complete? Finance and Risk',
     '0=Incomplete | 1=Unverified | 2=Complete')
) AS t(column_position, column_name, label, value_labels)
""")
def label_metadata_rows(spark, folder):
    """The labels a labelled table carries, after the guard has read all its cells."""
    labelled = L.label(
        customer_project(spark, folder), customer_dictionary(spark, folder), convert=False
    )
    written = F.transform("value_labels", lambda v: F.concat(v["code"], F.lit("="), v["label"]))
    return L.label_rows(labelled).withColumn("value_labels", F.array_join(written, " | "))


# Beyond 2^53 neighbouring whole numbers are one double.
_LARGE = 2**53


@query(f"""
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_linenumber <= 3 THEN 'Line ' || CAST(l_linenumber AS VARCHAR)
            ELSE CAST(l_linenumber + {_LARGE} AS VARCHAR) END AS line,
       coalesce(o_orderpriority, CAST(l_orderkey + {_LARGE} AS VARCHAR)) AS parent,
       CASE WHEN l_linenumber IN (1, 2) THEN 'Deep ' || CAST(l_linenumber AS VARCHAR)
            ELSE CAST(CAST(l_linenumber AS DECIMAL(38, 0)) + 100000000000000000000 AS VARCHAR) END AS deep
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey AND o_orderkey % 2 = 1
""")
def decode_large_codes(spark, folder):
    """Codes of more than 53 bits, from a choice list and from a table; neighbours stay apart."""
    lines = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", f"l_linenumber + {_LARGE} AS line", f"l_orderkey + {_LARGE} AS parent",
        "cast(l_linenumber AS decimal(38,0)) + 100000000000000000000BD AS deep",
    )
    choices = " | ".join(f"{_LARGE + n}, Line {n}" for n in (1, 2, 3))
    deep = " | ".join(f"{10**20 + n}, Deep {n}" for n in (1, 2))
    dictionary = _dictionary(
        spark, [("line", "main", "radio", "Line", choices), ("deep", "main", "radio", "Deep", deep)]
    )
    codes = table(spark, folder, "orders").where("o_orderkey % 2 = 1")
    codes = codes.selectExpr(f"o_orderkey + {_LARGE} AS code", "o_orderpriority AS label")
    return L.decode_by_table(L.label(lines, dictionary), "parent", codes)
