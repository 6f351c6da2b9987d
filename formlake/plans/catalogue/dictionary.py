"""Dictionary scans and choice lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from formlake.functions.choices import choice_rows, choices_map, parse_choices
from formlake.functions.text import (
    choice_base,
    choice_code,
    is_choice_column,
    is_status_column,
    status_form,
    title_case,
)
from formlake.operators import dictionary as D
from formlake.plans.catalogue.projects import (
    EMPTY_COLUMNS_SQL,
    PART_COLUMNS_SQL,
    PART_DICTIONARY_SQL,
    part_columns,
    part_dictionary,
)
from formlake.plans.catalogue.registry import query, table
from formlake.session import scratch_path
from formlake.sources.csv_files import read_csv_text

_BLANKS_SQL = "' ' || chr(9) || chr(10) || chr(13)"

# Items of a choice list with a comma, in written order, split at the first comma.
CHOICE_ROWS_SQL = """
SELECT field_name, CAST(row_number() OVER (PARTITION BY field_name ORDER BY place) AS INTEGER)
         AS position,
       trim(split_part(item, ',', 1), {blanks}) AS code,
       trim(substr(item, instr(item, ',') + 1), {blanks}) AS label
FROM (SELECT field_name, unnest(items) AS item, generate_subscripts(items, 1) AS place
      FROM (SELECT field_name,
                   regexp_split_to_array(select_choices_or_calculations, '\\s*\\|\\s*') AS items
            FROM ({source}) WHERE select_choices_or_calculations IS NOT NULL))
WHERE contains(item, ',')
"""


@query(f"""
SELECT field_name, nullif(form_name, '') AS form_name, field_type,
       nullif(field_label, '') AS field_label,
       trim(select_choices_or_calculations) AS select_choices_or_calculations, {EMPTY_COLUMNS_SQL}
FROM ({PART_DICTIONARY_SQL})
""")
def dictionary_scan(spark, folder):
    """A dictionary export read as text into the fixed columns."""
    path = scratch_path(spark, "csv")
    part_dictionary(spark, folder).select(*D.DICTIONARY_COLUMNS).write.options(
        header="true", quote='"', escape='"'
    ).csv(path)
    return D.conform(read_csv_text(spark, path)).select(*D.DICTIONARY_COLUMNS)


@query(f"""
SELECT field_name, field_type, field_label FROM ({PART_DICTIONARY_SQL})
UNION ALL SELECT '__record_id_name__', 'config', 'field_0'
""")
def dictionary_config_row(spark, folder):
    d = D.with_config_row(part_dictionary(spark, folder), "field_0")
    return d.select("field_name", "field_type", "field_label")


@query(f"""
SELECT form_name, min(position) AS first_position, count(*) AS n_fields
FROM ({PART_DICTIONARY_SQL}) WHERE form_name <> '' GROUP BY form_name
""")
def dictionary_instruments(spark, folder):
    return D.forms_in_order(part_dictionary(spark, folder))


@query("""
SELECT 'field_' || CAST(max(p_partkey) AS VARCHAR) AS record_id_name FROM part
""")
def dictionary_record_id(spark, folder):
    """The record ID's name is read back from the row that stores it."""
    d = part_dictionary(spark, folder)
    last = d.agg(F.max_by("field_name", "position")).first()[0]
    return D.record_id_row(D.with_config_row(d, last))


@query("""
SELECT 'size_' || CAST(p_size AS VARCHAR) AS field_name, p_name AS field_label,
       p_partkey AS position
FROM (SELECT *, row_number() OVER (PARTITION BY p_size ORDER BY p_partkey) AS rn FROM part)
WHERE rn = 1
""")
def dictionary_first_match(spark, folder):
    """Field names that occur many times; the first row of each counts."""
    repeated = table(spark, folder, "part").select(
        F.concat(F.lit("size_"), F.col("p_size").cast("string")).alias("field_name"),
        F.col("p_name").alias("field_label"),
        F.col("p_partkey").alias("position"),
    )
    return D.first_entries(repeated).select("field_name", "field_label", "position")


@query(CHOICE_ROWS_SQL.format(source=PART_DICTIONARY_SQL, blanks=_BLANKS_SQL), name="parse_choices")
def parse_choice_lists(spark, folder):
    return choice_rows(
        part_dictionary(spark, folder), "select_choices_or_calculations", "field_name"
    )


_DOCUMENT_TEXTS_SQL = """
SELECT doc_id AS field_name, "text" AS select_choices_or_calculations FROM documents
"""


@query(CHOICE_ROWS_SQL.format(source=_DOCUMENT_TEXTS_SQL, blanks=_BLANKS_SQL))
def parse_choice_texts(spark, folder):
    """Whole documents read as choice lists: long texts, several scripts, line breaks."""
    documents = table(spark, folder, "documents").select(F.col("doc_id").alias("field_name"), "text")
    return choice_rows(documents, "text", "field_name")


@query(f"""
WITH c AS ({CHOICE_ROWS_SQL.format(source=PART_DICTIONARY_SQL, blanks=_BLANKS_SQL)})
SELECT field_name, CAST(count(DISTINCT code) AS INTEGER) AS n_codes,
       min(CASE WHEN code = '2' THEN label END) AS second,
       CAST(NULL AS VARCHAR) AS unknown
FROM (SELECT *, row_number() OVER (PARTITION BY field_name, code ORDER BY position) AS rn FROM c)
WHERE rn = 1 GROUP BY field_name
""")
def parse_choices_map(spark, folder):
    """Codes looked up in a map; a code that is not listed gives NULL."""
    choices = choices_map(parse_choices(F.col("select_choices_or_calculations")))
    d = part_dictionary(spark, folder).select("field_name", choices.alias("_map"))
    return d.filter("_map IS NOT NULL").select(
        "field_name",
        F.size("_map").alias("n_codes"),
        F.try_element_at("_map", F.lit("2")).alias("second"),
        F.try_element_at("_map", F.lit("none")).alias("unknown"),
    )


@query(f"""
SELECT column_name, regexp_matches(column_name, '_complete$') AS is_status,
       regexp_matches(column_name, '___[0-9]+$') AS is_choice,
       regexp_replace(column_name, '_complete$', '') AS form,
       regexp_replace(column_name, '___[0-9]+$', '') AS base,
       regexp_replace(column_name, '^.*___', '') AS code
FROM ({PART_COLUMNS_SQL})
""")
def column_name_parts(spark, folder):
    name = F.col("column_name")
    return part_columns(spark, folder).select(
        name,
        is_status_column(name).alias("is_status"),
        is_choice_column(name).alias("is_choice"),
        status_form(name).alias("form"),
        choice_base(name).alias("base"),
        choice_code(name).alias("code"),
    )


@query("""
SELECT p_partkey, upper(substr(w[1], 1, 1)) || substr(w[1], 2) || ' of the ' ||
       upper(substr(w[2], 1, 1)) || substr(w[2], 2) AS title
FROM (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part)
""")
def title_case_names(spark, folder):
    words = F.concat_ws(
        "_",
        F.get(F.split("p_name", " "), F.lit(0)),
        F.lit("of"),
        F.lit("the"),
        F.get(F.split("p_name", " "), F.lit(1)),
    )
    return table(spark, folder, "part").select("p_partkey", title_case(words).alias("title"))
