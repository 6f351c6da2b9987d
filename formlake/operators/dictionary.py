"""The data dictionary: one row per field, plus a row naming the record ID column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Dictionary columns in file order.
DICTIONARY_COLUMNS = [
    "field_name", "form_name", "section_header", "field_type", "field_label",
    "select_choices_or_calculations", "field_note",
    "text_validation_type_or_show_slider_number", "text_validation_min",
    "text_validation_max", "identifier", "branching_logic", "required_field",
    "custom_alignment", "question_number", "matrix_group_name", "matrix_ranking",
    "field_annotation", "record_id_name",
]

# The row that stores the name of the record ID column.
CONFIG_FIELD = "__record_id_name__"
CONFIG_TYPE = "config"
DEFAULT_RECORD_ID = "record_id"

DICTIONARY_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in DICTIONARY_COLUMNS])

# Order of the rows in the export, kept beside the fixed columns.
POSITION = "position"


def conform(df: DataFrame) -> DataFrame:
    """The fixed columns as text, absent ones NULL, with the row position."""
    if POSITION in df.columns:
        position = F.col(POSITION).cast("bigint")
    else:
        position = F.monotonically_increasing_id()
    fixed = [
        (F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")).alias(c)
        for c in DICTIONARY_COLUMNS
    ]
    return df.select(*fixed, position.alias(POSITION))


def with_config_row(dictionary: DataFrame, record_id: str) -> DataFrame:
    """Append the row that stores the record ID column's name, in place of one already there."""
    row = {"field_name": CONFIG_FIELD, "field_type": CONFIG_TYPE, "field_label": record_id}
    config = (
        dictionary.sparkSession.range(1)
        .select(
            *[F.lit(row.get(c)).cast("string").alias(c) for c in DICTIONARY_COLUMNS],
            F.lit((1 << 62)).alias(POSITION),
        )
    )
    rest = conform(dictionary).filter(~F.col("field_name").eqNullSafe(CONFIG_FIELD))
    return rest.unionByName(config)


def first_entries(dictionary: DataFrame) -> DataFrame:
    """The first row of each field name, in export order.

    ``min_by`` combines before its shuffle, so a name repeated very often is safe.
    """
    d = conform(dictionary).filter("field_name IS NOT NULL")
    rest = [c for c in DICTIONARY_COLUMNS if c != "field_name"]
    return (
        d.groupBy("field_name")
        .agg(F.min_by(F.struct(*rest, POSITION), POSITION).alias("_entry"))
        .select("field_name", "_entry.*")
    )


def forms_in_order(dictionary: DataFrame) -> DataFrame:
    """Distinct non-blank form names with the position of their first field."""
    return (
        conform(dictionary)
        .filter("form_name IS NOT NULL AND form_name <> ''")
        .groupBy("form_name")
        .agg(F.min(POSITION).alias("first_position"), F.count("*").alias("n_fields"))
        .orderBy("first_position")
    )


def form_names(dictionary: DataFrame) -> list[str]:
    """Form names on the driver; their number is that of the project's forms."""
    return [r["form_name"] for r in forms_in_order(dictionary).select("form_name").collect()]


def record_id_row(dictionary: DataFrame) -> DataFrame:
    """One row, one column: the record ID column's name."""
    return (
        conform(dictionary)
        .filter(F.col("field_name") == CONFIG_FIELD)
        .agg(F.min_by("field_label", POSITION).alias("_name"))
        .select(F.coalesce("_name", F.lit(DEFAULT_RECORD_ID)).alias("record_id_name"))
    )


def record_id_name(dictionary: DataFrame) -> str:
    return record_id_row(dictionary).first()["record_id_name"]


def empty_dictionary(spark: SparkSession) -> DataFrame:
    return conform(spark.createDataFrame([], DICTIONARY_SCHEMA))
