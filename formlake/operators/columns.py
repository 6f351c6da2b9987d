"""Column families of an export: listed fields, forms, survey and group columns, form status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formlake.functions.text import CHOICE_MARK, STATUS_SUFFIX, stamp_literal
from formlake.operators.dictionary import conform
from formlake.operators.forms import form_columns

# Endings of the columns a source adds to a record table by itself.
SURVEY_ENDINGS = ("_survey_identifier", "_timestamp")
GROUP_ENDINGS = ("_data_access_group",)
EVENT_ENDINGS = ("_event_name",)


def project_fields(df: DataFrame, fields: list[str], record_id: str) -> DataFrame:
    """The record ID and the listed fields; a checkbox field stands for its choice columns."""
    names = [record_id]
    for name in fields:
        if name in df.columns:
            names.append(name)
        else:
            names += [c for c in df.columns if c.startswith(name + CHOICE_MARK)]
    return df.select(*[F.col(f"`{c}`") for c in dict.fromkeys(names)])


def project_forms(df: DataFrame, dictionary: DataFrame, forms: list[str]) -> DataFrame:
    """The record ID and the columns of the listed forms, in table order."""
    by_form = form_columns(df.columns, dictionary)
    kept = {c for form in forms for c in by_form.get(form, [])}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c in kept])


def project_families(
    df: DataFrame, dictionary: DataFrame, survey_fields: bool = False, access_groups: bool = False
) -> DataFrame:
    """Drop the survey and access-group columns unless they are asked for.

    A column that the dictionary knows as a field is never treated as one of them.
    """
    endings = (() if survey_fields else SURVEY_ENDINGS) + (() if access_groups else GROUP_ENDINGS)
    matching = [c for c in df.columns if endings and c.endswith(endings)]
    if matching:
        fields = (
            conform(dictionary).filter(F.col("field_name").isin(matching)).select("field_name")
        )
        own = {r[0] for r in fields.distinct().collect()}
        matching = [c for c in matching if c not in own]
    return df.drop(*matching)


def event_column(df: DataFrame) -> str | None:
    """The column naming the study event, if the table is longitudinal."""
    return next((c for c in df.columns if c.endswith(EVENT_ENDINGS)), None)


def filter_events(df: DataFrame, events: list[str], column: str | None = None) -> DataFrame:
    """Rows of the listed study events."""
    name = column or event_column(df)
    if name is None:
        raise ValueError("the table has no event column")
    return df.filter(F.col(f"`{name}`").isin(list(events)))


def blank_gray_status(df: DataFrame, dictionary: DataFrame, record_id: str) -> DataFrame:
    """Blank a form's status where every field of that form is missing.

    An unchecked checkbox counts as missing, since exports write 0 for it.
    """
    blanks = {}
    for form, names in form_columns(df.columns, dictionary).items():
        status = form + STATUS_SUFFIX
        fields = [c for c in names if c not in (record_id, status)]
        if status not in df.columns or not fields:
            continue
        cells = [
            F.nullif(F.col(f"`{c}`").cast("string"), F.lit("0"))
            if CHOICE_MARK in c
            else F.col(f"`{c}`").cast("string")
            for c in fields
        ]
        blanks[status] = F.when(F.coalesce(*cells).isNotNull(), F.col(f"`{status}`"))
    return df.select(
        *[
            blanks[f.name].alias(f.name, metadata=f.metadata)
            if f.name in blanks
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def filter_modified(df: DataFrame, column: str, begin=None, end=None) -> DataFrame:
    """Rows strictly after ``begin`` and strictly before ``end``; either side may be open."""
    if begin is not None:
        df = df.filter(F.col(column) > stamp_literal(begin))
    if end is not None:
        df = df.filter(F.col(column) < stamp_literal(end))
    return df


def filter_logic(df: DataFrame, predicate: str) -> DataFrame:
    """Rows where a Spark SQL predicate holds; an empty one keeps every row."""
    return df.filter(predicate) if predicate.strip() else df
