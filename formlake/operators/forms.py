"""Split a wide record table into one DataFrame per form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formlake.functions.text import CHOICE_MARK, STATUS_SUFFIX
from formlake.operators.dictionary import CONFIG_FIELD, DEFAULT_RECORD_ID, conform
from formlake.operators.labels import _possible_fields, label


def form_columns(columns: list[str], dictionary: DataFrame) -> dict[str, list[str]]:
    """Form name to its columns among ``columns``, forms in dictionary order.

    A form gets the record ID, its fields, its checkbox columns and its status.
    Only dictionary rows that can concern the given columns are collected.
    """
    wanted = sorted({f for c in columns for f in _possible_fields(c)})
    field = F.struct(
        "position",
        "field_name",
        F.coalesce(F.col("field_type") == "checkbox", F.lit(False)).alias("checkbox"),
    )
    forms = (
        conform(dictionary)
        .withColumn("_config", F.col("field_name") == CONFIG_FIELD)
        .filter("_config OR form_name <> ''")
        .groupBy("_config", "form_name")
        .agg(
            F.min("position").alias("first_position"),
            F.min_by("field_label", "position").alias("first_label"),
            F.sort_array(F.collect_set(F.when(F.col("field_name").isin(wanted), field))).alias("fields"),
        )
        .orderBy("first_position")
        .collect()
    )
    named = [f["first_label"] for f in forms if f["_config"] and f["first_label"]]
    record_id = named[0] if named else DEFAULT_RECORD_ID
    present = set(columns)
    out: dict[str, list[str]] = {}
    for row in forms:
        if row["_config"]:
            continue
        form, own = row["form_name"], row["fields"]
        names = [record_id, *(f["field_name"] for f in own)]
        for f in own:
            if f["checkbox"]:
                names += [c for c in columns if c.startswith(f["field_name"] + CHOICE_MARK)]
        names.append(form + STATUS_SUFFIX)
        kept = [n for n in dict.fromkeys(names) if n in present]
        if kept:
            out[form] = kept
    return out


def split_forms(
    df: DataFrame,
    dictionary: DataFrame | None,
    cols: bool = False,
    vals: bool = False,
    convert: bool = False,
    guard: str = "data",
) -> dict[str, DataFrame]:
    """One lazy projection per form; labels first if any flag is set.

    Without a dictionary, or without forms in it, the table comes back under the
    name ``"data"``. ``convert`` implies value labels.
    """
    if dictionary is None:
        return {"data": df}
    if cols or vals or convert:
        df = label(df, dictionary, cols=cols, vals=vals or convert, convert=convert, guard=guard)
    by_form = form_columns(df.columns, dictionary)
    if not by_form:
        return {"data": df}
    return {form: df.select(*[F.col(f"`{c}`") for c in cols_]) for form, cols_ in by_form.items()}


def split_forms_labeled(df: DataFrame, dictionary: DataFrame, **flags) -> dict[str, DataFrame]:
    """Label and decode, then split."""
    return split_forms(df, dictionary, **{"cols": True, "vals": True, "convert": True, **flags})


def single_form(forms: dict[str, DataFrame]) -> DataFrame:
    """The table of the only form; an error when there are several."""
    if len(forms) != 1:
        raise ValueError(f"expected one form, got {len(forms)}")
    return next(iter(forms.values()))
