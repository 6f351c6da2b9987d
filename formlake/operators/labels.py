"""Dictionary-driven column labels, value labels and decoding.

Everything a record table needs is found by one small lookup (at most one row per
column) and, where value labels depend on the data, one aggregation. The result is
a single projection on the lazy input.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field
from decimal import Context, Decimal, InvalidOperation

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formlake.functions.choices import choice_label, parse_choices
from formlake.functions.text import (
    CHOICE_MARK,
    choice_base,
    choice_code,
    is_choice_column,
    is_status_column,
    status_form,
    title_case,
)
from formlake.operators.dictionary import first_entries
from formlake.operators.lookup import attach
from formlake.session import materialise

# Codes and labels of a form's completion status.
STATUS_CHOICES = [("0", "Incomplete"), ("1", "Unverified"), ("2", "Complete")]
STATUS_PREFIX = "Complete? "

# Longer code lists are joined instead of written into the plan as a map.
LITERAL_CODES = 200

_NUMERIC = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType,
)
_PAIRS = "array<struct<code:string,label:string>>"


def _lookup_keys(columns: DataFrame, strict: bool) -> DataFrame:
    """Column names with the dictionary field each one stands for."""
    name = F.col("column_name")
    checkbox = is_choice_column(name) & ~is_status_column(name)
    base = choice_base(name)
    if not strict:
        marked = name.rlike(".___.")
        last = F.regexp_extract(name, "^(.+)___(.+)$", 1)
        checkbox = checkbox | (marked & ~is_status_column(name))
        base = F.when(is_choice_column(name), base).otherwise(last)
    return columns.select(
        "*",
        checkbox.alias("_checkbox"),
        F.when(checkbox, base).otherwise(name).alias("_field"),
    )


def _described(joined: DataFrame) -> DataFrame:
    """Kind, label and value labels of each column, once its dictionary row is beside it."""
    name = F.col("column_name")
    known = F.col("_known").isNotNull()
    status = is_status_column(name) & ~known
    checkbox = ~status & F.col("_checkbox")
    regular = ~status & ~F.col("_checkbox") & known
    choices = F.col("_choices")
    code = choice_code(name)
    chosen = choice_label(choices, code)
    has_label = F.coalesce(F.col("_label") != "", F.lit(False))

    status_pairs = F.array(
        *[F.struct(F.lit(c).alias("code"), F.lit(l).alias("label")) for c, l in STATUS_CHOICES]
    )
    chosen_pair = F.array(F.struct(F.lit("1").alias("code"), chosen.alias("label")))
    return joined.select(
        *[c for c in joined.columns if not c.startswith("_")],
        F.when(status, "status").when(checkbox, "checkbox").when(regular, "regular").alias("kind"),
        F.when(status, F.concat(F.lit(STATUS_PREFIX), title_case(status_form(name))))
        .when(
            checkbox & has_label,
            F.concat(
                F.col("_label"),
                F.lit(" ("),
                F.coalesce(chosen, F.concat(F.lit("Choice "), code)),
                F.lit(")"),
            ),
        )
        .when(regular & has_label, F.col("_label"))
        .alias("label"),
        F.when(status, status_pairs)
        .when(checkbox & chosen.isNotNull(), chosen_pair)
        .when(regular, choices)
        .cast(_PAIRS)
        .alias("value_labels"),
    )


def _entries(dictionary: DataFrame) -> DataFrame:
    return first_entries(dictionary).select(
        "field_name",
        F.lit(True).alias("_known"),
        F.col("field_label").alias("_label"),
        parse_choices(F.col("select_choices_or_calculations")).alias("_choices"),
    )


def describe_columns(columns: DataFrame, dictionary: DataFrame, strict: bool = True) -> DataFrame:
    """Label and value labels for a table of column names (``column_name``).

    Both sides may be large: the dictionary is reduced to one row per field and
    attached by key.
    """
    keys = _lookup_keys(columns, strict)
    entries = materialise(_entries(dictionary).withColumnRenamed("field_name", "_field"))
    return _described(attach(keys, entries, ["_field"]))


@dataclass
class ColumnLabels:
    """What applies to one column of a record table."""

    name: str
    kind: str | None = None
    label: str | None = None
    value_labels: list[tuple[str, str]] = field(default_factory=list)

    def metadata(self, cols: bool, vals: bool) -> dict:
        out: dict = {}
        if cols and self.label:
            out["label"] = self.label
        if vals and self.value_labels:
            out["value_labels"] = [{"code": c, "label": l} for c, l in self.value_labels]
        return out


def column_labels(
    spark: SparkSession, columns: list[str], dictionary: DataFrame, strict: bool = True
) -> dict[str, ColumnLabels]:
    """Labels for a record table's own columns: at most one row per column is collected."""
    names = spark.createDataFrame(
        list(enumerate(columns)), "column_position int, column_name string"
    )
    keys = _lookup_keys(names, strict)
    wanted = {f for c in columns for f in _possible_fields(c)}
    entries = (
        _entries(dictionary.filter(F.col("field_name").isin(sorted(wanted))))
        .withColumnRenamed("field_name", "_field")
    )
    # One entry per wanted name, so the broadcast side is bounded by the table's width.
    joined = keys.join(F.broadcast(entries), "_field", "left")
    found = {}
    for row in _described(joined).collect():
        pairs: dict[str, str] = {}
        for pair in row["value_labels"] or []:
            pairs.setdefault(pair["code"], pair["label"])
        found[row["column_name"]] = ColumnLabels(
            row["column_name"], row["kind"], row["label"], list(pairs.items())
        )
    return found


def _possible_fields(column: str) -> list[str]:
    """The column itself and, for choice columns, every base name it may stand for."""
    out, at = [column], column.find(CHOICE_MARK)
    while at > 0:
        out.append(column[:at])
        at = column.find(CHOICE_MARK, at + 1)
    return out


def _as_number(code: str) -> Decimal | None:
    try:
        value = Decimal(code.strip().replace("_", "x"))
    except InvalidOperation:
        return None
    return value if value.is_finite() else None


def _compare_on_number(data_type: T.DataType, codes: list[str]) -> bool:
    return isinstance(data_type, _NUMERIC) and all(_as_number(c) is not None for c in codes)


def _places(data_type: T.DataType) -> int | None:
    """Decimal places of a type whose numbers are exact; None for doubles and floats."""
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return None
    return data_type.scale if isinstance(data_type, T.DecimalType) else 0


def _key_type(data_type: T.DataType) -> str:
    """The type on which a numeric column's cells meet codes, without loss."""
    places = _places(data_type)
    if places is None:
        return "double"
    return f"decimal(38,{places})" if isinstance(data_type, T.DecimalType) else "bigint"


def _key(code: str, data_type: T.DataType) -> float | Decimal | int | None:
    """A numeric code in that type; None for one that no cell of the type can equal."""
    value, places = _as_number(code), _places(data_type)
    if places is None:
        return float(value)
    if value.adjusted() >= 38 - places or value != round(value, places):
        return None
    if isinstance(data_type, T.DecimalType):
        return value.quantize(Decimal(1).scaleb(-places), context=Context(prec=60))
    return int(value) if -(2**63) <= value < 2**63 else None


def _numeric_codes(data_type: T.DataType, pairs: list[tuple[str, str]]) -> dict:
    """Labels by code in the column's key type; of several labels for a code the first."""
    known: dict = {}
    for code, text in pairs:
        key = _key(code, data_type)
        if key is not None:
            known.setdefault(key, text)
    return known


def holds_code(column: Column, data_type: T.DataType, codes: list[str]) -> Column:
    """Whether a cell is one of the codes: on numbers if both sides are numeric."""
    if _compare_on_number(data_type, codes):
        kind = _key_type(data_type)
        keys = _numeric_codes(data_type, [(c, c) for c in codes])
        return column.cast(kind).isin([F.lit(k).cast(kind) for k in keys]) & F.lit(bool(keys))
    return as_character(column, data_type).isin(codes)


def coded_columns(df: DataFrame, coded: dict[str, list[str]]) -> dict[str, bool]:
    """For each column, whether any cell holds one of its codes; one scan at any width.

    Cells are laid out as (column, holds) rows, which combine map-side into one per column.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    names = list(coded)
    if not names:
        return {}
    holds = F.array(*[holds_code(F.col(f"`{n}`"), types[n], coded[n]) for n in names])
    cells = df.select(F.posexplode(holds).alias("at", "holds"))
    found = cells.groupBy("at").agg(F.max("holds").alias("holds")).collect()
    return dict.fromkeys(names, False) | {names[r["at"]]: bool(r["holds"]) for r in found}


def as_character(column: Column, data_type: T.DataType) -> Column:
    """A cell's text; whole doubles print without a fraction."""
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        whole = (column == F.floor(column)) & (F.abs(column) < 1e15)
        return F.when(whole, column.cast("bigint").cast("string")).otherwise(column.cast("string"))
    return column.cast("string")


def decode(column: Column, data_type: T.DataType, pairs: list[tuple[str, str]]) -> Column:
    """Replace codes by labels; cells that hold no code keep their text."""
    raw = as_character(column, data_type)
    if not pairs:
        return raw
    if _compare_on_number(data_type, [c for c, _ in pairs]):
        kind = _key_type(data_type)
        key, known = column.cast(kind), _numeric_codes(data_type, pairs)
        if not known:
            return raw
        cells = [x for code, text in known.items() for x in (F.lit(code).cast(kind), F.lit(text))]
    else:
        key, known = raw, dict(reversed(pairs))
        cells = [F.lit(x) for c in dict.fromkeys(c for c, _ in pairs) for x in (c, known[c])]
    table = F.create_map(*cells)
    return F.coalesce(F.try_element_at(table, key), raw)


def decode_checkbox(column: Column, data_type: T.DataType, label: str) -> Column:
    """Checked cells become the choice's label, unchecked cells become missing."""
    if isinstance(data_type, _NUMERIC):
        checked, unchecked = column == 1, column == 0
    else:
        checked, unchecked = column.cast("string") == "1", column.cast("string") == "0"
    return (
        F.when(checked, F.lit(label))
        .when(unchecked, F.lit(None).cast("string"))
        .otherwise(as_character(column, data_type))
    )


def _common_type(one: T.DataType, other: T.DataType) -> str:
    """The type on which numbers of two columns meet."""
    places = [p for p in (_places(one), _places(other)) if p is not None]
    if not places:
        return "double"
    if max(places) == 0 and not isinstance(one, T.DecimalType) and not isinstance(other, T.DecimalType):
        return "bigint"
    return f"decimal(38,{min(max(places), 18)})"


def _exactly(column: Column, data_type: T.DataType, kind: str) -> Column:
    """Numbers in another type; null for those it can't hold without loss."""
    if data_type.simpleString() == kind:
        return column
    moved = column.try_cast(kind)
    return F.when(moved.cast(data_type) == column, moved)


def decode_by_table(
    df: DataFrame,
    column: str,
    codes: DataFrame,
    code: str = "code",
    label: str = "label",
    order: str | None = None,
) -> DataFrame:
    """Decode one column against a table of codes of any size.

    Of several labels for a code the first wins, by the ``order`` column, or as the table
    is read where there is none.
    """
    data_type = df.schema[column].dataType
    metadata = df.schema[column].metadata
    code_type = codes.schema[code].dataType
    numeric = isinstance(data_type, _NUMERIC) and isinstance(code_type, _NUMERIC)
    kept = [f.name for f in df.schema.fields]
    coded = F.col(f"`{code}`")
    if numeric:
        kind = _common_type(data_type, code_type)
        own = _exactly(coded, code_type, kind)
    else:
        kind, own = "string", coded.cast("string")
    keyed = materialise(
        codes.select(
            own.alias("_code"),
            F.col(label).alias("_label"),
            (F.col(order) if order else F.monotonically_increasing_id()).alias("_order"),
        )
        .filter("_code IS NOT NULL")
        .groupBy("_code")
        .agg(F.min_by("_label", "_order").alias("_label"))
    )
    cell = F.col(f"`{column}`")
    key = _exactly(cell, data_type, kind) if numeric else as_character(cell, data_type)
    joined = attach(df.withColumn("_code", key), keyed, ["_code"])
    return joined.select(
        *[
            F.coalesce("_label", as_character(cell, data_type)).alias(column, metadata=metadata)
            if c == column
            else F.col(f"`{c}`")
            for c in kept
        ]
    )


def label(
    df: DataFrame,
    dictionary: DataFrame | None,
    cols: bool = True,
    vals: bool = True,
    convert: bool = True,
    guard: str = "data",
    strict: bool = True,
) -> DataFrame:
    """Label a record table's columns and values, and decode values to text.

    ``cols``    put each column's label in its metadata
    ``vals``    put each coded column's codes and labels in its metadata
    ``convert`` replace codes by labels (needs ``vals``); column labels stay
    ``guard``   ``"data"`` labels a coded column only if some cell holds a code;
                ``"none"`` labels it regardless, for streams
    ``strict``  ``___`` must be followed by digits in checkbox columns
    """
    if not cols and not vals:
        raise ValueError("at least one of cols and vals must be True")
    if guard not in ("data", "none"):
        raise ValueError("guard is 'data' or 'none'")
    known = {}
    if dictionary is not None:
        known = column_labels(df.sparkSession, df.columns, dictionary, strict)
    found_none = not any(
        k.label or k.value_labels for k in known.values() if k.kind != "status"
    )
    if found_none and (dictionary is None or dictionary.isEmpty()):
        warnings.warn("no dictionary available, returning data unchanged", stacklevel=2)
        return df

    types = {f.name: f.dataType for f in df.schema.fields}
    if vals and guard == "data":
        coded = {
            n: [c for c, _ in k.value_labels]
            for n, k in known.items()
            if k.kind == "regular" and k.value_labels
        }
        for name, present in coded_columns(df, coded).items() if coded else ():
            if not present:
                known[name].value_labels = []

    out, long_lists = [], []
    for f in df.schema.fields:
        spec = known[f.name]
        column = F.col(f"`{f.name}`")
        metadata = {**f.metadata, **spec.metadata(cols, vals and not convert)}
        pairs = spec.value_labels if vals else []
        if pairs and convert:
            metadata.pop("value_labels", None)
            if spec.kind == "checkbox":
                column = decode_checkbox(column, types[f.name], pairs[0][1])
            elif len(pairs) > LITERAL_CODES:
                long_lists.append((f.name, pairs))
            else:
                column = decode(column, types[f.name], pairs)
        elif pairs and isinstance(types[f.name], _NUMERIC):
            if not _compare_on_number(types[f.name], [c for c, _ in pairs]):
                column = as_character(column, types[f.name])
        out.append(column.alias(f.name, metadata=metadata))
    result = df.select(*out)
    for name, pairs in long_lists:
        result = _decode_long(result, name, pairs)
    return result


def _decode_long(df: DataFrame, name: str, pairs: list[tuple[str, str]]) -> DataFrame:
    """Decode against a list too long for the plan; it came from one dictionary cell."""
    data_type = df.schema[name].dataType
    if _compare_on_number(data_type, [c for c, _ in pairs]):
        rows, kind = _numeric_codes(data_type, pairs), _key_type(data_type)
    else:
        rows, kind = dict(reversed(pairs)), "string"
    codes = df.sparkSession.createDataFrame(list(rows.items()), f"code {kind}, label string")
    return decode_by_table(df, name, codes)


def label_rows(df: DataFrame) -> DataFrame:
    """The labels a table carries in its metadata, one row per column."""
    rows = [
        (
            i,
            f.name,
            f.metadata.get("label"),
            [(v["code"], v["label"]) for v in f.metadata.get("value_labels", [])] or None,
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return df.sparkSession.createDataFrame(
        rows, f"column_position int, column_name string, label string, value_labels {_PAIRS}"
    )
