"""Content-driven type narrowing of all-text tables.

One pass tells, for every column at once, which classes of text occur in it.
The classes of a column fit in one small integer and combine with a bitwise OR, so
the pass aggregates map-side and the results of several loads can be merged later
without rereading the earlier ones.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Patterns a text must match as a whole.
DECIMAL_TEXT = r"^-?[0-9]+(\.[0-9]+)?\z"
DATE_TEXT = r"^[0-9]{4}[-/][0-9]{1,2}[-/][0-9]{1,2}\z"
TIMESTAMP_TEXT = (
    r"^[0-9]{4}[-/][0-9]{1,2}[-/][0-9]{1,2}"
    r"[ T][0-9]{1,2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?\z"
)

# Classes of text, one bit each.
INT32, BIG, DECIMAL, DATE, TIMESTAMP, OTHER, BLANK, ZEROS = (1 << i for i in range(8))

SPARK_TYPE = {
    "INTEGER": "int",
    "BIGINT": "bigint",
    "DOUBLE": "double",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
    "VARCHAR": "string",
}

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("position", T.IntegerType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("classes", T.IntegerType()),
        T.StructField("n_present", T.LongType()),
        T.StructField("n_blank", T.LongType()),
        T.StructField("candidate", T.StringType()),
        T.StructField("final_type", T.StringType()),
        T.StructField("level", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)


@dataclass(frozen=True)
class ColumnType:
    """What the pass found in one column and what follows from it."""

    position: int
    column_name: str
    classes: int
    n_present: int
    n_blank: int
    candidate: str
    final_type: str
    level: str
    message: str


def _dashed(text: Column) -> Column:
    return F.replace(text, F.lit("/"), F.lit("-"))


def _integer_class(text: Column) -> Column:
    """Class of a text that is known to be all digits, without a cast that can fail."""
    padded = ((text >= "00") & (text < "1")) | ((text >= "-00") & (text < "-1"))
    bare = F.when(padded, F.regexp_replace(text, "^(-?)0+", "$1")).otherwise(text)
    size = F.length(bare)
    within = bare.try_cast("bigint").between(-(1 << 31), (1 << 31) - 1)
    zeros = F.when(padded, F.lit(ZEROS)).otherwise(F.lit(0))
    large = zeros.bitwiseOR(F.when((size <= 11) & within, F.lit(INT32)).otherwise(F.lit(BIG)))
    return F.when(~padded & (F.length(text) <= 9), F.lit(INT32)).otherwise(large)


def text_class(text: Column) -> Column:
    """Bit of the narrowest class one text belongs to; 0 for a missing cell.

    A comparison settles plain words before any pattern is tried: numbers and dates
    start with a digit or a minus. Casts are tried only on texts of the right shape,
    because a failing numeric cast costs an exception.
    """
    numberlike = (text >= "-") & (text < ":")
    dated = F.substring(text, 5, 1).isin("-", "/")
    short = F.length(text) <= 10
    date = text.rlike(DATE_TEXT) & _dashed(text).try_cast("date").isNotNull()
    stamp = text.rlike(TIMESTAMP_TEXT) & _dashed(text).try_cast("timestamp_ntz").isNotNull()
    return (
        F.when(text.isNull(), F.lit(0))
        .when(text == "", F.lit(BLANK))
        .when(~numberlike, F.lit(OTHER))
        .when(
            text.rlike(DECIMAL_TEXT),
            F.when(F.contains(text, F.lit(".")), F.lit(DECIMAL)).otherwise(_integer_class(text)),
        )
        .when(dated & short & date, F.lit(DATE))
        .when(dated & ~short & stamp, F.lit(TIMESTAMP))
        .otherwise(F.lit(OTHER))
    )


def _decide(
    position: int,
    name: str,
    classes: int,
    n_present: int,
    n_blank: int,
    overflow: str,
    blank_as_null: bool,
    keep_leading_zeros: bool,
) -> ColumnType:
    found = classes & ~(BLANK | ZEROS)
    if not found & ~(INT32 | BIG):
        candidate = "INTEGER"
    elif not found & ~(INT32 | BIG | DECIMAL):
        candidate = "DOUBLE"
    elif not found & ~DATE:
        candidate = "DATE"
    elif not found & ~(DATE | TIMESTAMP):
        candidate = "TIMESTAMP"
    else:
        candidate = "VARCHAR"

    final, problem = candidate, None
    if candidate != "VARCHAR":
        if classes & BLANK and not blank_as_null:
            final, problem = "VARCHAR", "blank cells"
        elif classes & ZEROS and keep_leading_zeros:
            final, problem = "VARCHAR", "leading zeros"
        elif candidate == "INTEGER" and classes & BIG:
            if overflow == "bigint":
                final = "BIGINT"
            else:
                final, problem = "VARCHAR", "values beyond 32 bits"
    if problem:
        level, message = "WARNING", f"Type of {name}: VARCHAR, because of {problem}"
    elif final == "VARCHAR":
        level, message = "INFO", f"Type of {name}: VARCHAR"
    else:
        level, message = "INFO", f"Type of {name}: {final}"
    return ColumnType(position, name, classes, n_present, n_blank, candidate, final, level, message)


def class_counts(df: DataFrame, columns: list[str] | None = None) -> list[tuple[str, int, int, int]]:
    """Per column: name, classes present, non-missing cells, blank cells.

    Cells are laid out as (column, text) rows, so the generated code stays small and
    compiled however many columns there are; they combine map-side into one row per
    column before the shuffle.
    """
    names = list(columns or df.columns)
    cells = df.select(F.posexplode(F.array(*[F.col(f"`{n}`") for n in names])).alias("at", "text"))
    text, found = F.col("text"), text_class(F.col("text"))
    rows = (
        cells.groupBy("at")
        .agg(
            F.bit_or(found).alias("classes"),
            # A second use makes Spark evaluate the class once per cell; bit_or alone
            # would repeat its code until the method is too large to be compiled.
            F.max(found).alias("_top"),
            F.count(text).alias("present"),
            F.count_if(text == "").alias("blank"),
        )
        .collect()
    )
    by_column = {r["at"]: (r["classes"], r["present"], r["blank"]) for r in rows}
    return [(n, *by_column.get(i, (0, 0, 0))) for i, n in enumerate(names)]


def decide_types(
    counts: list[tuple[str, int, int, int]],
    overflow: str = "text",
    blank_as_null: bool = False,
    keep_leading_zeros: bool = False,
) -> list[ColumnType]:
    """The type of each column, from the classes of text present in it."""
    if overflow not in ("text", "bigint"):
        raise ValueError("overflow is 'text' or 'bigint'")
    return [
        _decide(i, n, c, p, b, overflow, blank_as_null, keep_leading_zeros)
        for i, (n, c, p, b) in enumerate(counts)
    ]


def profile_types(df: DataFrame, columns: list[str] | None = None, **options) -> list[ColumnType]:
    """Decide the narrowest type of every text column in one pass.

    ``overflow="bigint"``, ``blank_as_null`` and ``keep_leading_zeros`` relax or
    tighten the default, which keeps a column as text when its cast would fail.
    """
    return decide_types(class_counts(df, columns), **options)


def profile_report(spark: SparkSession, profile: list[ColumnType]) -> DataFrame:
    """The profile as a table, one row per column."""
    rows = [tuple(getattr(p, f.name) for f in REPORT_SCHEMA.fields) for p in profile]
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def narrowed(text: Column, final_type: str) -> Column:
    """Cast one text column to a decided type."""
    text = F.nullif(text, F.lit(""))  # a failing numeric cast costs an exception
    if final_type in ("DATE", "TIMESTAMP"):
        text = _dashed(text)
    return text.try_cast(SPARK_TYPE[final_type])


def apply_types(df: DataFrame, profile: list[ColumnType]) -> DataFrame:
    """One projection of casts; label metadata of the columns is kept."""
    final = {p.column_name: p.final_type for p in profile}
    out = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if final.get(field.name, "VARCHAR") != "VARCHAR":
            column = narrowed(column, final[field.name])
        out.append(column.alias(field.name, metadata=field.metadata))
    return df.select(*out)


def narrow(df: DataFrame, **options) -> DataFrame:
    """Profile an all-text table and cast it: one aggregation, then a lazy projection."""
    return apply_types(df, profile_types(df, **options))


def _without_exponent(text: Column) -> Column:
    """Digits and zeros of a number's text that has an exponent."""

    def part(group: int) -> Column:
        return F.regexp_extract(text, r"^(-?)(\d)\.(\d+)E(-?\d+)$", group)

    digits = F.concat(part(2), F.regexp_replace(part(3), "0+$", ""))
    power = part(4).cast("int")
    whole = F.rpad(F.substring(digits, F.lit(1), power + 1), power + 1, F.lit("0"))
    rest = F.substring(digits, power + 2, F.length(digits))
    large = F.concat(whole, F.lit("."), F.when(rest == "", "0").otherwise(rest))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    return F.concat(part(1), F.when(power >= 0, large).otherwise(small))


def plain_number(column: Column) -> Column:
    """A floating-point number's text without an exponent: its digits and zeros up to the point.

    The patterns are in a function of their own, which few numbers need: as part of the
    generated code of every column they would make it too large to be compiled.
    """
    text = column.cast("string")
    plain = F.get(F.transform(F.array(text), _without_exponent), F.lit(0))
    return F.when(F.contains(text, F.lit("E")), plain).otherwise(text)


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text, as landed; numbers without exponents, so that narrowing finds them."""
    return df.select(
        *[
            (
                plain_number(F.col(f"`{f.name}`"))
                if isinstance(f.dataType, (T.DoubleType, T.FloatType))
                else F.col(f"`{f.name}`").cast("string")
            ).alias(f.name)
            for f in df.schema.fields
        ]
    )


def merge_counts(
    profiles: DataFrame,
) -> list[tuple[str, int, int, int]]:
    """Combine stored profiles of several loads (column_name, position, classes, counts)."""
    merged = (
        profiles.groupBy("column_name")
        .agg(
            F.min("position").alias("position"),
            F.bit_or("classes").alias("classes"),
            F.sum("n_present").alias("n_present"),
            F.sum("n_blank").alias("n_blank"),
        )
        .orderBy("position", "column_name")
        .collect()
    )
    return [(r["column_name"], r["classes"], r["n_present"], r["n_blank"]) for r in merged]


