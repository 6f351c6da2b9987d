"""Type narrowing: the golden sample, an edge battery, options and merged profiles."""

import random

import pytest
from pyspark.sql import functions as F

from formlake.operators import narrowing as N

# One column of each kind, and of each kind spoilt by one cell.
SAMPLE = {
    "beds": (["14", "0", "-6", "250000"], "int"),
    "weight": (["70.25", "-0.5", "81", "3.000"], "double"),
    "admitted": (["1999-12-31", "2000-02-29", "2016/7/4", "2031-10-09"], "date"),
    "scanned": (["2016-07-04 05:06", "2016-07-04T23:10:59", "2000-02-29 00:00:00", "2016-07-05"], "timestamp_ntz"),
    "ward_or_bed": (["14", "B", "15", "16"], "string"),
    "weight_or_note": (["70.25", "refused", "3", "4.5"], "string"),
    "day_or_blank": (["1999-12-31", "soon", "", "2000-02-29"], "string"),
    "remark": (["x", "two words", "5%; a|b", "9z"], "string"),
}


def text_table(spark, columns):
    names = list(columns)
    rows = list(zip(*columns.values()))
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names)).coalesce(1)


def final(spark, values, **options):
    df = text_table(spark, {"c": values})
    return N.profile_types(df, **options)[0]


def test_kinds_of_columns(spark):
    df = N.narrow(text_table(spark, {n: v for n, (v, _) in SAMPLE.items()}))
    assert {f.name: f.dataType.simpleString() for f in df.schema.fields} == {
        n: t for n, (_, t) in SAMPLE.items()
    }
    rows = df.collect()
    assert [r["beds"] for r in rows] == [14, 0, -6, 250000]
    assert [r["weight"] for r in rows] == [70.25, -0.5, 81.0, 3.0]
    assert str(rows[2]["admitted"]) == "2016-07-04" and rows[1]["scanned"].second == 59


def test_numbers_land_without_exponents(spark):
    values = [12345678.5, 0.0005, -1.5e-10, 1e22, -98765432.0, 0.0, -0.25, 1.7976931348623157e308, 5e-324, None]
    rows = spark.createDataFrame([(v,) for v in values], "v double").coalesce(1)
    text = [r["v"] for r in N.as_text(rows).collect()]
    assert text[:6] == ["12345678.5", "0.0005", "-0.00000000015", "1" + "0" * 22 + ".0", "-98765432.0", "0.0"]
    assert [None if t is None else float(t) for t in text] == values
    narrowed = N.narrow(N.as_text(rows))
    assert narrowed.dtypes == [("v", "double")] and [r["v"] for r in narrowed.collect()] == values


CLASSES = {
    "007": N.INT32 | N.ZEROS, "-5": N.INT32, "-0": N.INT32, "0": N.INT32, "+4": N.OTHER,
    "1.": N.OTHER, ".5": N.OTHER, "1e3": N.OTHER, "2147483647": N.INT32, "2147483648": N.BIG,
    "-2147483648": N.INT32, "-2147483649": N.BIG, "12\n": N.OTHER, " 3 ": N.OTHER, "-": N.OTHER,
    "٣": N.OTHER, "": N.BLANK, None: 0, "9" * 40: N.BIG, "0" * 40 + "7": N.INT32 | N.ZEROS,
    "0.50": N.DECIMAL, "2023": N.INT32, "2023-01": N.OTHER, "2023-1-5": N.DATE,
    "2023/01/05": N.DATE, "01/02/2023": N.OTHER, "2023-13-01": N.OTHER, "2024-02-30": N.OTHER,
    "2023-01-01 10:00": N.TIMESTAMP, "2023-01-01T12:34:56": N.TIMESTAMP,
    "2023-01-01T12:34:56Z": N.OTHER, "2023-01-01 12:34:56+02": N.OTHER,
    "2023-01-01 12:34:56.123456": N.TIMESTAMP, "2023-01-01 25:00": N.OTHER,
    "2023-01-01 junk": N.OTHER, " 2023-01-01 ": N.OTHER, "12:30": N.OTHER, "infinity": N.OTHER,
    "epoch": N.OTHER, "20230101": N.INT32, "1-2": N.OTHER, "NaN": N.OTHER,
}


def test_edge_battery(spark):
    df = spark.createDataFrame([(k, v) for k, v in CLASSES.items()], "t string, want int")
    wrong = df.withColumn("got", N.text_class(F.col("t"))).filter("got <> want").collect()
    assert wrong == []


def test_blank_and_overflow_keep_text_with_warning(spark):
    blank = final(spark, ["1", "", "3"])
    assert (blank.candidate, blank.final_type, blank.level) == ("INTEGER", "VARCHAR", "WARNING")
    assert final(spark, ["1", "", "3"], blank_as_null=True).final_type == "INTEGER"
    big = final(spark, ["1", "3000000000"])
    assert (big.candidate, big.final_type, big.level) == ("INTEGER", "VARCHAR", "WARNING")
    assert final(spark, ["1", "3000000000"], overflow="bigint").final_type == "BIGINT"
    assert final(spark, ["1.5", "3000000000"]).final_type == "DOUBLE"


def test_leading_zeros(spark):
    assert final(spark, ["007", "8"]).final_type == "INTEGER"
    assert final(spark, ["007", "8"], keep_leading_zeros=True).final_type == "VARCHAR"


def test_all_missing_becomes_integer_and_dates_mix_with_times(spark):
    assert final(spark, [None, None]).final_type == "INTEGER"
    assert final(spark, ["2023-01-01", "2023-01-01 10:00"]).final_type == "TIMESTAMP"
    assert final(spark, ["2023-01-01", "5"]).final_type == "VARCHAR"


def test_blank_cells_become_null_when_asked(spark):
    df = text_table(spark, {"c": ["1", "", "3"], "d": ["2023/01/05", "", "2023-1-6"]})
    rows = N.narrow(df, blank_as_null=True).collect()
    assert [r["c"] for r in rows] == [1, None, 3]
    assert [str(r["d"]) for r in rows] == ["2023-01-05", "None", "2023-01-06"]


def test_wide_table_in_one_pass(spark):
    wide = spark.range(20).select(
        *[(F.col("id") * i).cast("string").alias(f"c{i}") for i in range(600)]
    )
    profile = N.profile_types(wide)
    assert len(profile) == 600
    assert {p.final_type for p in profile} == {"INTEGER"}


def test_bad_option(spark):
    with pytest.raises(ValueError):
        final(spark, ["1"], overflow="wrap")


def test_narrowed_numbers_keep_their_value(spark):
    rng = random.Random(7)
    values = [str(rng.randint(-(2**31), 2**31 - 1)) for _ in range(200)]
    df = N.narrow(text_table(spark, {"c": values}))
    assert [str(r["c"]) for r in df.collect()] == values
