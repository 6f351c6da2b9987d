"""A table with every odd case: nulls, empty and very long texts, ties, repeated rows, clashing names."""

from pyspark.sql import DataFrame, SparkSession

LONG = "word and another, then more. " * 6000

ROWS = [
    (1, "A b c d e f g."),
    (2, "A  b\tc d e\nf g."),  # equal to row 1 but for white space, and longer
    (3, "A b c d e f g."),
    (3, "A b c d e f g."),  # a repeated row
    (4, None),
    (5, ""),
    (6, " \n\t"),
    (None, "no id here"),
    (None, None),
    (7, LONG),
    (8, LONG + "x"),
    (9, "naïve Über 漢字 😀 \x00 <|endoftext|> don't 1234"),
    (10, "one"),
]

CLASHING = (
    "doc_id bigint, text string, document string, fingerprint string, part int, row_no bigint, "
    "suspect string, score double, `a.b` string, terms string, n_chars bigint"
)


def odd(spark: SparkSession) -> DataFrame:
    rows = [(i, t, "d", None, 1, 2, None, 0.5, "x", None, len(t or "")) for i, t in ROWS]
    return spark.createDataFrame(rows, CLASHING)


def none(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], CLASHING)
