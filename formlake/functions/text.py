"""Text expressions: cell cleaning, title case, elapsed time, column-name parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that title case leaves in lower case unless they come first.
SMALL_WORDS = [
    "a", "and", "are", "as", "at", "be", "but", "by", "en", "for", "if", "in", "is",
    "nor", "not", "of", "on", "or", "per", "so", "the", "v", "v.", "via", "vs", "vs.",
    "from", "into", "than", "that", "with",
]

# Words that title case leaves exactly as typed, wherever they come.
WORDS_AS_TYPED = [
    "all", "above", "after", "along", "also", "among", "any", "both", "can", "few",
    "it", "less", "log", "many", "more", "over", "some", "their", "then", "this",
    "under", "until", "using", "von", "when", "where", "which", "will", "without",
    "yet", "you", "your",
]

# Column-name conventions of record exports.
STATUS_SUFFIX = "_complete"
CHOICE_COLUMN = r"___\d+$"
CHOICE_MARK = "___"
MISSING_TEXT = "NA"


def clean_cell(cell: Column) -> Column:
    """A CSV cell as landed text: blanks trimmed, empty and ``NA`` cells missing."""
    trimmed = F.trim(cell, F.lit(" \t"))
    return F.when((trimmed != "") & (trimmed != MISSING_TEXT), trimmed)


def title_case(name: Column) -> Column:
    """Title case for a form name, underscores read as blanks."""

    def one(word: Column, place: Column) -> Column:
        small = (place > 0) & F.lower(word).isin(SMALL_WORDS)
        as_typed = (
            (F.length(word) <= 1)
            | word.isin(WORDS_AS_TYPED)
            | word.rlike("^[A-Za-z].*[A-Z]")
        )
        raised = F.concat(F.upper(F.substring(word, 1, 1)), word.substr(F.lit(2), F.length(word)))
        return F.when(small, F.lower(word)).when(as_typed, word).otherwise(raised)

    words = F.split(F.translate(name, "_", " "), " ")
    return F.array_join(F.transform(words, one), " ")


def elapsed_text(seconds: Column) -> Column:
    """``12s`` below a minute, else ``3m 5s``; halves round to the even second."""
    s = seconds.cast("double")
    whole = F.bround(s).cast("bigint").cast("string")
    minutes = F.floor(s / 60).cast("bigint").cast("string")
    rest = F.bround(s % 60).cast("bigint").cast("string")
    return F.when(s < 60, F.concat(whole, F.lit("s"))).otherwise(
        F.concat(minutes, F.lit("m "), rest, F.lit("s"))
    )


def elapsed_string(seconds: float) -> str:
    """Driver twin of :func:`elapsed_text` for log messages."""
    if seconds < 60:
        return f"{round(seconds)}s"
    return f"{int(seconds // 60)}m {round(seconds % 60)}s"


def stamp_literal(at) -> Column:
    """A wall-clock time as a literal, free of any time zone."""
    return F.lit(str(at)).cast("timestamp_ntz")


def status_form(column: Column) -> Column:
    """Form name of a ``<form>_complete`` column."""
    return F.regexp_replace(column, STATUS_SUFFIX + "$", "")


def choice_base(column: Column) -> Column:
    """Field name of a ``<field>___<digits>`` column."""
    return F.regexp_replace(column, CHOICE_COLUMN, "")


def choice_code(column: Column) -> Column:
    """Choice code of a ``<field>___<code>`` column."""
    return F.regexp_replace(column, "^.*___", "")


def is_status_column(column: Column) -> Column:
    return column.endswith(STATUS_SUFFIX)


def is_choice_column(column: Column) -> Column:
    return column.rlike(r"___\d+\z")
