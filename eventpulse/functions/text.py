"""Column expressions on text: trimming, sentences, words."""

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from eventpulse._columns import ColumnOrName, as_column

SENTENCE_END = r"[.!?\n]+"
NON_LETTERS = r"[^\p{L}]+"

# What a trim takes off both ends: the space and the control characters.
BLANKS = "".join(chr(c) for c in range(0x21))
# Control characters other than the line feed, which no sentence contains.
CONTROLS = r"[\x00-\x09\x0b-\x1f]"


def has_controls(text: ColumnOrName) -> Column:
    return as_column(text).rlike(CONTROLS)


def trim_blanks(text: ColumnOrName, controls: Column) -> Column:
    """Strip spaces and control characters, the latter only where there are any.

    Stripping a set of characters is far slower than stripping spaces, and most
    texts have nothing else to strip.
    """
    c = as_column(text)
    return F.when(controls, F.btrim(c, F.lit(BLANKS))).otherwise(F.trim(c))


def longer_than_one(text: ColumnOrName) -> Column:
    """More than one UTF-16 unit, so that a lone emoji counts as two."""
    c = as_column(text)
    return (F.octet_length(c) >= 4) | (F.length(c) > 1)


def sentence_array(text: ColumnOrName) -> Column:
    """Pieces between sentence ends, untrimmed; a newline always ends a sentence."""
    return F.split(as_column(text), SENTENCE_END, -1)


def word_array(text: str) -> Column:
    """Lower-case runs of letters (an empty first or last element is possible)."""
    return F.expr(words_sql(text))


# Expressions that contain a whole word list are SQL text: some thousand words
# parse at once, while each literal built through the Python API is a call to
# the JVM.

def words_sql(text: str) -> str:
    return f"split(lower(`{text}`), {sql_string(NON_LETTERS)}, -1)"


def sql_string(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_list(values: Iterable[str]) -> str:
    return "(" + ", ".join(sql_string(v) for v in values) + ")"
