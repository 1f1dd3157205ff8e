"""Column expressions on text that several operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACE = r"[\x20\x09-\x0D]+"  # what separates words
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # after lower-casing: all ASCII but letters and digits


def whole(text: Column) -> Column:
    """The text, '' for NULL."""
    return F.coalesce(text.cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A to Z in lower case, every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def words(text: Column, separator: str = SPACE) -> Column:
    """The runs of characters between separators, in order; none for NULL."""
    return F.filter(F.split(whole(text), separator), lambda w: w != "")


def unused(name: str, columns: list[str]) -> str:
    """``name`` with as many underscores behind it as it takes to be no name of ``columns``, in any case of letters."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def word_count(text: Column) -> Column:
    """How many runs of other than white space; 0 for NULL."""
    parts = F.split(F.btrim(whole(text), F.lit(" \t\n\x0b\x0c\r")), SPACE)
    return F.when(F.element_at(parts, 1) == "", 0).otherwise(F.size(parts)).cast("long")
