"""Column expressions shared by the native operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The white space that parts words: blank, tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def text_of(name: str) -> Column:
    """A text column, null counting as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """The runs of characters other than SPACES."""
    return F.filter(F.split(text, SPACE_RUN), lambda w: w != "")
