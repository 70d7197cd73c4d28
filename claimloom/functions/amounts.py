"""Numbers that arrive as text. Unreadable text becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(column: str | Column) -> Column:
    """Empty text is common in amounts and set aside first: failing to parse it costs the JVM an
    exception per value."""
    text = F.col(column) if isinstance(column, str) else column
    return F.when(F.octet_length(text) > 0, text.try_cast("double"))


def to_int(column: str) -> Column:
    """Only whole-number text is read: '1.0' is NULL, ' 3 ' is 3."""
    return F.col(column).try_cast("int")


def truncated(number: Column) -> Column:
    """Fraction cut off toward zero. Out of range or NaN raises, as a strict cast does."""
    return number.cast("int")


def total_of(*columns: str) -> Column:
    """Sum of text amounts; NULL as soon as one of them is NULL or unreadable."""
    first, *rest = (to_double(c) for c in columns)
    for amount in rest:
        first = first + amount
    return first
