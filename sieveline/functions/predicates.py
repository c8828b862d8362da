"""Validation rules and conversions as native Spark columns.

Every predicate takes a text column and returns a boolean column that is never
NULL: a NULL value fails every rule. All of them are built-in expressions, so
they stay inside whole-stage code generation.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text each rule accepts. ``\z`` is the very end of the text;
# ``$`` would also match before a final newline.
NUMBER = r"^[0-9]+(\.[0-9]+)?\z"
SIGNED_NUMBER = r"^-?[0-9]+(\.[0-9]+)?\z"
ANY_DIGIT = r"[0-9]"
ISO_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}\z"


def quoted(name: str) -> Column:
    """Refer to a column by its literal name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def never_null(predicate: Column) -> Column:
    return F.coalesce(predicate, F.lit(False))


def all_of(predicates: list[Column]) -> Column:
    """Conjunction; true when there is nothing to check."""
    return reduce(and_, predicates) if predicates else F.lit(True)


def positive_number(c: Column) -> Column:
    """Digits with an optional decimal part. Zero passes; the shape has no sign,
    so whatever matches is already >= 0."""
    return never_null(c.rlike(NUMBER))


def is_number(c: Column) -> Column:
    """Number test without a sign test; accepts the same text as
    ``positive_number``."""
    return never_null(c.rlike(NUMBER))


def number(c: Column) -> Column:
    """Decimal text with an optional minus sign."""
    return never_null(c.rlike(SIGNED_NUMBER))


def non_negative(c: Column) -> Column:
    """Value test only: pair it with ``number``, because ``NaN``, ``1e3`` and
    padded text also convert to a double >= 0."""
    return never_null(c.try_cast("double") >= 0)


def string_no_numbers(c: Column) -> Column:
    return never_null(~c.rlike(ANY_DIGIT))


def iso_date(c: Column) -> Column:
    """``yyyy-MM-dd`` shape and a real calendar day.

    The shape check also bounds what the cast may accept, and the cast neither
    throws nor depends on the session's time parser policy.
    """
    return never_null(c.rlike(ISO_DATE) & c.try_cast("date").isNotNull())


def email(c: Column) -> Column:
    return never_null(c.rlike(EMAIL))


def string_length(c: Column, length: int) -> Column:
    """Exact length in characters."""
    return never_null(F.length(c) == length)


def to_number(c: Column) -> Column:
    return c.try_cast("double")


def to_date(c: Column) -> Column:
    """Date of text that has passed ``iso_date``."""
    return c.try_cast("date")


def to_iso_date(c: Column) -> Column:
    """Date of ``yyyy-MM-dd`` text, NULL for any other shape."""
    return F.when(c.rlike(ISO_DATE), to_date(c))
