"""Amounts in Belgian notation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT = r"^\(?-?(\d{1,3}(\.\d{3})+|\d+)(,\d+)?\)?$"


def amount(cell: Column) -> Column:
    """Whole number in a cell: points part thousands, a comma decimals; brackets or a minus are negative.

    Anything that is not an amount as a whole is null. Halves go to the even number.
    """
    text = F.trim(cell)
    digits = F.translate(F.translate(text, "().-", ""), ",", ".")
    value = F.bround(digits.try_cast("decimal(20,2)"), 0).cast("long")
    negative = text.startswith("(") | F.regexp_replace(text, r"^\(", "").startswith("-")
    return F.when(text.rlike(AMOUNT), F.when(negative, -value).otherwise(value))


def belgian(value: Column) -> Column:
    """A number as text in Belgian notation with two decimals."""
    return F.translate(F.format_number(value, 2), ",.", ".,")
