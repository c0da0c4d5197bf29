"""Numeric cells keep three states apart: a number, marked missing, unreadable."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dayledger.functions.text import MISSING_MARKS, decimal_point

OK, MISSING, UNPARSABLE = "ok", "missing", "unparsable"

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def number(text: Column) -> Column:
    """Double, or null when the text is not a plain decimal number."""
    point = decimal_point(text)
    return F.when(point.rlike(_NUMBER), point.try_cast("double"))


def number_cell(text: Column, sentinel: bool = True) -> Column:
    """``struct(value, status)`` of a cell; NaN never appears."""
    marked = text.isin(*MISSING_MARKS) if sentinel else F.lit(False)
    value = number(text)
    status = (
        F.when(marked, F.lit(MISSING))
        .when(value.isNotNull(), F.lit(OK))
        .otherwise(F.lit(UNPARSABLE))
    )
    return F.struct(value.alias("value"), status.alias("status"))


def rule_value(cell: Column) -> Column:
    """Value a check compares: missing counts as 0, unreadable as null (passes)."""
    return F.when(cell["status"] == MISSING, F.lit(0.0)).otherwise(cell["value"])


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def over(numerator: Column, divisor: Column) -> Column:
    """Division that gives null for a zero divisor."""
    return numerator / F.nullif(divisor, F.lit(0.0))
