"""Exact rounding, guarded division, text-to-number cleansing and the annuity formula."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_ratio(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """numerator / denominator as a decimal, rounded half away from zero; NULL when dividing by 0.

    Both sides are whole numbers, so the quotient is taken on decimals: a binary
    double would move values that lie exactly between two steps.
    """
    top = numerator.cast("decimal(20,0)")
    bottom = F.nullif(denominator.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.round(top / bottom, digits)


def exact_average(column: Column, digits: int = 2) -> Column:
    """AVG of an integer column, rounded exactly. NULL rows do not count."""
    return exact_ratio(F.sum(column), F.count(column), digits)


def comma_to_point(column: Column) -> Column:
    return F.replace(column, F.lit(","), F.lit("."))


def text_to_real(column: Column, *, blank_is_null: bool = True, strict: bool = True) -> Column:
    """Text to single precision. `strict` raises on text that is no number, else it becomes NULL."""
    text = F.nullif(column, F.lit("")) if blank_is_null else column
    return text.cast("float") if strict else text.try_cast("float")


def has_comma(columns: list[str]) -> Column:
    """True for a row in which any of the columns still holds a comma."""
    return reduce(or_, [F.contains(F.col(c), F.lit(",")) for c in columns])


def digits_only(column: Column) -> Column:
    """Whole text is ASCII digits; `\\z`, since `$` would let a trailing newline pass."""
    return column.rlike(r"^[0-9]+\z")


def annuity_payment(amount: Column, yearly_rate: Column, months: Column) -> Column:
    """Equal monthly payment for a loan, rounded to two digits."""
    rate = yearly_rate / 12 / 100
    growth = F.pow(1 + rate, months)
    return F.round(amount * (rate * growth / (growth - 1)), 2)
