"""Code-to-label mappings and small text rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels the marts must show.
BACHELOR = "бакалавриат"
MASTER = "магистратура"
STATE_FUNDED = "бюджет"
CONTRACT = "контракт"
OTHER = "иное"
LOW = "низкая"
MEDIUM = "средняя"
HIGH = "высокая"


def code_position(code: Column) -> Column:
    """1 for code '1', 2 for code '2', 3 for anything else and for NULL."""
    text = code.cast("string")
    return F.when(text == "1", 1).when(text == "2", 2).otherwise(3)


def education_level(position: Column) -> Column:
    return F.when(position == 1, BACHELOR).when(position == 2, MASTER).when(position == 3, OTHER)


def education_base(position: Column) -> Column:
    return F.when(position == 1, STATE_FUNDED).when(position == 2, CONTRACT).when(position == 3, OTHER)


def payment_type(code: Column) -> Column:
    """Like `education_base`, but an unknown code stays as it is and NULL stays NULL."""
    return F.when(code == "1", STATE_FUNDED).when(code == "2", CONTRACT).otherwise(code)


def activity_category(quartile: Column) -> Column:
    return F.when(quartile == 1, LOW).when(quartile.isin(2, 3), MEDIUM).when(quartile == 4, HIGH)


def capitalize(text: Column) -> Column:
    """First letter upper, all the rest lower, over the whole text (not per word)."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substr(text, F.lit(2))))


def one_line(text: Column) -> Column:
    return F.replace(text, F.lit("\n"), F.lit(", "))
