"""Table constraints as queries that return the rows breaking them."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once or hold a NULL, with their row count (n_rows)."""
    any_null = reduce(or_, [F.col(k).isNull() for k in keys])
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter((F.col("n_rows") > 1) | any_null)


def orphans(df: DataFrame, column: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Values of a foreign key that no parent has, with their row count. NULL is allowed.

    Rows are counted per value first, so the join sees one row per value.
    """
    values = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    return values.join(parents.select(F.col(parent_key).alias(column)), column, "left_anti")


def null_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.filter(reduce(or_, [F.col(c).isNull() for c in columns]))


def outside_domain(df: DataFrame, column: str, allowed: list) -> DataFrame:
    """Rows whose value is not allowed; NULL passes, as in a CHECK."""
    return df.filter(~F.col(column).isin(allowed))


def outside_range(df: DataFrame, columns: list[str], low: int, high: int) -> DataFrame:
    """Rows with a value below `low` or above `high`; NULL passes."""
    return df.filter(reduce(or_, [~F.col(c).between(low, high) for c in columns]))


def with_defaults(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Column defaults for rows in which the value is missing."""
    return df.withColumns({name: F.coalesce(F.col(name), value) for name, value in defaults.items()})
