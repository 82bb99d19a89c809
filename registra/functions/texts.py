"""The order of texts as a declared property: binary, or one of Spark's collations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BINARY = "UTF8_BINARY"  # by code points, capitals before small letters
NO_CASE = "UTF8_LCASE"  # as if all letters were small
UNICODE = "UNICODE"  # letters of any alphabet by the root collation, accents and case last


def in_order(text: Column, collation: str = BINARY) -> list[Column]:
    """Sort parts: the text by the collation, then, where that calls two texts equal, by code points."""
    return [F.collate(text.cast("string"), collation), text.cast("string")]


def largest(rows: DataFrame, keys: list[str], text: str, collation: str = BINARY, out: str = "largest") -> DataFrame:
    """The last text of every key in the order; NULL if it has none.

    Texts are made distinct first, which reduces them by hash in each task.
    """
    parts = F.struct(*[p.alias(f"p{i}") for i, p in enumerate(in_order(F.col(text), collation))])
    last = F.max(F.when(F.col(text).isNotNull(), parts))
    return rows.select(*keys, text).distinct().groupBy(*keys).agg(last["p1"].alias(out))


def placed(rows: DataFrame, keys: list[str], text: str, collation: str = BINARY, out: str = "place") -> DataFrame:
    """Distinct (keys, text) with the text's place from 1 among those of its key."""
    order = W.partitionBy(*keys).orderBy(*in_order(F.col(text), collation))
    return rows.select(*keys, text).distinct().withColumn(out, F.row_number().over(order))
