"""INSERT ... ON CONFLICT DO UPDATE between two tables with the same key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(existing: DataFrame, batch: DataFrame, keys: list[str], update: list[str] | None = None) -> DataFrame:
    """The complete new version of `existing`.

    Rows of `existing` missing in the batch stay. A key in both takes the `update`
    columns from the batch (all of them by default, NULLs included) and keeps the rest.
    Both sides have one row per key.
    """
    columns = existing.columns
    update = [c for c in columns if c not in keys] if update is None else update
    old = existing.select(*keys, F.struct(*columns).alias("_old"))
    new = batch.select(*keys, F.struct(*columns).alias("_new"))
    in_old, in_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()

    def merged(name: str):
        take_new = in_new if name in update else ~in_old
        return F.when(take_new, F.col(f"_new.{name}")).otherwise(F.col(f"_old.{name}")).alias(name)

    return old.join(new, keys, "full_outer").select(*[k if k in keys else merged(k) for k in columns])
