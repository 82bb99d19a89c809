"""Mart jobs: read the present mart, work out the next version, check it, publish it.

A failing run leaves the published mart as it was and raises.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registra.operators import ranking
from registra.plans import marts
from registra.plans import state as store
from registra.sources.sinks import current_mart, drop_parts, parts_frame, publish, publish_parts, published_parts, write_part

# Parts a mart may lie in before the smaller ones are written together.
MOST_PARTS = 8
SMALL_MART = "dmr.analytics_student"
PERFORMANCE_MART = "dmr.analytics_student_performance"


def run_small_mart(logs: DataFrame, folder: str, as_of: datetime | None = None, name: str = SMALL_MART) -> int:
    """Refresh the small mart from the logs; returns its number of rows."""
    before = current_mart(logs.sparkSession, name)
    rows = marts.analytics_student(logs, before, as_of)
    return publish(rows, name, folder, marts.mart_checks(grades=[2, 3, 4, 5]))


def run_performance_mart(
    logs: DataFrame,
    departments: DataFrame,
    folder: str,
    as_of: datetime | None = None,
    variant: str = "v2",
    name: str = PERFORMANCE_MART,
) -> int:
    """Refresh the performance mart from the logs; returns its number of rows."""
    before = current_mart(logs.sparkSession, name)
    rows = marts.student_performance(logs, departments, before, as_of, variant)
    return publish(rows, name, folder, marts.mart_checks())


def add_batch(logs: DataFrame, state: str, batch: int, variant: str = "v2", buckets: int = 64) -> None:
    """Add a batch of logs to the state of the performance mart; a batch that comes again counts once."""
    store.add(logs, state, batch, variant, buckets)


def read_state(spark: SparkSession, state: str) -> DataFrame:
    return store.read(spark, state)


def run_arrivals(
    arrived: DataFrame,
    batch: int,
    state: str,
    departments: DataFrame,
    folder: str,
    as_of: datetime | None = None,
    variant: str = "v2",
    name: str = PERFORMANCE_MART,
    buckets: int = 64,
) -> int:
    """Refresh the performance mart once a batch of logs has arrived; returns its number of rows.

    Only the arrived rows are read as logs; those before are in the state, reduced to a row
    per pair and block of weeks. Of state and mart only the buckets are read and written that have changed since the mart was
    published; all of them if departments have, or if something else has published the mart. Rows of an older mart that
    the state knows nothing of stay. Quartiles need all rows: their cuts come from counts per total that the
    parts keep, and from the rows tied at a cut. What depends on all rows, the category and in v2 the time of the run, is
    worked out by the view, so unchanged rows are not written again. A batch that is there already changes the time only.
    """
    spark = arrived.sparkSession
    manifest = store.add(arrived, state, batch, variant, buckets)
    mart = manifest.marts.get(name)
    # A small dimension: one digest of all its rows, in any order.
    digest = departments.select(F.xxhash64(*departments.columns).alias("key")).agg(F.count("key"), F.sum(F.col("key").cast("decimal(38,0)")))
    digest = str(tuple(digest.first()))
    current = current_mart(spark, name)
    every = tuple(range(manifest.buckets))
    own = mart is not None and current is not None and published_parts(spark, name) == [p.table for p in mart.parts]
    touched = manifest.touched.get(name, ()) if own and mart.departments == digest else every
    parts = mart.parts if own else ()
    now = spark.range(1).select(F.unix_micros(F.lit(as_of) if as_of else F.current_timestamp())).first()[0]
    if touched:
        place = store.bucket_of(marts.KEY, manifest.buckets)
        before = None
        if own:
            before = parts_frame(spark, name, [replace(p, buckets=tuple(b for b in p.buckets if b in touched)) for p in parts]).drop("bucket")
        elif current is not None:
            before = current
        blocks = marts.merged_blocks(store.read(spark, state, touched))
        rows = marts.performance_rows(blocks, departments, before, as_of, variant).withColumn("bucket", place)
        kept = [replace(p, buckets=tuple(b for b in p.buckets if b not in touched)) for p in parts]
        kept = tuple(p for p in kept if p.buckets)
        if len(kept) >= MOST_PARTS:  # the smaller half goes into the new part
            kept = tuple(sorted(kept, key=lambda p: -len(p.buckets)))
            rows = rows.unionByName(parts_frame(spark, name, kept[MOST_PARTS // 2 :]).select(*rows.columns))
            touched = (*touched, *[b for p in kept[MOST_PARTS // 2 :] for b in p.buckets])
            kept = kept[: MOST_PARTS // 2]
        table = write_part(rows, name, folder, manifest.buckets, marts.KEY, marts.mart_checks())
        parts = (*kept, store.Part(table, tuple(sorted(touched))))
    counts = parts_frame(spark, name, parts, counts=True)
    held = parts_frame(spark, name, parts)
    cuts = ranking.rows_at(held, {c: F.col(c) for c in marts.ACTIVITY_ORDER}, buckets=4, counts=counts)
    publish_parts(spark, name, parts, marts.performance_view(cuts, now if variant == "v2" else None))
    published = store.Mart(parts, digest, tuple(p.table for p in mart.parts) if mart else ())
    store.write_manifest(spark, state, replace(manifest, marts=manifest.marts | {name: published}, touched=manifest.touched | {name: ()}))
    drop_parts(spark, name, keep={p.table for p in parts} | set(published.before))
    return counts.agg(F.sum("n")).first()[0] or 0
