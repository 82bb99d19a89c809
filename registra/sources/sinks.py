"""Writers: CSV folders, database tables and versioned mart tables."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registra.sources.tables import list_tables


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header and no index column; text is quoted where needed and keeps its blanks.

    Text with line breaks has to be read with `multi_line`.
    """
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_jdbc(df: DataFrame, page_size: int = 1000, **options) -> None:
    """Append to a database table from the executors, `page_size` rows per round trip."""
    df.write.format("jdbc").mode("append").options(batchsize=page_size, **options).save()


def ensure_database(spark: SparkSession, name: str, folder: str | None = None) -> None:
    """A database; a new one keeps its tables in `folder`, if given."""
    place = f" LOCATION '{folder}'" if folder else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")


def versions(spark: SparkSession, database: str, table: str) -> list[str]:
    """The written versions of a mart, oldest first."""
    return [name for name in list_tables(spark, database) if name.startswith(f"{table}__")]


def publish(
    df: DataFrame,
    name: str,
    folder: str,
    checks: dict[str, Callable[[DataFrame], DataFrame]] | None = None,
    keep: int = 2,
) -> int:
    """Write a complete new version of a mart, check it, then point `name` at it.

    `name` is database.table; readers see the old version or the new one, never a part.
    Each check returns the rows that break it; any such row stops the switch and removes the new version. After
    it the last `keep` versions stay, older ones go with their files. `folder` is where a database that is
    not there yet keeps its tables. Returns the number of rows of the new version.
    """
    spark = df.sparkSession
    database, table = name.split(".")
    ensure_database(spark, database, folder)
    version = f"{table}__{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
    df.write.saveAsTable(f"{database}.{version}")
    fresh = spark.table(f"{database}.{version}")
    for label, broken_rows in (checks or {}).items():
        if not broken_rows(fresh).isEmpty():
            spark.sql(f"DROP TABLE {database}.{version}")
            raise ValueError(f"{name}: check '{label}' failed, the old version stays")
    spark.sql(f"CREATE OR REPLACE VIEW {database}.{table} AS SELECT * FROM {database}.{version}")
    rows = fresh.count()
    for old in versions(spark, database, table)[: -max(1, keep)]:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{old}")
    return rows


def current_mart(spark: SparkSession, name: str) -> DataFrame | None:
    """The published version, or None before the first run."""
    database, table = name.split(".")
    if not spark.catalog.databaseExists(database):
        return None
    held = {t.name for t in spark.catalog.listTables(database) if not t.isTemporary}
    return spark.table(name) if table in held else None


class Part(Protocol):
    """A table written by `write_part`, and which of its buckets count."""

    table: str
    buckets: Sequence[int]


_PARTS = "registra.parts"


def dealt(rows: DataFrame, buckets: int, key: Sequence[str]) -> DataFrame:
    """Rows with their `bucket`, dealt for a write by bucket over as many tasks as a shuffle has.

    A bucket is cut by a hash of the key, another one than the bucket's, where there are fewer buckets than tasks.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = -(-tasks // buckets)
    return rows.repartition(max(tasks, buckets) if slices > 1 else buckets, "bucket", F.pmod(F.hash(*key), F.lit(slices)))


def write_part(
    rows: DataFrame, name: str, folder: str, buckets: int, key: Sequence[str], checks: dict[str, Callable[[DataFrame], DataFrame]] | None = None
) -> str:
    """Write rows of a mart, with their `bucket`, as a part of it; returns the table's name.

    Beside it a table of counts (bucket, total_events, n) is written; rows lie in order of their total, so that few
    are read for one total. Rows that break a check remove the part and raise, as for `publish`.
    """
    spark = rows.sparkSession
    database, table = name.split(".")
    ensure_database(spark, database, folder)
    part = f"{table}_part_{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
    placed = dealt(rows, buckets, key).sortWithinPartitions("bucket", "total_events")
    placed.write.partitionBy("bucket").saveAsTable(f"{database}.{part}")
    fresh = spark.table(f"{database}.{part}")
    fresh.groupBy("bucket", "total_events").agg(F.count(F.lit(1)).alias("n")).write.saveAsTable(f"{database}.{part}_counts")
    for label, broken_rows in (checks or {}).items():
        if not broken_rows(fresh).isEmpty():
            for written_table in (part, f"{part}_counts"):
                spark.sql(f"DROP TABLE {database}.{written_table}")
            raise ValueError(f"{name}: check '{label}' failed, the old version stays")
    return part


def _of_parts(name: str, parts: Iterable[Part], counts: bool = False) -> str:
    database = name.partition(".")[0]
    picked = [(f"{database}.{p.table}{'_counts' if counts else ''}", ", ".join(map(str, p.buckets)) or "NULL") for p in parts]
    return " UNION ALL ".join(f"SELECT * FROM {table} WHERE bucket IN ({buckets})" for table, buckets in picked)


def parts_frame(spark: SparkSession, name: str, parts: Iterable[Part], counts: bool = False) -> DataFrame:
    """The rows, or the counts, of the buckets that count."""
    return spark.sql(_of_parts(name, parts, counts))


def publish_parts(spark: SparkSession, name: str, parts: Sequence[Part], columns: list[str]) -> None:
    """Point `name` at the parts; readers see the old version or the new one."""
    listed = ",".join(p.table for p in parts)
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{_PARTS}' = '{listed}') AS SELECT {', '.join(columns)} FROM ({_of_parts(name, parts)})")


def published_parts(spark: SparkSession, name: str) -> list[str]:
    """The parts `name` points at; none if it was published whole."""
    held = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return held[_PARTS].split(",") if held.get(_PARTS) else []


def drop_parts(spark: SparkSession, name: str, keep: set[str]) -> None:
    """Parts of the mart that are not to be kept go with their files."""
    database, table = name.split(".")
    for found in list_tables(spark, database):
        if found.startswith(f"{table}_part_") and found.removesuffix("_counts") not in keep:
            spark.sql(f"DROP TABLE IF EXISTS {database}.{found}")
