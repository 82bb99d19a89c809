"""Run registered queries and their SQL side by side: python -m checks.compare FOLDER [name ...]"""

from __future__ import annotations

import math
import sys
import time
import traceback
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import ORACLES
from checks.queries import QUERIES


def oracle_rows(folder: str, sql: str) -> tuple[list[str], list[tuple]]:
    connection = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    result = connection.execute(sql)
    return [c[0] for c in result.description], result.fetchall()


def _cell(value):
    if isinstance(value, float):
        return (1, "nan" if math.isnan(value) else f"{value:.9g}")
    return (0, "") if value is None else (2, str(value))


def normal_form(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(spark: SparkSession, folder: str, name: str) -> str | None:
    """None if both sides agree, else what differs."""
    frame = QUERIES[name](spark, folder)
    mine = frame.collect()
    if name not in ORACLES:
        return None
    names, theirs = oracle_rows(folder, ORACLES[name])
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(names)}"
    a, b = normal_form(frame.columns, mine), normal_form(names, theirs)
    if a == b:
        return None
    extra, lost = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
    return f"{len(a)} rows against {len(b)}; only here {extra}; only there {lost}"


def session(cpus: int = 8, partitions: int = 8) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def main() -> int:
    folder, chosen = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in chosen:
        started = time.time()
        try:
            problem = difference(spark, folder, name)
        except Exception:
            problem = "".join(traceback.format_exc().splitlines(True)[-12:])[:1800]
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print(f"{len(chosen) - bad} of {len(chosen)} agree; without SQL: {sorted(set(chosen) - set(ORACLES))}")
    return bad


if __name__ == "__main__":
    sys.exit(main() > 0)
