"""Keep the performance mart up to date while log files arrive in a folder."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from registra import schemas
from registra.plans import jobs
from registra.sources.tables import load_csv


def follow_logs(
    spark: SparkSession,
    logs_folder: str,
    departments: DataFrame,
    mart_folder: str,
    checkpoint: str,
    name: str = jobs.PERFORMANCE_MART,
    as_of: datetime | None = None,
    state: str | None = None,
) -> StreamingQuery:
    """One mart run per group of new CSV files, until all present files are done.

    What a group adds is kept in `state`, by default a folder beside the mart's, under the number the
    stream gives the group; a group that is run again after a failure counts once.
    """
    state = state or f"{mart_folder}/{name}.state"

    def refresh(arrived: DataFrame, batch: int) -> None:
        jobs.run_arrivals(arrived, batch, state, departments, mart_folder, as_of, name=name)

    return (
        load_csv(spark.readStream, logs_folder, schemas.USER_LOGS)
        .writeStream.foreachBatch(refresh)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
