"""The work folder every executor can reach, and tables written there to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_folder(spark: SparkSession) -> str:
    """This application's folder below `spark.checkpoint.dir`.

    Only a local session that has no such setting gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(tempfile.mkdtemp(prefix="registra-"))
        return context.getCheckpointDir()
    return f"{base.rstrip('/')}/registra/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the work folder that nobody has used."""
    return f"{work_folder(spark)}/{label}-{uuid.uuid4().hex}"


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """The rows dealt by a key over as many tasks as a shuffle has.

    Without it Spark gives a task 64 MB of compressed shuffle files or a whole small file: of a few narrow columns that is
    millions of rows to sort and to gather, or to unfold into wide ones.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write the rows once and go on from the files.

    Lost executors then cost nothing but the task at hand, and values that depend on the
    partitioning (row positions) are fixed for every later use.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
