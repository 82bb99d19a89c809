"""Reading tables: typed CSV, Parquet, JDBC; listing and counting them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import StringType, StructType

from registra import schemas


# Stands for a quoted empty field while a file is read; no text holds it.
_QUOTED_EMPTY = "\x00"


def load_csv(
    reader: DataFrameReader | DataStreamReader, path: str, schema: StructType, multi_line: bool = False
) -> DataFrame:
    """CSV with a header, columns bound by position, quotes doubled inside quoted fields.

    An unquoted empty field is NULL, a quoted one is an empty text. A row that does not fit
    the schema fails the whole load. Text with line breaks needs `multi_line`, which makes
    one task read a whole file.
    """
    rows = (
        reader.schema(schema)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("enforceSchema", True)
        .option("escape", '"')
        .option("emptyValue", _QUOTED_EMPTY)
        .option("multiLine", multi_line)
        .csv(path)
    )
    return rows.select(
        *[
            F.when(F.col(f.name) == _QUOTED_EMPTY, "").otherwise(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, StringType)
            else F.col(f.name)
            for f in schema.fields
        ]
    )


def read_csv_table(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False) -> DataFrame:
    return load_csv(spark.read, path, schema, multi_line)


def read_user_logs(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return read_csv_table(spark, path, schemas.USER_LOGS, multi_line)


def read_departments(spark: SparkSession, path: str) -> DataFrame:
    return read_csv_table(spark, path, schemas.DEPARTMENTS)


def read_skill_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The six skills tables from `<folder>/<table>.csv`."""
    return {
        name: read_csv_table(spark, f"{folder}/{name}.csv", schema)
        for name, schema in schemas.SKILL_TABLES.items()
    }


def read_table(spark: SparkSession, fmt: str, path: str | None = None, schema: StructType | None = None, **options) -> DataFrame:
    """Any source Spark knows.

    For `jdbc` pass url, dbtable and, so that more than one task reads, partitionColumn,
    lowerBound, upperBound and numPartitions.
    """
    if fmt == "jdbc":
        split = {"partitionColumn", "lowerBound", "upperBound", "numPartitions"}
        given = split & options.keys()
        if given and given != split:
            raise ValueError(f"a partitioned read also needs {sorted(split - given)}")
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    """Names of the tables and views of a database, in order."""
    return sorted(t.name for t in spark.catalog.listTables(database))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: table_name, n_rows."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
