"""Typed CSV, result files and the month-partitioned Parquet layer."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from odflow.functions import between, month_of
from odflow.sources.lines import split_position
from odflow.spec import STATION_SCHEMA, TRIP_SCHEMA

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def read_stations(
    spark: SparkSession, path: str, schema: StructType = STATION_SCHEMA
) -> DataFrame:
    """Station table from CSV; a cell that does not convert stops the read."""
    return spark.read.csv(path, header=True, schema=schema, mode="FAILFAST")


def read_trips(
    spark: SparkSession,
    path: str,
    schema: StructType = TRIP_SCHEMA,
    header: bool = True,
) -> DataFrame:
    """Trip table from CSV, with the file position of every row.

    A cell that does not convert becomes null. ``file_path, block_start,
    scan_row`` order the rows as in the files, over any number of files.

    With ``header`` every file must begin with a header line. Without it all
    lines are data; a header then is a row without date and numbers.
    """
    reader = spark.read.option("timestampNTZFormat", TIMESTAMP_FORMAT)
    table = reader.csv(path, header=header, schema=schema, mode="PERMISSIVE")
    return table.select(*schema.fieldNames(), *split_position())


def read_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with types found by reading the data; costs one more full scan."""
    return spark.read.csv(path, header=True, inferSchema=True)


def write_result(df: DataFrame, path: str) -> None:
    """Result as CSV with a header, one part file per task."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_result(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A result written by :func:`write_result`."""
    return spark.read.csv(path, header=True, schema=schema, mode="FAILFAST")


def write_month_layer(trips: DataFrame, path: str) -> None:
    """Trips as Parquet, one folder per calendar month.

    ``rebalance`` gathers each month into files of the advisory size: few files
    per folder, and a month that holds most rows is written by many tasks.
    """
    (
        trips.withColumn("month", month_of(F.col("ts")))
        .hint("rebalance", F.col("month"))
        .write.mode("overwrite")
        .partitionBy("month")
        .parquet(path)
    )


def read_month_layer(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The layer; ``schema`` is that of the trips written, ``month`` is added."""
    fields = [f for f in schema.fields if f.name != "month"]
    full = StructType([*fields, StructField("month", StringType())])
    return spark.read.schema(full).parquet(path)


def in_period(layer: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Rows of the layer in ``[start, end)``; only the months touched are read."""
    last = end - timedelta(microseconds=1)
    return layer.filter(
        F.col("month").between(f"{start:%Y-%m}", f"{last:%Y-%m}")
        & between(F.col("ts"), start, end)
    )


def months(layer: DataFrame) -> DataFrame:
    """The months present in the layer."""
    return layer.select("month").distinct().orderBy("month")
