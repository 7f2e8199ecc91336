"""Trips, stations and raw lines derived from order tables in Parquet.

An order line is a trip from the nation of the customer to the nation of the
supplier. The raw lines are built from orders, with defects placed by modulo
rules, so that every quality rule has work to do.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from odflow.spec import TripSpec

_PERIOD = {"start": datetime(1996, 1, 1), "end": datetime(2001, 1, 1)}
TRIPS_SPEC = TripSpec(**_PERIOD, kinds=("A", "N", "R"))
LINES_SPEC = TripSpec(**_PERIOD, kinds=("F", "O", "P"))

# Order of the rows of a repeated trip id.
TRIP_ORDER = ["ts", "l_partkey", "l_suppkey"]


# The columns used, declared so that no file is opened to find the schema.
_COLUMNS = {
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
        "l_quantity DOUBLE, l_extendedprice DOUBLE, l_returnflag STRING, "
        "l_shipdate TIMESTAMP_NTZ"
    ),
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, "
        "o_orderdate TIMESTAMP_NTZ"
    ),
    "customer": "c_custkey BIGINT, c_nationkey INT",
    "supplier": "s_suppkey BIGINT, s_nationkey INT",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as stations, regions as zones."""
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("station_id"),
        F.col("n_name").alias("name"),
        F.col("n_regionkey").alias("zone"),
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as trips; ids repeat.

    Orders meet customers before they meet the order lines, so that the large
    table is joined twice, not three times.
    """
    origins = (
        table(spark, sf_dir, "orders")
        .join(
            table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
        )
        .select("o_orderkey", F.col("c_nationkey").alias("origin"))
    )
    destinations = table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.col("s_nationkey").alias("destination")
    )
    return (
        table(spark, sf_dir, "lineitem")
        .join(origins, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(destinations, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("trip_id"),
            F.col("l_shipdate").alias("ts"),
            "origin",
            "destination",
            F.col("l_quantity").alias("duration"),
            (F.col("l_extendedprice") / 1000).alias("distance"),
            F.col("l_returnflag").alias("kind"),
            "l_partkey",
            "l_suppkey",
        )
    )


def line_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations as the raw lines name them: ``S`` and the nation key."""
    return stations(spark, sf_dir).withColumn(
        "station_id", F.concat(F.lit("S"), F.col("station_id"))
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(line_no, raw)``: one comma-separated line per order, some defective."""
    k = F.col("o_orderkey")

    def at(modulus: int, remainder: int) -> Column:
        return k % modulus == remainder

    trip_id = F.concat(F.lit("T"), F.when(at(89, 5), k - 1).otherwise(k))
    date = (
        F.when(at(97, 1), "01/02/2000 10:00")
        .when(at(83, 2), "2000-2-1 3:4:5")
        .otherwise(F.col("o_orderdate").cast("string"))
    )
    origin = (
        F.when(at(101, 3), "S99")
        .when(at(151, 13), " ")
        .otherwise(F.concat(F.lit("S"), F.col("c_nationkey")))
    )
    destination = F.concat(F.lit("S"), k % 25)
    duration = (
        F.when(at(103, 4), "inconnu")
        .when(at(107, 5), "nan")
        .when(at(109, 6), "0")
        .when(at(113, 7), "15d")
        .when(at(127, 8), "1_5")
        .otherwise((k % 60 + 1).cast("string"))
    )
    distance = (
        F.when(at(131, 9), "inf")
        .when(at(137, 10), "-1")
        .when(at(157, 14), "1e400")
        .otherwise(F.concat_ws(".", k % 20 + 1, k % 90 + 10))
    )
    kind = F.when(at(139, 11), "X").otherwise(F.col("o_orderstatus"))
    # concat_ws leaves out a null, here the last field of a short line.
    last = F.when(~at(149, 12), kind)
    raw = F.concat_ws(
        ",", trip_id, date, origin, destination, duration, distance, last
    )
    # explode of a single value: later filters on the text then use the value
    # and do not repeat this long expression, as if the line had been scanned.
    return (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select((k + 1).alias("line_no"), F.explode(F.array(raw)).alias("raw"))
    )
