"""Mark which stations of a row are known, one row in, one row out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mark_known(df: DataFrame, stations: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with ``<column>_known``: true, or null for an id not in ``stations``.

    Ids are made distinct, so that a repeated station multiplies no row. The hash
    in the distinct changes nothing in the result, but it keeps the planner from
    reusing that shuffle for the join: a join side that is shuffled on its own can
    be matched in pieces when one station holds very many rows. A small station
    table is broadcast as usual.
    """
    known = (
        stations.select("station_id", F.xxhash64("station_id").alias("_hash"))
        .distinct()
        .drop("_hash")
    )
    for column in columns:
        side = known.select(
            F.col("station_id").alias(column), F.lit(True).alias(f"{column}_known")
        )
        df = df.join(side, column, "left")
    return df
