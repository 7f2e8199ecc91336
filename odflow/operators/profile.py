"""Profile of raw lines before any rule is applied."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odflow.functions import (
    field_count,
    is_blank,
    not_above_zero,
    parse_timestamp,
)
from odflow.operators.membership import mark_known
from odflow.spec import TRIP_FIELDS


def split_lines(lines: DataFrame) -> DataFrame:
    """``lines`` with the text of every cell; a missing cell is null."""
    cells = lines.withColumn("_fields", F.split("raw", ",", -1))
    return cells.select(
        "line_no",
        "raw",
        *(F.get("_fields", F.lit(i)).alias(n) for i, n in enumerate(TRIP_FIELDS)),
    )


def complete_lines(lines: DataFrame) -> DataFrame:
    """:func:`split_lines` of the lines with exactly one cell per column."""
    return split_lines(lines.filter(field_count(F.col("raw")) == len(TRIP_FIELDS)))


def field_counts(lines: DataFrame) -> DataFrame:
    """Lines by number of cells."""
    return lines.groupBy(field_count(F.col("raw")).alias("n_fields")).agg(
        F.count("*").alias("n_lines")
    )


def value_counts(complete: DataFrame, column: str = "kind") -> DataFrame:
    """Lines by value of one column."""
    return complete.groupBy(column).agg(F.count("*").alias("n_lines"))


def blank_counts(lines: DataFrame, columns: Sequence[str] = TRIP_FIELDS) -> DataFrame:
    """Missing or blank cells per column, all columns in one pass.

    ``columns`` names the cells by position, as a header does: see :func:`header_columns`.
    A line with fewer cells misses the last ones; cells beyond the columns do not count.
    """
    cells = F.split("raw", ",", -1)
    missing = (F.coalesce(is_blank(F.get("cells", F.lit(i))), F.lit(True)) for i in range(len(columns)))
    counts = lines.select(cells.alias("cells")).agg(
        F.array(
            *(
                F.struct(F.lit(name).alias("column"), F.count_if(m).alias("n_blank"))
                for name, m in zip(columns, missing, strict=True)
            )
        ).alias("counts")
    )
    return counts.select(F.inline("counts"))


def header_columns(header: str) -> list[str]:
    """The names in a header line, trimmed; unnamed and repeated ones get their position."""
    names: list[str] = []
    for place, cell in enumerate(header.split(","), 1):
        name = cell.strip()
        names.append(name if name and name not in names else f"{name}#{place}")
    return names


def mark_anomalies(complete: DataFrame, stations: DataFrame) -> DataFrame:
    """``complete`` with one boolean column per kind of anomaly.

    Unlike the rules, every anomaly of a line is marked, and ``nan`` and ``inf``
    count as positive numbers.
    """
    located = mark_known(complete, stations, ["origin", "destination"])
    unknown = F.col("origin_known").isNull() | F.col("destination_known").isNull()
    return located.select(
        "line_no",
        "raw",
        unknown.alias("unknown_station"),
        (F.col("origin") == F.col("destination")).alias("loop"),
        not_above_zero(F.col("duration")).alias("bad_duration"),
        not_above_zero(F.col("distance")).alias("bad_distance"),
        parse_timestamp(F.col("ts")).isNull().alias("bad_date"),
    )


ANOMALIES = ("unknown_station", "loop", "bad_duration", "bad_distance", "bad_date")


def anomaly_counts(marked: DataFrame) -> DataFrame:
    """Lines per anomaly, in one pass."""
    counts = marked.agg(*(F.count_if(F.col(a)).alias(a) for a in ANOMALIES))
    return counts.unpivot([], list(ANOMALIES), "anomaly", "n_lines")


def anomaly_samples(marked: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """The first lines with each anomaly, as many as ``sizes`` asks for.

    One pass for all anomalies; each map task passes on its first few lines of
    each, so a frequent anomaly does not gather in one task.
    """

    def named(anomaly: str) -> Column:
        return F.when(F.col(anomaly), F.lit(anomaly))

    found = marked.select(
        F.explode(F.array_compact(F.array(*map(named, sizes)))).alias("anomaly"),
        "line_no",
        "raw",
    )
    position = F.row_number().over(Window.partitionBy("anomaly").orderBy("line_no"))
    wanted = F.create_map(*(F.lit(x) for kv in sizes.items() for x in kv))
    return (
        found.withColumn("_position", position)
        .filter(F.col("_position") <= max(sizes.values()))
        .filter(F.col("_position") <= wanted[F.col("anomaly")])
        .drop("_position")
    )


def date_range(complete: DataFrame) -> DataFrame:
    """Smallest and largest date text among the texts that parse."""
    dated = F.when(parse_timestamp(F.col("ts")).isNotNull(), F.col("ts"))
    return complete.select(dated.alias("ts")).agg(
        F.min("ts").alias("min_date"), F.max("ts").alias("max_date")
    )


def repeated_ids(lines: DataFrame) -> DataFrame:
    """Ids on more than one line, over all lines, whatever their shape."""
    return (
        lines.groupBy(F.substring_index("raw", ",", 1).alias("trip_id"))
        .agg(F.count("*").alias("n_lines"))
        .filter(F.col("n_lines") > 1)
    )


def tail(lines: DataFrame, n: int = 5) -> DataFrame:
    """The last ``n`` lines."""
    return lines.orderBy(F.desc("line_no")).limit(n).orderBy("line_no")
