"""Ordered quality rules: one reject reason per line, the first rule broken."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odflow import spec as reasons
from odflow.functions import (
    between,
    is_finite,
    month_of,
    parse_number,
    parse_timestamp,
    well_formed,
)
from odflow.operators.dedup import first_occurrence, repeated_keys
from odflow.operators.membership import mark_known
from odflow.spec import REASONS, TRIP_FIELDS, TripSpec


def parse_lines(lines: DataFrame) -> DataFrame:
    """``(line_no, raw)`` plus the typed trip columns.

    Columns are null where the text does not convert, all of them when the line
    does not have seven non-blank fields. Values are not trimmed.
    """
    fields = F.when(
        well_formed(F.col("raw"), len(TRIP_FIELDS)), F.split("raw", ",", -1)
    )
    cells = lines.withColumn("_fields", fields).select(
        "line_no",
        "raw",
        *(F.get("_fields", F.lit(i)).alias(n) for i, n in enumerate(TRIP_FIELDS)),
    )
    return cells.withColumns(
        {
            "ts": parse_timestamp(F.col("ts")),
            "duration": parse_number(F.col("duration")),
            "distance": parse_number(F.col("distance")),
        }
    ).withColumn("well_formed", F.col("trip_id").isNotNull())


def check_lines(lines: DataFrame, stations: DataFrame, spec: TripSpec) -> DataFrame:
    """Rules 1 to 8: parsed lines with ``reason``, null for a line that passes."""
    col = F.col
    numeric = F.coalesce(
        is_finite(col("duration")) & is_finite(col("distance")), F.lit(False)
    )
    reason = (
        F.when(~col("well_formed"), reasons.FORMAT)
        .when(col("ts").isNull(), reasons.DATE)
        .when(~between(col("ts"), spec.start, spec.end), reasons.PERIOD)
        .when(
            col("origin_known").isNull() | col("destination_known").isNull(),
            reasons.STATION,
        )
        .when(~numeric, reasons.NOT_NUMERIC)
        .when((col("duration") <= 0) | (col("distance") <= 0), reasons.NOT_POSITIVE)
        .when(col("origin") == col("destination"), reasons.LOOP)
        .when(~col("kind").isin(*spec.kinds), reasons.KIND)
    )
    located = mark_known(parse_lines(lines), stations, ["origin", "destination"])
    return located.select("line_no", "raw", *TRIP_FIELDS, reason.alias("reason"))


def passing(checked: DataFrame) -> DataFrame:
    """Lines that pass rules 1 to 8, without the then empty ``reason``."""
    return checked.filter(F.col("reason").isNull()).drop("reason")


def repeated_ids(checked: DataFrame) -> DataFrame:
    """``(trip_id, first_seen, n)`` of the ids that several passing lines have.

    This is all that the ninth rule needs. Written once, it settles the repeats for
    every function below that takes ``repeated``; without it each settles them anew.
    """
    return repeated_keys(passing(checked), "trip_id", "line_no")


def valid_trips(checked: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """Typed trips that pass all rules; the lowest line number of an id wins.

    Invalid lines are removed first, so they never hide a later valid line. With
    ``repeated`` only the lines of repeated ids are looked at, and none is shuffled
    as long as that table can be broadcast.
    """
    trips = passing(checked).select("line_no", *TRIP_FIELDS)
    if repeated is None:
        first = first_occurrence(trips, "trip_id", ["line_no"])
    else:
        is_later = F.coalesce(F.col("line_no") > F.col("first_seen"), F.lit(False))
        first = trips.join(repeated, "trip_id", "left").filter(~is_later)
    return first.select(*TRIP_FIELDS)


def classify(checked: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """``checked`` with the final ``reason``, duplicate ids included."""
    repeated = repeated_ids(checked) if repeated is None else repeated
    is_repeat = F.col("reason").isNull() & (F.col("line_no") > F.col("first_seen"))
    return (
        checked.join(repeated, "trip_id", "left")
        .withColumn(
            "reason",
            F.when(is_repeat, reasons.DUPLICATE).otherwise(F.col("reason")),
        )
        .select(*checked.columns)
    )


def reject_rows(checked: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """``(reason, line_no, raw)`` of every rejected line, in no order.

    Lines rejected by a rule and repeated ids come out of one pass.
    """
    return (
        classify(checked, repeated)
        .filter(F.col("reason").isNotNull())
        .select("reason", "line_no", "raw")
    )


def rejects(checked: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """:func:`reject_rows` in file order.

    A sort reads its input twice. Where lines are many and rejects few, write
    :func:`reject_rows` first and sort that.
    """
    return reject_rows(checked, repeated).orderBy("line_no")


def reason_counts(checked: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """``(reason, n_lines)`` including duplicates; null reason = valid.

    One pass over the lines. An id with n passing lines gives one valid line and n - 1
    duplicates. With ``repeated`` the lines are combined per reason in the map tasks;
    without it per (reason, id).
    """
    n = F.col("n")
    if repeated is None:
        passing_id = F.when(F.col("reason").isNull(), F.col("trip_id"))
        counts = checked.groupBy("reason", passing_id.alias("trip_id")).agg(
            F.count("*").alias("n")
        )
        later = n - 1
    else:
        counts = checked.groupBy("reason").agg(F.count("*").alias("n"))
        later = repeated.agg(F.coalesce(F.sum(n - 1), F.lit(0)).alias("later")).scalar()
    split = F.when(
        F.col("reason").isNull(),
        F.array(
            F.struct(F.lit(None).cast("string").alias("reason"), (n - later).alias("n")),
            F.struct(F.lit(reasons.DUPLICATE).alias("reason"), later.alias("n")),
        ),
    ).otherwise(F.array(F.struct("reason", "n")))
    return (
        counts.select(F.inline(split))
        .groupBy("reason")
        .agg(F.sum("n").alias("n_lines"))
    )


def reject_summary(checked: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """``(rule_order, reason, n_lines)`` for all nine reasons, zeros included."""
    spark = checked.sparkSession
    rules = spark.createDataFrame(
        list(enumerate(REASONS, 1)), "rule_order INT, reason STRING"
    )
    return (
        rules.join(reason_counts(checked, repeated), "reason", "left")
        .select(
            "rule_order",
            "reason",
            F.coalesce("n_lines", F.lit(0)).cast("bigint").alias("n_lines"),
        )
        .orderBy("rule_order")
    )


def reconcile(
    lines: DataFrame, checked: DataFrame, repeated: DataFrame | None = None
) -> DataFrame:
    """One row: lines read, valid and rejected, and whether they add up.

    ``lines`` are counted on their own, not derived from the other two.
    """
    n_lines = F.col("n_lines")
    valid = F.col("reason").isNull()
    read = lines.agg(F.count("*")).scalar()
    return (
        reason_counts(checked, repeated)
        .agg(
            F.coalesce(F.sum(F.when(valid, n_lines)), F.lit(0)).alias("n_valid"),
            F.coalesce(F.sum(F.when(~valid, n_lines)), F.lit(0)).alias("n_rejected"),
        )
        .select(read.alias("n_lines"), "n_valid", "n_rejected")
        .withColumn("balanced", n_lines == F.col("n_valid") + F.col("n_rejected"))
    )


def clean_typed(
    trips: DataFrame, stations: DataFrame, spec: TripSpec, order: list[str]
) -> DataFrame:
    """Valid rows of an already typed trip table, with their ``month``.

    The columnar form of the rules: nothing is tagged, rows just drop out.
    ``order`` decides which row of a repeated id is the first.
    """
    # One not-null test per column, unlike dropna, reaches the scan.
    complete = reduce(and_, (F.col(n).isNotNull() for n in TRIP_FIELDS))
    sound = trips.filter(
        complete
        & (F.col("duration") > 0)
        & (F.col("distance") > 0)
        & is_finite(F.col("duration"))
        & is_finite(F.col("distance"))
        & (F.col("origin") != F.col("destination"))
        & between(F.col("ts"), spec.start, spec.end)
        & F.col("kind").isin(*spec.kinds)
    )
    located = mark_known(sound, stations, ["origin", "destination"]).filter(
        F.col("origin_known") & F.col("destination_known")
    )
    columns = dict.fromkeys([*TRIP_FIELDS, *order])
    return first_occurrence(located.select(*columns), "trip_id", order).select(*TRIP_FIELDS, month_of(F.col("ts")).alias("month"))
