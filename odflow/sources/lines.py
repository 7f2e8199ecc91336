"""Raw text lines: scan, header removal, line numbers in file order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from odflow.sources.scratch import materialize

# A split as the join of the offsets sees it: the hash stands for the path's text, and
# only has to tell apart the files that one task reads.
_SPLIT = ["task", "file", "block_start"]

# Splits whose offsets are sent to every executor: at most 100 MB as a hash table.
MAX_BROADCAST_SPLITS = 1_500_000


def read_lines(
    spark: SparkSession, path: str | list[str], header: str | None = None
) -> DataFrame:
    """One row per line: ``raw`` and the input split the line was read from.

    Every line equal to ``header`` is dropped, wherever it stands.
    """
    lines = spark.read.text(path).select(
        F.col("value").alias("raw"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )
    return lines if header is None else drop_header(lines, header)


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of the data, files by path; None if there is no line.

    Empty files do not count. All files are scanned for it: give the header where it
    is known.
    """
    lines = spark.read.text(path).select("value", *split_position())
    place = F.struct("file_path", "block_start", "scan_row")
    return lines.agg(F.min_by("value", place).alias("value")).first()["value"]


def drop_header(lines: DataFrame, header: str) -> DataFrame:
    """Remove the lines whose text is exactly ``header``."""
    return lines.filter(F.col("raw") != header)


def drop_header_prefix(lines: DataFrame, prefix: str) -> DataFrame:
    """Remove the lines that begin with ``prefix``."""
    return lines.filter(~F.col("raw").startswith(prefix))


def split_position() -> list[Column]:
    """File position of a row as sortable columns, for a table just scanned.

    File, start of the split in the file, and row order inside the scan task: a
    total order that equals file order, also over several files.
    """
    return [
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("scan_row"),
    ]


def number_lines(lines: DataFrame) -> DataFrame:
    """``(line_no, raw)``: 1-based numbers in file order, files by path.

    ``lines`` comes from :func:`read_lines`. The first pass counts the lines of
    every input split and keeps only those counts: one row per split, whose
    running total is the offset of the split. The second pass adds the offset
    to the position inside the split. Up to ``MAX_BROADCAST_SPLITS`` splits, that is
    190 TB in splits of 128 MB, the offsets are broadcast and no line is shuffled;
    beyond that the planner chooses the join.

    Both passes must see the same splits. A split that the first pass did not
    see stops the query instead of giving wrong numbers; fixing
    ``spark.sql.files.minPartitionNum`` keeps the splits stable while executors
    come and go.
    """
    located = lines.select(
        "raw",
        "file_path",
        F.xxhash64("file_path").alias("file"),
        "block_start",
        F.spark_partition_id().alias("task"),
        F.monotonically_increasing_id().alias("scan_row"),
    )
    splits = located.groupBy(*_SPLIT, "file_path").agg(
        F.min("scan_row").alias("first_row"), F.count("*").alias("n_lines")
    )
    # One small row per input split goes through this window, never a line.
    before = Window.orderBy("file_path", "block_start").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = materialize(
        splits.select(
            *_SPLIT,
            (
                F.coalesce(F.sum("n_lines").over(before), F.lit(0)) - F.col("first_row")
            ).alias("shift"),
        ),
        "split-offsets",
    )
    if offsets.count() <= MAX_BROADCAST_SPLITS:
        offsets = F.broadcast(offsets)
    shift = F.coalesce(
        "shift",
        F.raise_error(F.lit("input splits changed between two scans")).cast("bigint"),
    )
    return located.join(offsets, _SPLIT, "left").select(
        (F.col("scan_row") + shift + 1).alias("line_no"), "raw"
    )


def line_count(lines: DataFrame) -> DataFrame:
    """One row: the number of data lines."""
    return lines.agg(F.count("*").alias("n_lines"))
