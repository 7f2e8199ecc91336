"""Reject counts of trip lines that arrive as text files.

Two streams read the files, each with a checkpoint of its own, and stop when nothing new
is there. The first applies rules 1 to 8 and writes the counts of every micro-batch. The
second keeps the first line of every trip id in the state store, for as long as the
watermark allows, and writes the trips it keeps. What passes the rules and is not kept is
a repeated id, or came too late for the state to know; late lines are counted.

Every result is a table of batches that a repeated batch overwrites, or a file sink, so a
stream that was stopped anywhere goes on from its checkpoint and counts nothing twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from odflow import spec as reasons
from odflow.operators import quality
from odflow.spec import REASONS, TRIP_FIELDS, TripSpec

_COUNTS = "reason STRING, n_lines BIGINT"
_LATE = "n_late BIGINT"


@dataclass(frozen=True)
class RejectStream:
    """Counts over the text files in ``source``, kept below ``folder``.

    ``folder`` is a shared one; whoever gives the same folder again goes on from there.
    ``delay`` is how much later than the latest trip a line may arrive by its own date; a
    repeated id is found if its lines are less than that apart. ``files_per_batch`` bounds
    a micro-batch. For states larger than the executors' memory, set the session's state
    store to RocksDB.

    A line equal to ``header`` is no data. ``stations`` is a table that does not change
    while a stream runs.
    """

    source: str
    stations: DataFrame
    folder: str
    spec: TripSpec = TripSpec()
    delay: str = "7 days"
    header: str | None = None
    files_per_batch: int = 64

    @property
    def _spark(self) -> SparkSession:
        return self.stations.sparkSession

    def _checked(self) -> DataFrame:
        lines = (
            self._spark.readStream.option("maxFilesPerTrigger", self.files_per_batch)
            .text(self.source)
            .select(F.lit(None).cast("bigint").alias("line_no"), F.col("value").alias("raw"))
        )
        if self.header is not None:
            lines = lines.filter(F.col("raw") != self.header)
        return quality.check_lines(lines, self.stations, self.spec)

    def start_counts(self) -> StreamingQuery:
        """Counts by reason of rules 1 to 8, one small table per batch."""

        def write(batch: DataFrame, number: int) -> None:
            counts = batch.groupBy("reason").agg(F.count("*").alias("n_lines"))
            counts.write.mode("overwrite").parquet(f"{self.folder}/counts/batch={number}")

        return (
            self._checked()
            .select("reason")
            .writeStream.foreachBatch(write)
            .option("checkpointLocation", f"{self.folder}/checkpoints/counts")
            .trigger(availableNow=True)
            .start()
        )

    def start_trips(self) -> StreamingQuery:
        """Lines that pass, the first of every id within the watermark."""
        trips = quality.passing(self._checked()).select(*TRIP_FIELDS)
        once = (
            trips.withColumn("arrives", F.col("ts").cast("timestamp"))
            .withWatermark("arrives", self.delay)
            .dropDuplicatesWithinWatermark(["trip_id"])
            .drop("arrives")
        )
        return (
            once.writeStream.format("parquet")
            .outputMode("append")
            .option("path", f"{self.folder}/trips")
            .option("checkpointLocation", f"{self.folder}/checkpoints/trips")
            .trigger(availableNow=True)
            .start()
        )

    def advance(self) -> None:
        """Read all files that are new, then stop."""
        self.start_counts().awaitTermination()
        query = self.start_trips()
        query.awaitTermination()
        self._note_late(query)

    def _note_late(self, query: StreamingQuery) -> None:
        """Write the late lines of each batch, from the progress reports of this run.

        The session keeps ``spark.sql.streaming.numRecentProgressUpdates`` of them; a run
        of more batches than that is refused rather than undercounted.
        """
        reports = query.recentProgress
        kept = int(self._spark.conf.get("spark.sql.streaming.numRecentProgressUpdates"))
        if len(reports) >= kept:
            raise ValueError("raise spark.sql.streaming.numRecentProgressUpdates or files_per_batch")
        late: dict[int, int] = {}
        for report in reports:
            dropped = sum(op.numRowsDroppedByWatermark for op in report.stateOperators)
            late[report.batchId] = max(dropped, late.get(report.batchId, 0))
        for number, n in late.items():
            row = self._spark.createDataFrame([(n,)], _LATE)
            row.write.mode("overwrite").parquet(f"{self.folder}/late/batch={number}")

    def trips(self) -> DataFrame:
        """The valid trips so far."""
        return self._spark.read.parquet(f"{self.folder}/trips")

    def late(self) -> DataFrame:
        """One row: ``n_late``, the passing lines that came behind the watermark."""
        found = self._spark.read.schema(_LATE).parquet(f"{self.folder}/late")
        return found.agg(F.coalesce(F.sum("n_late"), F.lit(0)).alias("n_late"))

    def summary(self) -> DataFrame:
        """``(rule_order, reason, n_lines)`` for all nine reasons, zeros included.

        Late lines are valid or repeated, nobody knows; they are in :meth:`late` alone.
        """
        by_reason = (
            self._spark.read.schema(_COUNTS)
            .parquet(f"{self.folder}/counts")
            .groupBy("reason")
            .agg(F.sum("n_lines").alias("n_lines"))
        )
        kept = self.trips().agg(F.count("*")).scalar()
        late = self.late().agg(F.max("n_late")).scalar()
        repeats = by_reason.filter(F.col("reason").isNull()).select(
            F.lit(reasons.DUPLICATE).alias("reason"), (F.col("n_lines") - kept - late).alias("n_lines")
        )
        found = by_reason.filter(F.col("reason").isNotNull()).unionByName(repeats)
        rules = self._spark.createDataFrame(
            list(enumerate(REASONS, 1)), "rule_order INT, reason STRING"
        )
        return (
            rules.join(found, "reason", "left")
            .select("rule_order", "reason", F.coalesce("n_lines", F.lit(0)).alias("n_lines"))
            .orderBy("rule_order")
        )

