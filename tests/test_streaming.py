"""Reject counts of a stream against the batch rules, with restarts and late lines."""

from datetime import datetime
from pathlib import Path

import pytest

from odflow.operators import quality
from odflow.spec import TripSpec
from odflow.streaming.rejects import RejectStream

SPEC = TripSpec(datetime(2024, 1, 1), datetime(2025, 1, 1), ("day", "year"))
HEADER = "id,date,from,to,duration,distance,kind"


@pytest.fixture(scope="module")
def stations(spark):
    return spark.createDataFrame([("A", "a", 1), ("B", "b", 2)], "station_id STRING, name STRING, zone INT")


def line(trip_id, day, origin="A", minutes="5", kind="day"):
    return f"{trip_id},2024-{day} 08:00:00,{origin},B,{minutes},1.5,{kind}"


def write(folder, name, lines):
    folder.mkdir(exist_ok=True)
    temporary = folder.parent / name
    temporary.write_text("\n".join([HEADER, *lines, ""]))
    temporary.rename(folder / name)


def batch_summary(spark, folder, stations):
    texts = [x for f in sorted(folder.iterdir()) for x in f.read_text().splitlines() if x != HEADER]
    lines = spark.createDataFrame(list(enumerate(texts, 1)), "line_no BIGINT, raw STRING")
    return quality.reject_summary(quality.check_lines(lines, stations, SPEC)).collect()


def stream(folder, stations, **options):
    options = {"delay": "30 days", "header": HEADER, "files_per_batch": 1, **options}
    return RejectStream(f"{folder}/in", stations, f"{folder}/out", SPEC, **options)


FIRST = [line("T1", "01-01"), line("T1", "01-02"), line("T2", "01-02", "X"), line("T3", "13-45"), "x,y"]
SECOND = [line("T1", "01-03"), line("T4", "01-04"), line("T4", "01-05", kind="none"), line("T5", "01-04", "B")]
THIRD = [line("T4", "01-06"), line("T6", "01-06", minutes="nan"), line("T6", "01-06"), line("T7", "01-05")]


def test_equals_the_batch_and_goes_on_after_a_stop(spark, stations, tmp_path):
    source = Path(tmp_path, "in")
    write(source, "a.csv", FIRST)
    write(source, "b.csv", SECOND)
    stream(tmp_path, stations).advance()
    assert stream(tmp_path, stations).summary().collect() == batch_summary(spark, source, stations)
    # Nothing new: nothing changes.
    again = stream(tmp_path, stations)
    again.advance()
    assert again.summary().collect() == batch_summary(spark, source, stations)
    # A new object over the same folder finds ids that the state store remembers.
    write(source, "c.csv", THIRD)
    later = stream(tmp_path, stations)
    later.advance()
    assert later.summary().collect() == batch_summary(spark, source, stations)
    assert later.late().first()["n_late"] == 0
    assert sorted(r["trip_id"] for r in later.trips().collect()) == ["T1", "T4", "T6", "T7"]


def test_failed_batch_is_not_counted_twice(spark, stations, tmp_path, monkeypatch):
    source = Path(tmp_path, "in")
    write(source, "a.csv", FIRST)
    stream(tmp_path, stations).advance()
    write(source, "b.csv", SECOND)
    # The counts are written, and then the process is lost before the trips are.
    broken = stream(tmp_path, stations)
    broken.start_counts().awaitTermination()
    # A batch whose commit is lost is read again.
    commits = sorted(Path(tmp_path, "out/checkpoints/counts/commits").glob("[0-9]*"))
    commits[-1].unlink()
    for crc in Path(tmp_path, "out/checkpoints/counts/commits").glob(f".{commits[-1].name}.crc"):
        crc.unlink()
    whole = stream(tmp_path, stations)
    whole.advance()
    assert whole.summary().collect() == batch_summary(spark, source, stations)


def test_late_lines_are_counted(spark, stations, tmp_path):
    source = Path(tmp_path, "in")
    job = stream(tmp_path, stations, delay="2 days")
    for name, lines in (
        ("a.csv", [line("T1", "03-01")]),
        ("b.csv", [line("T2", "03-20"), line("T1", "03-02")]),
        ("c.csv", [line("T3", "03-10"), line("T2", "03-19"), line("T1", "03-01")]),
    ):
        write(source, name, lines)
        job.advance()
    # T3 and T1 come after the watermark has passed 03-18: neither valid nor repeated.
    assert job.late().first()["n_late"] == 2
    counts = {r["reason"]: r["n_lines"] for r in job.summary().collect()}
    assert sum(counts.values()) == counts["doublon_id"] == 2
    assert sorted(r["trip_id"] for r in job.trips().collect()) == ["T1", "T2"]


def test_no_lines(spark, stations, tmp_path):
    source = Path(tmp_path, "in")
    write(source, "a.csv", [])
    job = stream(tmp_path, stations)
    job.advance()
    assert {r["n_lines"] for r in job.summary().collect()} == {0}
