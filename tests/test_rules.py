"""The ordered rules, against named cases and against a plain Python model."""

import math
import random
from datetime import datetime

import pytest

from odflow.operators import quality
from odflow.spec import TripSpec

SPEC = TripSpec()
STATIONS = ["S01", "S02", "S03"]
GOOD = ["T9", "2026-02-14 08:30:00", "S01", "S03", "21", "4.75", "mensuel"]


def line(**changes):
    names = ["trip_id", "ts", "origin", "destination", "duration", "distance", "kind"]
    return ",".join(changes.get(n, v) for n, v in zip(names, GOOD))


CASES = [
    ("good line", line(), None),
    ("six fields", ",".join(GOOD[:6]), "format_invalide"),
    ("eight fields", line() + ",x", "format_invalide"),
    ("empty line", "", "format_invalide"),
    ("empty field", line(destination=""), "format_invalide"),
    ("blank id", line(trip_id="  "), "format_invalide"),
    ("no-break space only", line(kind=" "), "format_invalide"),
    ("separator character only", line(kind="\x1f"), "format_invalide"),
    ("trailing comma", line(kind="mensuel,"), "format_invalide"),
    ("other date order", line(ts="14/02/2026 08:30"), "date_invalide"),
    ("date without time", line(ts="2026-02-14"), "date_invalide"),
    ("no such day", line(ts="2026-02-30 08:30:00"), "date_invalide"),
    ("hour 24", line(ts="2026-02-14 24:00:00"), "date_invalide"),
    ("second 60", line(ts="2026-02-14 08:30:60"), "date_invalide"),
    ("year 0", line(ts="0000-02-14 08:30:00"), "date_invalide"),
    ("trailing blank in date", line(ts="2026-02-14 08:30:00 "), "date_invalide"),
    ("fraction of a second", line(ts="2026-02-14 08:30:00.5"), "date_invalide"),
    ("T between date and time", line(ts="2026-02-14T08:30:00"), "date_invalide"),
    ("unpadded date", line(ts="2026-2-1 3:4:5"), None),
    ("wide gap in date", line(ts="2026-02-14   08:30:00"), None),
    ("day padded with a blank", line(ts="2026-02- 4 08:30:00"), None),
    ("just before", line(ts="2025-12-31 23:59:59"), "hors_periode"),
    ("first moment", line(ts="2026-01-01 00:00:00"), None),
    ("last second", line(ts="2026-03-31 23:59:59"), None),
    ("end is excluded", line(ts="2026-04-01 00:00:00"), "hors_periode"),
    ("unknown destination", line(destination="S77"), "station_inconnue"),
    ("unknown origin", line(origin="S77"), "station_inconnue"),
    ("station not trimmed", line(origin="S01 "), "station_inconnue"),
    ("quotes are not removed", line(origin='"S01"'), "station_inconnue"),
    ("duration as a word", line(duration="dix"), "valeur_non_numerique"),
    ("duration nan", line(duration="nan"), "valeur_non_numerique"),
    ("distance inf", line(distance="inf"), "valeur_non_numerique"),
    ("distance -Infinity", line(distance="-Infinity"), "valeur_non_numerique"),
    ("overflow", line(distance="1e400"), "valeur_non_numerique"),
    ("Java suffix", line(duration="15d"), "valeur_non_numerique"),
    ("hexadecimal", line(duration="0x1F"), "valeur_non_numerique"),
    ("double underscore", line(duration="1__5"), "valeur_non_numerique"),
    ("underscore", line(duration="1_5"), None),
    ("blanks around a number", line(duration=" 15\t"), None),
    ("forms of numbers", line(duration="+1.5e1", distance=".5"), None),
    ("trailing point", line(duration="15."), None),
    ("zero duration", line(duration="0"), "valeur_non_positive"),
    ("negative distance", line(distance="-2.5"), "valeur_non_positive"),
    ("underflow to zero", line(distance="1e-400"), "valeur_non_positive"),
    ("loop", line(origin="S02", destination="S02"), "boucle"),
    ("unknown kind", line(kind="libre"), "abonnement_inconnu"),
    ("kind is case-sensitive", line(kind="Mensuel"), "abonnement_inconnu"),
    ("station before value", line(origin="S77", duration="0"), "station_inconnue"),
    ("number before sign", line(duration="x", distance="-1"), "valeur_non_numerique"),
    ("date before station", line(ts="x", origin="S77"), "date_invalide"),
    ("loop before kind", line(origin="S03", kind="libre"), "boucle"),
]


def check(spark, raw_lines):
    lines = spark.createDataFrame(
        list(enumerate(raw_lines, 1)), "line_no BIGINT, raw STRING"
    )
    stations = spark.createDataFrame([(s,) for s in STATIONS], "station_id STRING")
    return quality.check_lines(lines, stations, SPEC)


@pytest.fixture(scope="module")
def case_reasons(spark):
    rows = check(spark, [raw for _, raw, _ in CASES]).collect()
    return {r["line_no"]: r["reason"] for r in rows}


@pytest.mark.parametrize("number", range(1, len(CASES) + 1))
def test_case(case_reasons, number):
    name, _, expected = CASES[number - 1]
    assert case_reasons[number] == expected, name


def model(raw):
    """Reason by Python's own conversions; first entry that holds."""

    def finite(text):
        try:
            return math.isfinite(float(text))
        except ValueError:
            return False

    def moment(text):
        try:
            return datetime.strptime(text, "%Y-%m-%d %H:%M:%S")
        except ValueError:
            return None

    cells = raw.split(",")
    if len(cells) != 7 or not all(map(str.strip, cells)):
        return "format_invalide"
    _, date, origin, destination, duration, distance, kind = cells
    when, numbers = moment(date), [duration, distance]
    broken = [
        ("date_invalide", lambda: when is None),
        ("hors_periode", lambda: when < SPEC.start or when >= SPEC.end),
        ("station_inconnue", lambda: not {origin, destination} <= set(STATIONS)),
        ("valeur_non_numerique", lambda: not all(map(finite, numbers))),
        ("valeur_non_positive", lambda: min(map(float, numbers)) <= 0),
        ("boucle", lambda: origin == destination),
        ("abonnement_inconnu", lambda: kind not in SPEC.kinds),
    ]
    return next((reason for reason, test in broken if test()), None)


DATES = """2026-02-14 08:30:00|2026-2-1 3:4:5|2026-02-30 00:00:00|2026-03-31 23:59:59
2026-04-01 00:00:00|2026-00-10 10:00:00|2026-1-32 1:1:1|2026-02-1  9:9:9|2026-02- 3 1:2:3
2026-02-14 8:60:00|2026-02-14 08:30|26-02-14 08:30:00|12026-02-14 08:30:00
2026-02-14 08:30:61|2026-13-01 00:00:00|2026-02-14 008:30:00|2024-02-29 00:00:00
2026-02-29 00:00:00|2026-02-14 08:30:00x| 2026-02-14 08:30:00|2026-02-14-08:30:00
2026-02- 0 1:2:3|2026-02-00 1:2:3|2026- 2-14 08:30:00|2026-02-  4 08:30:00""".replace(
    "\n", "|"
).split("|")
NUMBERS = """15|0|-0|-3|1.5|.5|5.|.|+2|+-2|1e3|1E-3|e3|1e|1_0|_1|1_|1_.5|1._5|1.5_0|1e1_0
nan|NaN|+nan|inf|-inf|Infinity|infinit|1e400|-1e400|1e-400|15d|15f|15L|0x10|1,5|1 5
 7 |\t8|9 | 7|--1|1e+2|1e++2|1__0|00012|1.2.3|true|1\x1c""".replace(
    "\n", "|"
).split("|")


def test_equal_to_python_on_random_lines(spark):
    rng = random.Random(11)
    lines = []
    for i in range(4000):
        cells = [
            rng.choice([f"T{i}", "", " ", "　"]) if rng.random() < 0.1 else f"T{i}",
            rng.choice(DATES) if rng.random() < 0.5 else DATES[0],
            rng.choice([*STATIONS, "S4", " S01"]) if rng.random() < 0.3 else "S01",
            rng.choice([*STATIONS, "s02", ""]) if rng.random() < 0.3 else "S02",
            rng.choice(NUMBERS) if rng.random() < 0.5 else "12",
            rng.choice(NUMBERS) if rng.random() < 0.3 else "3.25",
            rng.choice([*SPEC.kinds, "autre", "\x85"]),
        ]
        if rng.random() < 0.03:
            cells.pop(rng.randrange(7))
        lines.append(",".join(cells))
    got = {r["line_no"]: r["reason"] for r in check(spark, lines).collect()}
    wrong = [
        (raw, got[i], model(raw))
        for i, raw in enumerate(lines, 1)
        if got[i] != model(raw)
    ]
    assert not wrong, wrong[:5]
    assert set(got.values()) >= {None, "format_invalide", "date_invalide", "boucle"}


def test_values_of_passing_lines_equal_python(spark):
    lines = [line(duration=n) for n in NUMBERS] + [line(ts=d) for d in DATES]
    for row in check(spark, lines).filter("reason IS NULL").collect():
        cells = row["raw"].split(",")
        assert row["duration"] == float(cells[4])
        assert row["ts"] == datetime.strptime(cells[1], "%Y-%m-%d %H:%M:%S")
        assert row["kind"] == cells[6]
