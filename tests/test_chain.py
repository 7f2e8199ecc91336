"""The whole chain on small files."""

from collections import Counter

from odflow.operators import quality
from odflow.plans import chain
from odflow.sources.scratch import materialize
from odflow.spec import TripSpec


def test_chain(spark, tmp_path):
    stations = ["station_id,nom,zone,latitude,longitude"]
    stations += [f"S{i},Station {i},{i % 2},48.{i},2.{i}" for i in range(4)]
    (tmp_path / "stations.csv").write_text("\r\n".join(stations) + "\r\n")
    trips = ["trajet_id,date_heure,depart,arrivee,duree,distance,abonnement"]
    n = 0
    for a in range(4):
        for b in range(4):
            for _ in range(a + 2 * b + 1 if a != b else 0):
                n += 1
                trips.append(
                    f"T{n},2026-0{n % 3 + 1}-05 09:00:00,S{a},S{b},{n},2.5,annuel"
                )
    trips.append("T1,2026-01-01 00:00:00,S0,S1,10,1.5,annuel")
    trips.append("X1,2026-01-01 00:00:00,S0,S9,10,1.5,annuel")
    (tmp_path / "trips.csv").write_text("\r\n".join(trips) + "\r\n")

    output = str(tmp_path / "out")
    results = chain.run(
        spark, str(tmp_path / "trips.csv"), str(tmp_path / "stations.csv"), output
    )

    def rows(name):
        return [tuple(r) for r in results[name].collect()]

    assert rows("reconciliation") == [(n + 2, n, 2, True)]
    assert [r[:2] for r in rows("rejects")] == [
        ("doublon_id", n + 1),
        ("station_inconnue", n + 2),
    ]
    assert all(identical for *_, identical in rows("comparison"))
    assert rows("graph_summary") == [(4, 12, 12, n)]
    assert rows("graph_completeness") == [(True,)]
    assert sum(r[1] for r in rows("trips_per_month")) == n
    assert rows("top_pairs")[0] == (1, "S2", "Station 2", "S3", "Station 3", 9)
    for name in results:
        assert list((tmp_path / "out" / name).glob("part-*.csv")), name
    assert len(list((tmp_path / "out" / "layer").glob("month=*"))) == 3
    assert dict(rows("profile_blanks")) == dict.fromkeys(trips[0].split(","), 0)

    # With the header given there is no scan for it, and the results are the same.
    given = chain.load(
        spark, str(tmp_path / "trips.csv"), str(tmp_path / "stations.csv"), header=trips[0]
    )
    found = chain.quality_results(given)
    for name in ("reject_summary", "rejects", "reconciliation"):
        assert [tuple(r) for r in found[name].collect()] == rows(name)


def test_repeats_settled_once_or_anew(spark):
    """Every result is the same with the written table of repeated ids and without it."""
    trip = "2026-01-05 09:00:00,S0,S1,5,2.5,annuel"
    raw = [f"T{i % 7},{trip}" for i in range(30)] + [f"U{i},{trip}" for i in range(5)]
    raw += [f"T1,{trip[:-3]}", "U1,x", "", f"T0,{trip}"]
    stations = spark.createDataFrame([("S0",), ("S1",)], "station_id STRING")
    for some in (raw, raw[30:35], raw[-4:-1], []):
        lines = spark.createDataFrame(list(enumerate(some, 1)), "line_no BIGINT, raw STRING")
        checked = quality.check_lines(lines, stations, TripSpec())
        repeated = materialize(quality.repeated_ids(checked), "repeated-ids")
        for of in (quality.classify, quality.valid_trips, quality.reject_rows, quality.reject_summary):
            anew, once = (Counter(of(*a).collect()) for a in ((checked,), (checked, repeated)))
            assert anew == once, of.__name__
        anew, once = (quality.reconcile(lines, *a).collect() for a in ((checked,), (checked, repeated)))
        assert anew == once and anew[0]["balanced"]


def test_settled_repeats_shuffle_no_line(spark, tmp_path):
    lines = spark.createDataFrame([(1, "a")], "line_no BIGINT, raw STRING")
    stations = spark.createDataFrame([("S0",)], "station_id STRING")
    checked = materialize(quality.check_lines(lines, stations, TripSpec()), "checked")
    repeated = materialize(quality.repeated_ids(checked), "repeated-ids")
    for of in (quality.valid_trips, quality.classify):
        plan = of(checked, repeated)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
