"""Registered queries over time, intervals, streams and walks, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from odflow.operators import (
    asof,
    exact,
    graph,
    indicators,
    intervals,
    rolling,
    sessions,
    sketches,
    walks,
)
from odflow.plans import given_tables as given
from odflow.plans import oracle, registry
from odflow.sources.scratch import materialize, scratch_path
from odflow.streaming.rejects import RejectStream

PAGERANK_ROUNDS = 8
# Rounds of path doubling in the SQL: paths of up to 64 arcs.
DOUBLINGS = 6

_EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE"
_ORDERS = "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP_NTZ, o_totalprice DOUBLE"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(_EVENTS).parquet(f"{sf_dir}/events.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(_ORDERS).parquet(f"{sf_dir}/orders.parquet")


def event_last_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with the latest order of the customer before it, 24 years back."""
    past = events(spark, sf_dir).select(
        "event_id", "user_id", (F.col("ts") - F.expr("INTERVAL 24 YEARS")).alias("ts")
    )
    return asof.as_of_join(
        past,
        orders(spark, sf_dir),
        [("user_id", "o_custkey")],
        "ts",
        "o_orderdate",
        {"order_id": "o_orderkey", "ordered": "o_orderdate"},
        ["o_orderkey"],
    )


def purchase_next_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every purchase with the user's next error within a day."""
    found = events(spark, sf_dir)
    return asof.as_of_join(
        found.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts"),
        found.filter(F.col("event_type") == "error"),
        [("user_id", "user_id")],
        "ts",
        "ts",
        {"error_id": "event_id"},
        ["event_id"],
        direction="forward",
        allow_equal=False,
        within=F.expr("INTERVAL 1 DAY"),
    )


def supplier_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of order lines open at the same time at a supplier: pairs and days by supplier."""
    dates = orders(spark, sf_dir).select("o_orderkey", "o_orderdate")
    lines = given.table(spark, sf_dir, "lineitem")
    spans = lines.join(dates, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_suppkey",
        "l_orderkey",
        "l_linenumber",
        F.to_date("o_orderdate").alias("s"),
        F.to_date("l_shipdate").alias("e"),
    )
    pairs = intervals.overlaps(spans, ["l_suppkey"], ("s", "e"), ["l_orderkey", "l_linenumber"])
    days = F.date_diff(F.least("left.e", "right.e"), F.greatest("left.s", "right.s"))
    return pairs.groupBy(F.col("left.l_suppkey").alias("supplier")).agg(
        F.count("*").alias("n_pairs"),
        F.sum(days).alias("total_days"),
        F.max(days).cast("bigint").alias("most_days"),
    )


def user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of events with gaps below six hours."""
    bought = (F.col("event_type") == "purchase").cast("bigint")
    return sessions.sessions(
        events(spark, sf_dir),
        ["user_id"],
        "ts",
        "6 hours",
        {
            "n_purchases": ("sum", bought),
            "first_event": ("min", F.col("event_id")),
            "greatest_value": ("max", F.col("value")),
        },
    )


def stream_reject_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reject summary of the raw lines, read as a stream of files.

    Repeated ids lie up to six years apart in these tables, and so is the delay.
    """
    folder = scratch_path(spark, "stream")
    parts = given.lines(spark, sf_dir).select("raw", F.pmod(F.hash("raw"), F.lit(4)).alias("part"))
    parts.repartition(4, "part").select("raw").write.text(f"{folder}/in")
    stream = RejectStream(
        f"{folder}/in",
        given.line_stations(spark, sf_dir),
        f"{folder}/out",
        given.LINES_SPEC,
        delay="4000 days",
        files_per_batch=2,
    )
    stream.advance()
    return stream.summary()


def _graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    trips = registry.valid_trips(spark, sf_dir)
    return graph.vertices(given.stations(spark, sf_dir)), graph.arcs(trips)


def graph_pagerank(spark: SparkSession, sf_dir: str) -> DataFrame:
    vertices, arcs = _graph(spark, sf_dir)
    ranks = walks.pagerank(vertices, arcs, tolerance=0, max_rounds=PAGERANK_ROUNDS)
    return ranks.select("station_id", F.round("rank", 10).alias("rank"))


def graph_shortest_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest ways between stations; an arc costs the mean duration of its trips."""
    trips = registry.valid_trips(spark, sf_dir)
    sums = exact.partial_sums(trips, ["origin", "destination"], "duration")
    means = exact.totals(sums, ["origin", "destination"], "total").select(
        F.col("origin").alias("src"),
        F.col("destination").alias("dst"),
        (F.col("total") / F.col("n")).alias("cost"),
    )
    paths = walks.shortest_paths(means)
    return paths.select("source", "station_id", F.round("cost", 6).alias("cost"))


def thin_circles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strong components of stations by thin arcs only, those well below the mean weight."""
    vertices, arcs = _graph(spark, sf_dir)
    mean = arcs.agg(F.sum("weight") / F.count("*")).scalar()
    thin = arcs.filter(F.col("weight") < 0.9 * mean)
    return walks.strong_components(vertices, thin)


def rolling_departures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling.rolling_departures(registry.valid_trips(spark, sf_dir))


def trip_subtotals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indicators.subtotals(registry.valid_trips(spark, sf_dir), given.stations(spark, sf_dir))


def sum_count_fractional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of durations with 20 binary places, which neither sums nor decimals round."""
    cents = F.round(F.col("distance") * 100_000)
    trips = registry.valid_trips(spark, sf_dir).withColumn("duration", cents / float(1 << 20))
    return indicators.sum_and_count(trips)


QUANTILES = [0.1, 0.5, 0.9, 0.99]


def _quarter() -> Column:
    """Year and quarter of a month, as ``2026-Q1``."""
    number = F.ceil(F.substring("month", 6, 2).cast("int") / 3)
    return F.concat(F.substring("month", 1, 5), F.lit("Q"), number).alias("quarter")


def _quarters(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Valid trips with their quarter, and the sketches of the quarters from stored months."""
    trips = materialize(
        registry.valid_trips(spark, sf_dir).select("trip_id", "distance", "month", _quarter()),
        "sketched-trips",
    )
    state = sketches.sketch_state(trips, ["month"], {"ids": "trip_id"}, {"distances": "distance"})
    state = materialize(state, "month-sketches")
    return trips, sketches.merge_states(state, [_quarter()], ["ids"], ["distances"])


def sketched_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips and ids by quarter, and whether the estimate lies within five standard errors."""
    trips, quarters = _quarters(spark, sf_dir)
    exact_ids = trips.groupBy("quarter").agg(F.count_distinct("trip_id").alias("n_ids"))
    error = F.abs(sketches.distinct_estimate("ids") - F.col("n_ids"))
    bound = F.col("n_ids") * (5 * 1.04 / 2 ** (sketches.LG_K / 2))
    return quarters.join(exact_ids, "quarter").select(
        "quarter", F.col("n_rows").alias("n_trips"), "n_ids", (error <= bound).alias("within")
    )


def sketched_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each quantile of the distances of a quarter is right to 2 % of its ranks."""
    trips, quarters = _quarters(spark, sf_dir)
    estimates = quarters.select(
        "quarter", sketches.quantile_estimates("distances", QUANTILES).alias("at")
    )
    ranks = sketches.exact_ranks(
        trips.join(estimates, "quarter"), ["quarter"], "distance", "at", QUANTILES
    )
    near = (F.col("below") <= F.col("share") + 0.02) & (F.col("up_to") >= F.col("share") - 0.02)
    return ranks.select("quarter", "share", near.alias("within"))


_on_trips, _on_lines = oracle._on_trips, oracle._on_lines

_QUARTER_SQL = "concat(year(ts), '-Q', quarter(ts))"

_SPANS = """spans AS (
  SELECT l_suppkey AS supplier, l_orderkey AS k, l_linenumber AS l,
    o_orderdate::DATE AS s, l_shipdate::DATE AS e
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderdate::DATE < l_shipdate::DATE
)"""


def _pagerank_sql() -> str:
    parts = [
        "links AS (SELECT origin AS s, destination AS t, count(*) AS w FROM valid GROUP BY ALL)",
        "shares AS (SELECT s, t, w / sum(w) OVER (PARTITION BY s) AS share FROM links)",
        "r0 AS (SELECT station_id, 1.0::DOUBLE / count(*) OVER () AS rank FROM stations)",
    ]
    for i in range(1, PAGERANK_ROUNDS + 1):
        lost = f"coalesce((SELECT sum(rank) FROM r{i - 1} WHERE station_id NOT IN (SELECT s FROM links)), 0)"
        n = "(SELECT count(*) FROM stations)"
        given_to = f"(SELECT sum(rank * share) FROM shares JOIN r{i - 1} x ON x.station_id = s WHERE t = v.station_id)"
        parts.append(
            f"r{i} AS (SELECT station_id, 0.15::DOUBLE / {n} + 0.85::DOUBLE * {lost} / {n} "
            f"+ 0.85::DOUBLE * coalesce({given_to}, 0) AS rank FROM r{i - 1} v)"
        )
    return _on_trips(
        "SELECT station_id, round(rank, 10) AS rank FROM r%d" % PAGERANK_ROUNDS
    ).replace("\nSELECT station_id, round", ",\n" + ",\n".join(parts) + "\nSELECT station_id, round")


def _paths_sql() -> str:
    parts = [
        """d0 AS (
  SELECT origin AS s, destination AS t, sum(duration) / count(*) AS c FROM valid GROUP BY ALL
  UNION ALL SELECT DISTINCT origin, origin, 0.0::DOUBLE FROM valid)"""
    ]
    for i in range(1, DOUBLINGS + 1):
        parts.append(
            f"d{i} AS (SELECT s, t, min(c) AS c FROM (SELECT s, t, c FROM d{i - 1} UNION ALL "
            f"SELECT x.s, y.t, x.c + y.c FROM d{i - 1} x JOIN d{i - 1} y ON x.t = y.s) GROUP BY s, t)"
        )
    tail = f"SELECT s AS source, t AS station_id, round(c, 6) AS cost FROM d{DOUBLINGS}"
    return _on_trips(tail).replace(f"\n{tail}", ",\n" + ",\n".join(parts) + f"\n{tail}")


_CIRCLES = """,
links AS (SELECT origin AS s, destination AS t, count(*) AS w FROM valid GROUP BY ALL),
thin AS (SELECT s, t FROM links WHERE w < 0.9 * (SELECT sum(w)::DOUBLE / count(*) FROM links)),
reach AS (
  SELECT station_id AS s, station_id AS t FROM stations
  UNION SELECT r.s, a.t FROM reach r JOIN thin a ON a.s = r.t
)
SELECT x.s AS station_id, min(x.t) AS component
FROM reach x JOIN reach y ON x.s = y.t AND x.t = y.s GROUP BY x.s"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        event_last_order,
        purchase_next_error,
        supplier_overlaps,
        user_sessions,
        stream_reject_summary,
        graph_pagerank,
        graph_shortest_paths,
        thin_circles,
        rolling_departures,
        trip_subtotals,
        sum_count_fractional,
        sketched_distinct,
        sketched_quantiles,
    )
}

ORACLE: dict[str, str] = {
    "event_last_order": """
WITH past AS (SELECT event_id, user_id, ts - INTERVAL 24 YEAR AS ts FROM events),
last AS (
  SELECT o_custkey, o_orderdate, max(o_orderkey) AS o_orderkey FROM orders GROUP BY ALL
)
SELECT event_id, user_id, ts, o_orderkey AS order_id, o_orderdate AS ordered
FROM past ASOF LEFT JOIN last ON user_id = o_custkey AND ts >= o_orderdate""",
    "purchase_next_error": """
WITH errors AS (
  SELECT user_id, ts, min(event_id) AS error_id FROM events WHERE event_type = 'error' GROUP BY ALL
)
SELECT p.event_id, p.user_id, p.ts,
  CASE WHEN e.ts <= p.ts + INTERVAL 1 DAY THEN error_id END AS error_id
FROM events p ASOF LEFT JOIN errors e ON p.user_id = e.user_id AND p.ts < e.ts
WHERE p.event_type = 'purchase'""",
    "supplier_overlaps": f"""
WITH {_SPANS}
SELECT x.supplier, count(*) AS n_pairs,
  sum(least(x.e, y.e) - greatest(x.s, y.s))::BIGINT AS total_days,
  max(least(x.e, y.e) - greatest(x.s, y.s)) AS most_days
FROM spans x JOIN spans y ON x.supplier = y.supplier AND x.s < y.e AND y.s < x.e AND (x.k, x.l) < (y.k, y.l)
GROUP BY x.supplier""",
    "user_sessions": """
WITH marked AS (
  SELECT *, coalesce(ts >= lag(ts) OVER w + INTERVAL 6 HOUR, true)::INT AS opens
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)
), numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts) AS n FROM marked
)
SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n_rows,
  count(*) FILTER (event_type = 'purchase') AS n_purchases, min(event_id) AS first_event,
  max(value) AS greatest_value
FROM numbered GROUP BY user_id, n""",
    "stream_reject_summary": oracle.ORACLE["reject_summary"],
    "graph_pagerank": _pagerank_sql(),
    "graph_shortest_paths": _paths_sql(),
    "thin_circles": _on_trips("").rstrip().replace("WITH ", "WITH RECURSIVE ", 1) + _CIRCLES,
    "rolling_departures": _on_trips(
        """SELECT station_id, day, n_trips,
  sum(n_trips) OVER (PARTITION BY station_id ORDER BY day
    RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)::BIGINT AS n_rolling,
  n_trips - CASE WHEN lag(day) OVER w = day - INTERVAL 1 DAY THEN lag(n_trips) OVER w ELSE 0 END AS change
FROM (SELECT origin AS station_id, ts::DATE AS day, count(*) AS n_trips FROM valid GROUP BY ALL)
WINDOW w AS (PARTITION BY station_id ORDER BY day)"""
    ),
    "trip_subtotals": _on_trips(
        """SELECT (4 * grouping(month) + 2 * grouping(zone) + grouping(kind))::INT AS level,
  month, zone, kind, count(*) AS n_trips, sum(duration) AS total_duration,
  round(sum(duration) / count(*), 2) AS mean_duration
FROM valid JOIN stations ON origin = station_id GROUP BY CUBE (month, zone, kind)"""
    ),
    "sum_count_fractional": _on_trips(
        """SELECT origin, sum(round(distance * 100000)::HUGEINT)::DOUBLE / 1048576 AS total_duration,
  count(*) AS n_trips FROM valid GROUP BY origin"""
    ),
    "sketched_distinct": _on_trips(
        f"""SELECT {_QUARTER_SQL} AS quarter, count(*) AS n_trips,
  count(DISTINCT trip_id) AS n_ids, true AS within FROM valid GROUP BY quarter"""
    ),
    "sketched_quantiles": _on_trips(
        f"""SELECT DISTINCT {_QUARTER_SQL} AS quarter, share, true AS within
FROM valid, (SELECT unnest({QUANTILES}::DOUBLE[]) AS share)"""
    ),
}
