"""The registered queries as SQL over the same tables."""

from __future__ import annotations

_PERIOD = "TIMESTAMP '1996-01-01' <= ts AND ts < TIMESTAMP '2001-01-01'"

_TRIPS = f"""
stations AS (
  SELECT n_nationkey AS station_id, n_name AS name, n_regionkey AS zone FROM nation
),
trips AS (
  SELECT l_orderkey || '-' || l_linenumber AS trip_id, l_shipdate AS ts,
         c_nationkey AS origin, s_nationkey AS destination,
         l_quantity AS duration, l_extendedprice / 1000 AS distance,
         l_returnflag AS kind, l_partkey, l_suppkey
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
),
sound AS (
  SELECT *, row_number() OVER (
      PARTITION BY trip_id ORDER BY ts, l_partkey, l_suppkey) AS rn
  FROM trips
  WHERE {_PERIOD} AND duration > 0 AND distance > 0
    AND isfinite(duration) AND isfinite(distance)
    AND origin <> destination AND kind IN ('A', 'N', 'R')
    AND origin IN (SELECT station_id FROM stations)
    AND destination IN (SELECT station_id FROM stations)
    AND trip_id IS NOT NULL
),
valid AS (
  SELECT trip_id, ts, origin, destination, duration, distance, kind,
         strftime(ts, '%Y-%m') AS month
  FROM sound WHERE rn = 1
),
flows AS (
  SELECT station_id, name, zone, n_departures, n_arrivals
  FROM stations
  JOIN (SELECT origin AS station_id, count(*) AS n_departures
        FROM valid GROUP BY 1) USING (station_id)
  JOIN (SELECT destination AS station_id, count(*) AS n_arrivals
        FROM valid GROUP BY 1) USING (station_id)
),
zones AS (
  SELECT zone, sum(duration) AS total_duration, count(*) AS n_trips,
         round(sum(duration) / count(*), 2) AS mean_duration
  FROM valid JOIN stations ON origin = station_id GROUP BY zone
),
arcs AS (
  SELECT origin AS src, destination AS dst, count(*) AS weight
  FROM valid GROUP BY 1, 2
),
month_arcs AS (
  SELECT origin AS src, destination AS dst, count(*) AS weight
  FROM valid WHERE month = '2000-01' GROUP BY 1, 2
)"""


def _degrees(name: str, arcs: str) -> str:
    return f"""
{name} AS (
  SELECT station_id, name, in_degree, out_degree, in_weight, out_weight,
         in_weight + out_weight AS total_weight
  FROM stations
  JOIN (SELECT src AS station_id, count(*) AS out_degree,
               CAST(sum(weight) AS BIGINT) AS out_weight
        FROM {arcs} GROUP BY 1) USING (station_id)
  JOIN (SELECT dst AS station_id, count(*) AS in_degree,
               CAST(sum(weight) AS BIGINT) AS in_weight
        FROM {arcs} GROUP BY 1) USING (station_id)
)"""


_GRAPH = ",".join(
    [_TRIPS, _degrees("degrees", "arcs"), _degrees("month_degrees", "month_arcs")]
)

_LINES = r"""
lines AS (
  SELECT k + 1 AS line_no,
    'T' || CASE WHEN k % 89 = 5 THEN k - 1 ELSE k END || ',' ||
    CASE WHEN k % 97 = 1 THEN '01/02/2000 10:00'
         WHEN k % 83 = 2 THEN '2000-2-1 3:4:5'
         ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END || ',' ||
    CASE WHEN k % 101 = 3 THEN 'S99' WHEN k % 151 = 13 THEN ' '
         ELSE 'S' || c_nationkey END || ',' ||
    'S' || (k % 25) || ',' ||
    CASE WHEN k % 103 = 4 THEN 'inconnu' WHEN k % 107 = 5 THEN 'nan'
         WHEN k % 109 = 6 THEN '0' WHEN k % 113 = 7 THEN '15d'
         WHEN k % 127 = 8 THEN '1_5'
         ELSE CAST(1 + k % 60 AS VARCHAR) END || ',' ||
    CASE WHEN k % 131 = 9 THEN 'inf' WHEN k % 137 = 10 THEN '-1'
         WHEN k % 157 = 14 THEN '1e400'
         ELSE (1 + k % 20) || '.' || (10 + k % 90) END ||
    CASE WHEN k % 149 = 12 THEN ''
         ELSE ',' || CASE WHEN k % 139 = 11 THEN 'X' ELSE o_orderstatus END
    END AS raw
  FROM (SELECT o_orderkey AS k, * FROM orders)
  JOIN customer ON o_custkey = c_custkey
),
line_stations AS (
  SELECT 'S' || n_nationkey AS station_id FROM nation
),
cells AS (
  SELECT line_no, raw, string_split(raw, ',') AS f FROM lines
),
complete AS (
  SELECT line_no, raw, f[1] AS trip_id, f[2] AS date_text, f[3] AS origin,
         f[4] AS destination, f[5] AS duration_text, f[6] AS distance_text,
         f[7] AS kind
  FROM cells WHERE len(f) = 7
),
parsed AS (
  SELECT line_no, raw, f[1] AS trip_id, f[3] AS origin, f[4] AS destination,
    f[7] AS kind, f,
    CASE WHEN regexp_full_match(f[2],
        '\d{4}-\d{1,2}-\d{1,2}\s+\d{1,2}:\d{1,2}:\d{1,2}')
      THEN try_strptime(f[2], '%Y-%m-%d %H:%M:%S') END AS ts,
    CASE WHEN regexp_full_match(f[5], '\s*[+-]?[0-9][0-9_]*\.?[0-9_]*(e[0-9]+)?\s*')
      THEN try_cast(replace(f[5], '_', '') AS DOUBLE) END AS duration,
    CASE WHEN regexp_full_match(f[6], '\s*[+-]?[0-9][0-9_]*\.?[0-9_]*(e[0-9]+)?\s*')
      THEN try_cast(replace(f[6], '_', '') AS DOUBLE) END AS distance
  FROM cells
),
checked AS (
  SELECT *, CASE
    WHEN len(f) <> 7 OR len(list_filter(f, lambda x: trim(x) = '')) > 0
      THEN 'format_invalide'
    WHEN ts IS NULL THEN 'date_invalide'
    WHEN NOT (TIMESTAMP '1996-01-01' <= ts AND ts < TIMESTAMP '2001-01-01')
      THEN 'hors_periode'
    WHEN origin NOT IN (SELECT station_id FROM line_stations)
      OR destination NOT IN (SELECT station_id FROM line_stations)
      THEN 'station_inconnue'
    WHEN duration IS NULL OR distance IS NULL
      OR NOT isfinite(duration) OR NOT isfinite(distance)
      THEN 'valeur_non_numerique'
    WHEN duration <= 0 OR distance <= 0 THEN 'valeur_non_positive'
    WHEN origin = destination THEN 'boucle'
    WHEN kind NOT IN ('F', 'O', 'P') THEN 'abonnement_inconnu'
  END AS rule
  FROM parsed
),
classified AS (
  SELECT *, CASE WHEN rule IS NULL AND row_number() OVER (
        PARTITION BY rule IS NULL, trip_id ORDER BY line_no) > 1
      THEN 'doublon_id' ELSE rule END AS reason
  FROM checked
)"""

_RULES = """(VALUES (1, 'format_invalide'), (2, 'date_invalide'),
    (3, 'hors_periode'), (4, 'station_inconnue'), (5, 'valeur_non_numerique'),
    (6, 'valeur_non_positive'), (7, 'boucle'), (8, 'abonnement_inconnu'),
    (9, 'doublon_id')) AS rules(rule_order, reason)"""

# Text that Python's float accepts, nan and inf included.
_IS_NUMBER = r"""regexp_full_match({0},
    '\s*[+-]?([0-9][0-9_]*\.?[0-9_]*(e[0-9]+)?|nan|inf|infinity)\s*')"""
_BAD = (
    f"(NOT {_IS_NUMBER} OR coalesce(try_cast(replace({{0}}, '_', '') AS DOUBLE)"
    " <= 0, false))"
)
_BAD_DURATION = _BAD.format("duration_text")
_BAD_DISTANCE = _BAD.format("distance_text")
_UNKNOWN = """(origin NOT IN (SELECT station_id FROM line_stations)
    OR destination NOT IN (SELECT station_id FROM line_stations))"""
_GOOD_DATE = r"""(regexp_full_match(date_text,
    '\d{4}-\d{1,2}-\d{1,2}\s+\d{1,2}:\d{1,2}:\d{1,2}')
    AND try_strptime(date_text, '%Y-%m-%d %H:%M:%S') IS NOT NULL)"""


def _on_trips(sql: str) -> str:
    return f"WITH {_TRIPS}\n{sql}"


def _on_graph(sql: str) -> str:
    return f"WITH {_GRAPH}\n{sql}"


def _on_lines(sql: str) -> str:
    return f"WITH {_LINES}\n{sql}"


def _sample(anomaly: str, condition: str, n: int) -> str:
    return f"""(SELECT '{anomaly}' AS anomaly, line_no, raw FROM complete
  WHERE {condition} ORDER BY line_no LIMIT {n})"""


def _difference(result: str, left: str, right: str) -> str:
    return f"""SELECT '{result}' AS result, only_left, only_right,
       only_left + only_right = 0 AS identical
FROM (SELECT
  (SELECT count(*) FROM ({left} EXCEPT ALL {right})) AS only_left,
  (SELECT count(*) FROM ({right} EXCEPT ALL {left})) AS only_right)"""


_TOP5 = """SELECT CAST(row_number() OVER w AS INTEGER) AS rank, station_id, name,
       total_weight, in_weight, out_weight
FROM {0}
WINDOW w AS (ORDER BY total_weight DESC, in_degree + out_degree DESC, station_id)
ORDER BY rank LIMIT 5"""

# Follows the common tables of the trips.
_BY_MONTH = """, month_ends AS (
  SELECT month, origin AS station_id, destination AS other, TRUE AS leaves, count(*) AS n
  FROM valid GROUP BY ALL
  UNION ALL
  SELECT month, destination, origin, FALSE, count(*) FROM valid GROUP BY ALL
), by_month AS (
  SELECT month, station_id, any_value(name) AS name,
         count(*) FILTER (NOT leaves) AS in_degree, count(*) FILTER (leaves) AS out_degree,
         CAST(sum(n) FILTER (NOT leaves) AS BIGINT) AS in_weight,
         CAST(sum(n) FILTER (leaves) AS BIGINT) AS out_weight,
         CAST(sum(n) AS BIGINT) AS total_weight
  FROM month_ends JOIN stations USING (station_id)
  GROUP BY month, station_id
  HAVING count(*) FILTER (leaves) > 0 AND count(*) FILTER (NOT leaves) > 0
)"""

_PAIRS = """SELECT CAST(row_number() OVER w AS INTEGER) AS rank, src AS origin,
       dst AS destination, weight AS n_trips
FROM arcs WINDOW w AS (ORDER BY weight DESC, src, dst) ORDER BY rank LIMIT 10"""

_RANKED = """SELECT CAST(row_number() OVER w AS INTEGER) AS rank, origin,
       destination, count(*) AS n_trips
FROM valid GROUP BY origin, destination
WINDOW w AS (ORDER BY count(*) DESC, origin, destination) QUALIFY rank <= 10"""

_STATION_TABLE = (
    "SELECT n_nationkey AS station_id, n_name AS name, n_regionkey AS zone FROM nation"
)

_SUM_COUNT = """SELECT origin, sum(duration) AS total_duration, count(*) AS n_trips
FROM valid GROUP BY origin"""

_EVENTS = """SELECT station_id, name, zone, count(*) FILTER (side = 'out') AS n_departures,
       count(*) FILTER (side = 'in') AS n_arrivals
FROM stations JOIN (
  SELECT origin AS station_id, 'out' AS side FROM valid
  UNION ALL SELECT destination, 'in' FROM valid) USING (station_id)
GROUP BY ALL HAVING n_departures > 0 AND n_arrivals > 0"""

_MEANS = """SELECT zone, sum(duration) AS total_duration, count(*) AS n_trips,
       round(avg(duration), 2) AS mean_duration
FROM valid JOIN stations ON origin = station_id GROUP BY zone"""

_FIRST_BY_MINIMUM = """SELECT trip_id, line_no FROM checked
JOIN (SELECT trip_id, min(line_no) AS line_no FROM checked
      WHERE rule IS NULL GROUP BY trip_id) USING (trip_id, line_no)
WHERE rule IS NULL"""

# How the CSV reader sees the lines: no underscore in numbers, a trailing d is
# allowed, dates need every digit, and extra or missing cells are no error.
_CSV_NUMBER = r"""CASE WHEN regexp_full_match({0},
    '[+-]?[0-9]+(\.[0-9]*)?(e[0-9]+)?[df]?')
  THEN try_cast(rtrim({0}, 'df') AS DOUBLE) END"""

_CLEAN_CSV = rf"""
, csv AS (
  SELECT line_no, f[1] AS trip_id, f[3] AS origin, f[4] AS destination, f[7] AS kind,
    CASE WHEN regexp_full_match(f[2], '\d{{4}}-\d\d-\d\d \d\d:\d\d:\d\d')
      THEN try_strptime(f[2], '%Y-%m-%d %H:%M:%S') END AS ts,
    {_CSV_NUMBER.format("f[5]")} AS duration,
    {_CSV_NUMBER.format("f[6]")} AS distance
  FROM cells
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY line_no) AS rn
  FROM csv
  WHERE {_PERIOD} AND duration > 0 AND distance > 0
    AND isfinite(duration) AND isfinite(distance)
    AND origin <> destination AND kind IN ('F', 'O', 'P')
    AND origin IN (SELECT station_id FROM line_stations)
    AND destination IN (SELECT station_id FROM line_stations)
)
SELECT trip_id, ts, origin, destination, duration, distance, kind,
       strftime(ts, '%Y-%m') AS month
FROM ranked WHERE rn = 1"""

ORACLE: dict[str, str] = {
    # Quality.
    "clean_trips": _on_trips("SELECT * FROM valid"),
    "classify_lines": _on_lines("SELECT line_no, reason FROM classified"),
    "valid_lines": _on_lines(
        """SELECT trip_id, ts, origin, destination, duration, distance, kind
FROM classified WHERE reason IS NULL"""
    ),
    "reject_summary": _on_lines(
        f"""SELECT rule_order, reason, count(line_no) AS n_lines
FROM {_RULES} LEFT JOIN classified USING (reason)
GROUP BY rule_order, reason ORDER BY rule_order"""
    ),
    "reject_detail": _on_lines(
        """SELECT reason, line_no, raw FROM classified
WHERE reason IS NOT NULL ORDER BY line_no"""
    ),
    "reconciliation": _on_lines(
        """SELECT (SELECT count(*) FROM lines) AS n_lines,
       count(*) FILTER (reason IS NULL) AS n_valid,
       count(*) FILTER (reason IS NOT NULL) AS n_rejected,
       (SELECT count(*) FROM lines) = n_valid + n_rejected AS balanced
FROM classified"""
    ),
    "first_occurrence": _on_lines(_FIRST_BY_MINIMUM),
    # Indicators.
    "mean_duration_by_zone": _on_trips("SELECT * FROM zones ORDER BY zone"),
    "flows_by_station": _on_trips("SELECT * FROM flows ORDER BY station_id"),
    "flow_totals": _on_trips(
        """SELECT CAST(sum(n_departures) AS BIGINT) AS n_departures,
       CAST(sum(n_arrivals) AS BIGINT) AS n_arrivals FROM flows"""
    ),
    "flow_extremes": _on_trips(
        """, long AS (
  SELECT station_id, 'departures' AS flow, n_departures AS n FROM flows
  UNION ALL SELECT station_id, 'arrivals', n_arrivals FROM flows
)
SELECT flow, 'min' AS bound, n, station_id FROM long
WHERE (flow, n) IN (SELECT (flow, min(n)) FROM long GROUP BY flow)
UNION ALL
SELECT flow, 'max', n, station_id FROM long
WHERE (flow, n) IN (SELECT (flow, max(n)) FROM long GROUP BY flow)"""
    ),
    "top10_pairs": _on_trips(
        """SELECT CAST(row_number() OVER w AS INTEGER) AS rank, src AS origin,
       o.name AS origin_name, dst AS destination, d.name AS destination_name,
       weight AS n_trips
FROM arcs JOIN stations o ON src = o.station_id
JOIN stations d ON dst = d.station_id
WINDOW w AS (ORDER BY weight DESC, src, dst) ORDER BY rank LIMIT 10"""
    ),
    "sum_count_combined": _on_trips(_SUM_COUNT),
    "sum_count_grouped": _on_trips(_SUM_COUNT),
    "departures_by_prefix": _on_lines(
        """SELECT origin, count(*) AS n_trips FROM classified
WHERE reason IS NULL AND origin LIKE 'S1%' GROUP BY origin"""
    ),
    # Month layer.
    "month_layer_counts": _on_trips(
        "SELECT month, count(*) AS n_trips FROM valid GROUP BY month ORDER BY month"
    ),
    "month_list": _on_trips("SELECT DISTINCT month FROM valid ORDER BY month"),
    "month_pruned_scan": _on_trips(
        """SELECT trip_id, ts, origin, destination, duration, distance, kind
FROM valid WHERE ts >= TIMESTAMP '2000-01-01' AND ts < TIMESTAMP '2000-02-01'"""
    ),
    # Profile.
    "line_count": _on_lines("SELECT count(*) AS n_lines FROM lines"),
    "profile_field_counts": _on_lines(
        """SELECT CAST(len(f) AS INTEGER) AS n_fields, count(*) AS n_lines
FROM cells GROUP BY 1"""
    ),
    "profile_kinds": _on_lines(
        "SELECT kind, count(*) AS n_lines FROM complete GROUP BY kind"
    ),
    "profile_blanks": _on_lines(
        "\nUNION ALL\n".join(
            f"""SELECT '{name}' AS "column",
  count(*) FILTER (coalesce(trim(f[{i}]), '') = '') AS n_blank FROM cells"""
            for i, name in enumerate(
                [
                    "trip_id",
                    "ts",
                    "origin",
                    "destination",
                    "duration",
                    "distance",
                    "kind",
                ],
                1,
            )
        )
    ),
    "profile_anomalies": _on_lines(
        "\nUNION ALL\n".join(
            f"""SELECT '{name}' AS anomaly, count(*) FILTER ({condition}) AS n_lines
FROM complete"""
            for name, condition in {
                "unknown_station": _UNKNOWN,
                "loop": "origin = destination",
                "bad_duration": _BAD_DURATION,
                "bad_distance": _BAD_DISTANCE,
                "bad_date": f"NOT {_GOOD_DATE}",
            }.items()
        )
    ),
    "profile_anomaly_samples": _on_lines(
        "\nUNION ALL\n".join(
            [
                _sample("unknown_station", _UNKNOWN, 5),
                _sample("bad_duration", _BAD_DURATION, 10),
                _sample("bad_distance", _BAD_DISTANCE, 10),
                _sample("bad_date", f"NOT {_GOOD_DATE}", 10),
            ]
        )
    ),
    "profile_duplicates": _on_lines(
        """SELECT f[1] AS trip_id, count(*) AS n_lines FROM cells
GROUP BY 1 HAVING count(*) > 1"""
    ),
    "profile_date_range": _on_lines(
        f"""SELECT min(date_text) AS min_date, max(date_text) AS max_date
FROM complete WHERE {_GOOD_DATE}"""
    ),
    "profile_speed_range": _on_trips(
        """SELECT min(distance * 60 / duration) AS min_speed,
       max(distance * 60 / duration) AS max_speed FROM valid"""
    ),
    "profile_tail": _on_lines(
        """SELECT * FROM (SELECT line_no, raw FROM lines
ORDER BY line_no DESC LIMIT 5) ORDER BY line_no"""
    ),
    # Graph.
    "graph_vertices": "SELECT n_nationkey AS station_id, n_name AS name FROM nation",
    "graph_arcs": _on_graph("SELECT src, dst, weight FROM arcs ORDER BY src, dst"),
    "graph_heaviest": _on_graph(
        "SELECT src, dst, weight FROM arcs ORDER BY weight DESC, src, dst LIMIT 5"
    ),
    "graph_degrees": _on_graph("SELECT * FROM degrees ORDER BY station_id"),
    "graph_degrees_sparse": _on_graph("SELECT * FROM month_degrees ORDER BY station_id"),
    "graph_summary": _on_graph(
        """SELECT (SELECT count(*) FROM stations) AS n_vertices, count(*) AS n_arcs,
       (SELECT count(*) * (count(*) - 1) FROM stations) AS max_arcs,
       CAST(sum(weight) AS BIGINT) AS total_weight FROM arcs"""
    ),
    "graph_completeness": _on_graph(
        "\nUNION ALL\n".join(
            f"""SELECT '{case}' AS trips, bool_and(
  in_degree = (SELECT count(*) - 1 FROM stations)
  AND out_degree = (SELECT count(*) - 1 FROM stations)) AS complete FROM {table}"""
            for case, table in {"all": "degrees", "month": "month_degrees"}.items()
        )
    ),
    "graph_top5": _on_graph(_TOP5.format("degrees")),
    "graph_top5_sparse": _on_graph(_TOP5.format("month_degrees")),
    "graph_degrees_by_month": _on_trips(_BY_MONTH + "\nSELECT * FROM by_month"),
    "graph_top5_by_month": _on_trips(
        _BY_MONTH
        + """
SELECT month, CAST(row_number() OVER w AS INTEGER) AS rank, station_id, name,
       total_weight, in_weight, out_weight
FROM by_month
WINDOW w AS (PARTITION BY month
             ORDER BY total_weight DESC, in_degree + out_degree DESC, station_id)
QUALIFY rank <= 5"""
    ),
    # Comparison of variants.
    "compare_results": _on_trips(
        "\nUNION ALL\n".join(
            [
                _difference("flows", f"({_EVENTS})", "SELECT * FROM flows"),
                _difference("zones", "SELECT * FROM zones", f"({_MEANS})"),
                _difference("pairs", f"({_PAIRS})", f"({_RANKED})"),
            ]
        )
    ),
    "compare_first_occurrence": _on_lines(
        _difference(
            "first_occurrence",
            "SELECT trip_id, line_no FROM classified WHERE reason IS NULL",
            f"({_FIRST_BY_MINIMUM})",
        )
    ),
    "cache_invariance": _on_trips(
        "\nUNION ALL\n".join(
            [
                _difference(
                    "departures",
                    "SELECT origin, count(*) FROM valid GROUP BY 1",
                    "SELECT src, CAST(sum(weight) AS BIGINT) FROM arcs GROUP BY 1",
                ),
                _difference(
                    "pair_counts",
                    "SELECT origin, destination, count(*) FROM valid GROUP BY 1, 2",
                    "SELECT src, dst, weight FROM arcs",
                ),
            ]
        )
    ),
    "partition_invariance": _on_trips(
        """SELECT CAST(n AS INTEGER) AS shuffle_partitions, zones.*
FROM (VALUES (8), (200)) AS variants(n), zones"""
    ),
    # Files.
    "lines_numbered": _on_lines("SELECT line_no, raw FROM lines"),
    "lines_without_prefix": _on_lines("SELECT raw FROM lines"),
    "classify_text": _on_lines("SELECT line_no, reason FROM classified"),
    "clean_csv": _on_lines(_CLEAN_CSV),
    "stations_typed_csv": _STATION_TABLE,
    "stations_inferred_csv": _STATION_TABLE,
    "trips_typed_csv": _on_trips(
        """SELECT trip_id, ts, CAST(origin AS VARCHAR) AS origin,
       CAST(destination AS VARCHAR) AS destination, duration, distance, kind
FROM trips"""
    ),
    "station_ids": _on_lines("SELECT DISTINCT station_id FROM line_stations"),
}
