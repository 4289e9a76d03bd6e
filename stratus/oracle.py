"""Independent DuckDB SQL for every registered query (the correctness oracle).

The SQL is written the way the warehouse queries are written: against a
``fact`` / ``dim`` pair. The two CTE preambles project those from the
benchmark tables exactly as ``stratus.sources.drivertables`` does.
"""

from __future__ import annotations

from stratus.oracle_sheets import SHEET_LINES, SHEETS_SQL

_UNIT = (
    "CASE metric WHEN 'wind_speed' THEN 'm/s' WHEN 'wind_direction' THEN 'degrees' "
    "WHEN 'no2' THEN 'ug/m3(S)' WHEN 'o3' THEN 'ug/m3(S)' WHEN 'pm10' THEN 'ug/m3(S)' "
    "WHEN 'pm25' THEN 'ug/m3(S)' WHEN 'so2' THEN 'ug/m3(S)' END"
)

_FINISH = f"""
fact AS (
  SELECT timestamp, station_fk, metric, value,
         {_UNIT} AS unit,
         CASE WHEN metric IN ('wind_speed', 'wind_direction') THEN 'wind' ELSE 'air_quality' END AS source,
         CASE WHEN value IS NULL THEN 'NODATA' ELSE 'VALID' END AS quality_flag
  FROM base
)"""

LINEITEM = f"""
WITH base AS (
  SELECT CAST(l_shipdate AS TIMESTAMP) AS timestamp,
         CAST(l_suppkey AS INTEGER) AS station_fk,
         CASE l_returnflag WHEN 'A' THEN 'wind_speed' WHEN 'N' THEN 'no2' WHEN 'R' THEN 'pm10' END AS metric,
         CASE WHEN l_linenumber = 1 THEN NULL ELSE CAST(l_quantity AS DOUBLE) END AS value
  FROM lineitem
),
{_FINISH},
dim AS (
  SELECT CAST(s_suppkey AS INTEGER) AS station_pk,
         'ST' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS station_code,
         s_name AS station_name,
         'AQM' AS location_type,
         'Monitoring site of ' || s_name AS description
  FROM supplier WHERE s_acctbal >= 0
)
"""

#: The same with all suppliers as the dimension.
LINEITEM_ALL = LINEITEM.replace(" WHERE s_acctbal >= 0", "")

SPARSE = LINEITEM.replace(
    "CASE WHEN l_linenumber = 1 THEN NULL ELSE CAST(l_quantity AS DOUBLE) END AS value",
    "CASE WHEN l_linenumber = 1 OR (l_returnflag = 'A' AND l_linenumber <= 5) THEN NULL WHEN l_returnflag = 'A' "
    "THEN CAST(l_quantity AS DOUBLE) ELSE CAST(l_quantity AS DOUBLE) * 30 END AS value",
)

EVENTS = f"""
WITH base AS (
  SELECT CAST(ts AS TIMESTAMP) AS timestamp,
         CAST(user_id AS INTEGER) AS station_fk,
         CASE event_type WHEN 'view' THEN 'wind_speed' WHEN 'error' THEN 'wind_direction'
              WHEN 'click' THEN 'no2' WHEN 'signup' THEN 'o3' WHEN 'purchase' THEN 'pm10' END AS metric,
         CASE WHEN value < 5.0 THEN NULL ELSE CAST(value AS DOUBLE) * CAST(1.0936133 AS DOUBLE) END AS value
  FROM events
),
{_FINISH},
dim AS (
  SELECT CAST(c_custkey AS INTEGER) AS station_pk,
         'CU' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS station_code,
         c_name AS station_name,
         'AQM' AS location_type,
         'Monitoring site of ' || c_name AS description
  FROM customer WHERE c_acctbal >= 0
)
"""

_RANGES = """
ranges AS (
  SELECT * FROM (VALUES
    ('wind_speed', CAST(0 AS DOUBLE), CAST(50 AS DOUBLE)),
    ('wind_direction', CAST(0 AS DOUBLE), CAST(360 AS DOUBLE)),
    ('no2', CAST(0 AS DOUBLE), CAST(1000 AS DOUBLE)),
    ('o3', CAST(0 AS DOUBLE), CAST(500 AS DOUBLE)),
    ('pm10', CAST(0 AS DOUBLE), CAST(2000 AS DOUBLE)),
    ('pm25', CAST(0 AS DOUBLE), CAST(1000 AS DOUBLE)),
    ('so2', CAST(0 AS DOUBLE), CAST(1000 AS DOUBLE))
  ) AS r(metric, lo, hi)
)"""


def _mean(x: str) -> str:
    return f"AVG({x})"


def _pct(num: str, den: str, digits: int = 2) -> str:
    return f"CASE WHEN {den} = 0 THEN 0 ELSE ROUND(CAST({num} AS DOUBLE) * 100.0 / CAST({den} AS DOUBLE), {digits}) END"


_NULL_PCT = _pct("COUNT(*) FILTER (WHERE value IS NULL)", "COUNT(*)")

A10 = f""", {_RANGES.strip()}
SELECT f.metric, COUNT(*) AS total, COUNT(f.value) AS non_null,
       MIN(f.value) AS "min", MAX(f.value) AS "max", ROUND({_mean("f.value")}, 2) AS "avg",
       PERCENTILE_CONT(0.5) WITHIN GROUP (ORDER BY f.value) AS median,
       COUNT(*) FILTER (WHERE f.value < r.lo) AS below_min,
       COUNT(*) FILTER (WHERE f.value > r.hi) AS above_max,
       r.lo AS expected_min, r.hi AS expected_max
FROM fact f JOIN ranges r ON f.metric = r.metric
GROUP BY f.metric, r.lo, r.hi
"""

A14 = f""", {_RANGES.strip()},
per_metric AS (
  SELECT f.metric, COUNT(*) AS total,
         COUNT(*) FILTER (WHERE f.value IS NULL) AS nulls,
         COUNT(*) FILTER (WHERE f.quality_flag = 'NODATA') AS nodata,
         COUNT(*) FILTER (WHERE f.value < r.lo) AS below,
         COUNT(*) FILTER (WHERE f.value > r.hi) AS above,
         MAX(CASE WHEN r.metric IS NULL THEN 0 ELSE 1 END) AS checked
  FROM fact f LEFT JOIN ranges r ON f.metric = r.metric
  GROUP BY f.metric
),
overall AS (SELECT {_NULL_PCT} AS null_pct FROM fact),
by_metric AS (
  SELECT metric, checked, below, above, {_pct("nulls", "total")} AS null_pct,
         CASE WHEN total = 0 THEN 0 ELSE CAST(nodata AS DOUBLE) * 100.0 / CAST(total AS DOUBLE) END AS nodata_raw
  FROM per_metric
)
SELECT 1 AS issue_no, 'High overall null rate: ' || CAST(null_pct AS VARCHAR) || '%' AS issue
FROM overall WHERE null_pct > 30
UNION ALL
SELECT 2, 'High null metrics: ' || string_agg(metric, ', ' ORDER BY null_pct DESC, metric)
FROM by_metric WHERE null_pct > 50 HAVING COUNT(*) > 0
UNION ALL
SELECT 3, 'Outlier values detected outside expected ranges'
FROM by_metric WHERE checked = 1 AND (below > 0 OR above > 0) HAVING COUNT(*) > 0
UNION ALL
SELECT 4, 'Low quality metrics detected: ' || CAST(COUNT(*) AS VARCHAR)
FROM by_metric WHERE nodata_raw > 50 HAVING COUNT(*) > 0
"""


def _box(metrics: list[str], lo: float, hi: float) -> str:
    mlist = ", ".join(f"'{m}'" for m in metrics)
    return f""",
pts AS (
  SELECT f.metric, s.station_name, f.value AS v
  FROM fact f JOIN dim s ON f.station_fk = s.station_pk
  WHERE f.quality_flag = 'VALID' AND f.value IS NOT NULL AND f.metric IN ({mlist})
    AND f.value BETWEEN {lo} AND {hi}
),
q AS (
  SELECT metric, station_name, COUNT(*) AS n, MIN(v) AS "min",
         quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3,
         MAX(v) AS "max"
  FROM pts GROUP BY metric, station_name
),
q2 AS (
  SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM q
),
w AS (
  SELECT p.metric, p.station_name,
         MIN(p.v) FILTER (WHERE p.v >= q2.lower_fence AND p.v <= q2.upper_fence) AS lower_whisker,
         MAX(p.v) FILTER (WHERE p.v >= q2.lower_fence AND p.v <= q2.upper_fence) AS upper_whisker,
         COUNT(*) FILTER (WHERE NOT (p.v >= q2.lower_fence AND p.v <= q2.upper_fence)) AS outliers
  FROM pts p JOIN q2 ON p.metric = q2.metric AND p.station_name = q2.station_name
  GROUP BY p.metric, p.station_name
)
SELECT q2.* REPLACE (ROUND(q1, 6) AS q1, ROUND(median, 6) AS median, ROUND(q3, 6) AS q3, ROUND(iqr, 6) AS iqr,
    ROUND(lower_fence, 6) AS lower_fence, ROUND(upper_fence, 6) AS upper_fence), w.lower_whisker, w.upper_whisker, w.outliers
FROM q2 JOIN w ON q2.metric = w.metric AND q2.station_name = w.station_name
"""


def _corr(grain: str) -> str:
    return f""",
pairs AS (
  SELECT s.station_name, DATE_TRUNC('{grain}', f.timestamp) AS date,
         {_mean("CASE WHEN f.metric = 'wind_speed' THEN f.value END")} AS avg_wind_speed,
         {_mean("CASE WHEN f.metric = 'no2' THEN f.value END")} AS avg_no2
  FROM fact f JOIN dim s ON f.station_fk = s.station_pk
  WHERE f.quality_flag = 'VALID' AND f.value IS NOT NULL AND f.metric IN ('wind_speed', 'no2')
  GROUP BY s.station_name, DATE_TRUNC('{grain}', f.timestamp)
)
SELECT station_name, COUNT(*) AS periods, ROUND(CORR(avg_wind_speed, avg_no2), 6) AS correlation
FROM pairs WHERE avg_wind_speed IS NOT NULL AND avg_no2 IS NOT NULL
GROUP BY station_name HAVING COUNT(*) > 10
"""


_ORPHANS = "FROM fact f WHERE NOT EXISTS (SELECT 1 FROM dim s WHERE s.station_pk = f.station_fk)"

_BODIES: dict[str, tuple[str, str]] = {
    "a0_total": (LINEITEM, "SELECT COUNT(*) AS total_rows FROM fact"),
    "a1_counts_by_source": (LINEITEM, "SELECT source, COUNT(*) AS count FROM fact GROUP BY source"),
    "a2_counts_by_metric": (
        LINEITEM,
        "SELECT metric, COUNT(*) AS count, MIN(timestamp) AS earliest, MAX(timestamp) AS latest "
        "FROM fact GROUP BY metric",
    ),
    "a3_counts_by_station": (
        LINEITEM,
        "SELECT s.station_name, COUNT(*) AS count, "
        "CAST(COUNT(*) AS DOUBLE) * 100.0 / CAST((SELECT COUNT(*) FROM fact) AS DOUBLE) AS share_pct "
        "FROM fact f JOIN dim s ON f.station_fk = s.station_pk GROUP BY s.station_name",
    ),
    "a4_duplicate_keys": (
        LINEITEM,
        "SELECT COUNT(*) AS dup_count FROM (SELECT timestamp, station_fk, metric, source, COUNT(*) AS cnt "
        "FROM fact GROUP BY timestamp, station_fk, metric, source HAVING COUNT(*) > 1)",
    ),
    "a5_required_nulls": (
        LINEITEM,
        "SELECT COUNT(*) FILTER (WHERE timestamp IS NULL) AS null_timestamps, "
        "COUNT(*) FILTER (WHERE station_fk IS NULL) AS null_stations, "
        "COUNT(*) FILTER (WHERE metric IS NULL) AS null_metrics, "
        "COUNT(*) FILTER (WHERE source IS NULL) AS null_sources FROM fact",
    ),
    "a6_value_stats": (
        LINEITEM,
        "SELECT COUNT(*) FILTER (WHERE value IS NULL) AS null_values, "
        "COUNT(*) FILTER (WHERE value IS NOT NULL) AS valid_values, "
        "COUNT(*) FILTER (WHERE quality_flag = 'NODATA') AS nodata_flags, "
        "COUNT(*) FILTER (WHERE quality_flag = 'VALID') AS valid_flags FROM fact",
    ),
    "a7_integrity": (
        LINEITEM,
        f""", o AS (SELECT COUNT(*) AS orphan_measurements {_ORPHANS}),
d AS (SELECT COUNT(*) AS duplicate_keys FROM (SELECT timestamp, station_fk, metric, source FROM fact
      GROUP BY timestamp, station_fk, metric, source HAVING COUNT(*) > 1)),
n AS (SELECT COUNT(*) FILTER (WHERE timestamp IS NULL) AS null_timestamps,
             COUNT(*) FILTER (WHERE station_fk IS NULL) AS null_stations,
             COUNT(*) FILTER (WHERE metric IS NULL) AS null_metrics,
             COUNT(*) FILTER (WHERE source IS NULL) AS null_sources FROM fact)
SELECT o.orphan_measurements, d.duplicate_keys, n.null_timestamps, n.null_stations, n.null_metrics,
       n.null_sources,
       (o.orphan_measurements = 0 AND d.duplicate_keys = 0 AND n.null_timestamps = 0 AND n.null_stations = 0
        AND n.null_metrics = 0 AND n.null_sources = 0) AS integrity_ok
FROM o, d, n""",
    ),
    "a8_null_rate_overall": (
        LINEITEM,
        f"SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE value IS NULL) AS nulls, {_NULL_PCT} AS null_pct FROM fact",
    ),
    "a8_null_rate_by_metric": (
        LINEITEM,
        f"SELECT metric, COUNT(*) AS total, COUNT(*) FILTER (WHERE value IS NULL) AS nulls, {_NULL_PCT} AS null_pct "
        "FROM fact GROUP BY metric",
    ),
    "a8_null_rate_by_station": (
        LINEITEM,
        "SELECT s.station_name, COUNT(*) AS total, COUNT(*) FILTER (WHERE f.value IS NULL) AS nulls, "
        + _pct("COUNT(*) FILTER (WHERE f.value IS NULL)", "COUNT(*)")
        + " AS null_pct FROM fact f JOIN dim s ON f.station_fk = s.station_pk GROUP BY s.station_name",
    ),
    "a9_high_null_metrics": (
        LINEITEM,
        f"SELECT * FROM (SELECT metric, COUNT(*) AS total, COUNT(*) FILTER (WHERE value IS NULL) AS nulls, "
        f"{_NULL_PCT} AS null_pct FROM fact GROUP BY metric) WHERE null_pct > 50.0",
    ),
    "a10_value_ranges": (LINEITEM, A10),
    "a10_value_ranges_events": (EVENTS, A10),
    "a11_coverage_overall": (
        EVENTS,
        "SELECT MIN(timestamp) AS earliest, MAX(timestamp) AS latest, "
        "COUNT(DISTINCT DATE_TRUNC('day', timestamp)) AS days_covered, "
        "COUNT(DISTINCT DATE_TRUNC('hour', timestamp)) AS hours_covered FROM fact",
    ),
    "a11_coverage_by_source": (
        EVENTS,
        "SELECT source, MIN(timestamp) AS earliest, MAX(timestamp) AS latest, "
        "COUNT(DISTINCT DATE_TRUNC('day', timestamp)) AS days FROM fact GROUP BY source",
    ),
    "a11_coverage_by_metric": (
        LINEITEM,
        "SELECT metric, MIN(timestamp) AS earliest, MAX(timestamp) AS latest, "
        "COUNT(DISTINCT DATE_TRUNC('day', timestamp)) AS days FROM fact GROUP BY metric",
    ),
    "a11_coverage_levels": (
        EVENTS,
        "SELECT level, key, MIN(timestamp) AS earliest, MAX(timestamp) AS latest, "
        "COUNT(DISTINCT DATE_TRUNC('day', timestamp)) AS days, COUNT(DISTINCT DATE_TRUNC('hour', timestamp)) AS hours "
        "FROM (SELECT 'overall' AS level, NULL AS key, timestamp FROM fact UNION ALL SELECT 'source', source, timestamp FROM fact "
        "UNION ALL SELECT 'metric', metric, timestamp FROM fact) GROUP BY level, key",
    ),
    "a12_low_quality_metrics": (
        LINEITEM,
        "SELECT metric, COUNT(*) FILTER (WHERE quality_flag = 'NODATA') AS nodata, COUNT(*) AS total, "
        + _pct("COUNT(*) FILTER (WHERE quality_flag = 'NODATA')", "COUNT(*)")
        + " AS nodata_pct FROM fact GROUP BY metric HAVING CASE WHEN COUNT(*) = 0 THEN 0 ELSE "
        "CAST(COUNT(*) FILTER (WHERE quality_flag = 'NODATA') AS DOUBLE) * 100.0 / CAST(COUNT(*) AS DOUBLE) END > 50",
    ),
    "a13_dq_summary": (
        LINEITEM_ALL,
        "SELECT COUNT(*) AS total_measurements, (SELECT COUNT(*) FROM dim) AS total_stations, "
        "COUNT(*) FILTER (WHERE value IS NULL) AS null_values, "
        f"COUNT(*) FILTER (WHERE value IS NOT NULL) AS valid_values, {_NULL_PCT} AS null_percentage FROM fact",
    ),
    "a14_dq_issues": (LINEITEM, A14),
    "a14_dq_issues_events": (EVENTS, A14),
    "a15_top_stations": (
        LINEITEM,
        "SELECT s.station_name, COUNT(*) AS measurement_count FROM fact f JOIN dim s ON f.station_fk = s.station_pk "
        "GROUP BY s.station_name ORDER BY measurement_count DESC, s.station_name LIMIT 5",
    ),
    "a16_table_counts": (
        LINEITEM_ALL,
        "SELECT 'fact_measurement' AS table_name, COUNT(*) AS row_count FROM fact "
        "UNION ALL SELECT 'dim_station' AS table_name, COUNT(*) AS row_count FROM dim",
    ),
    "a17_daily_counts": (
        EVENTS,
        "SELECT DATE_TRUNC('day', timestamp) AS date, COUNT(*) AS measurements FROM fact "
        "WHERE timestamp >= CAST((SELECT CAST(MAX(timestamp) AS DATE) FROM fact) - INTERVAL 7 DAY AS TIMESTAMP) "
        "GROUP BY DATE_TRUNC('day', timestamp)",
    ),
    "a17_freshness": (LINEITEM, "SELECT MAX(timestamp) AS latest_data FROM fact"),
    "j4_station_coverage": (
        LINEITEM,
        "SELECT s.station_name, COUNT(f.station_fk) AS measurements, MAX(f.timestamp) AS latest "
        "FROM dim s LEFT JOIN fact f ON s.station_pk = f.station_fk GROUP BY s.station_name",
    ),
    "j5_orphan_count": (LINEITEM, f"SELECT COUNT(*) AS orphan_count {_ORPHANS}"),
    "j5_orphans": (LINEITEM, f"SELECT f.* {_ORPHANS}"),
    "w1_share_of_total": (
        LINEITEM,
        "SELECT quality_flag, COUNT(*) AS count, ROUND(CAST(COUNT(*) AS DOUBLE) * 100.0 / "
        "CAST(SUM(COUNT(*)) OVER () AS DOUBLE), 2) AS percentage FROM fact GROUP BY quality_flag",
    ),
    "w2_share_within": (
        LINEITEM,
        "SELECT source, quality_flag, COUNT(*) AS count, ROUND(CAST(COUNT(*) AS DOUBLE) * 100.0 / "
        "CAST(SUM(COUNT(*)) OVER (PARTITION BY source) AS DOUBLE), 2) AS percentage "
        "FROM fact GROUP BY source, quality_flag",
    ),
    "v2_wind": (
        EVENTS,
        "SELECT s.station_code, s.station_name, m.timestamp, "
        "MAX(CASE WHEN m.metric = 'wind_direction' THEN m.value END) AS wind_direction_deg, "
        "MAX(CASE WHEN m.metric = 'wind_speed' THEN m.value END) AS wind_speed_ms "
        "FROM fact m JOIN dim s ON m.station_fk = s.station_pk WHERE m.source = 'wind' "
        "GROUP BY s.station_code, s.station_name, m.timestamp",
    ),
    "v3_quality": (
        LINEITEM,
        "SELECT s.station_name, m.metric, COUNT(*) AS total_records, "
        "COUNT(CASE WHEN m.quality_flag = 'VALID' THEN 1 END) AS valid_records, "
        "COUNT(CASE WHEN m.value IS NULL THEN 1 END) AS null_values, "
        "MIN(m.timestamp) AS earliest_record, MAX(m.timestamp) AS latest_record "
        "FROM fact m JOIN dim s ON m.station_fk = s.station_pk GROUP BY s.station_name, m.metric",
    ),
    "v4_station_directory": (LINEITEM_ALL, "SELECT station_pk, station_code, station_name, location_type FROM dim"),
    "b1_metric_coverage": (
        LINEITEM,
        "SELECT source, metric, COUNT(*) AS total_measurements, COUNT(DISTINCT station_fk) AS stations, "
        "MIN(timestamp) AS earliest_date, MAX(timestamp) AS latest_date, "
        "COUNT(DISTINCT DATE_TRUNC('day', timestamp)) AS days_covered, "
        "COUNT(CASE WHEN quality_flag = 'VALID' THEN 1 END) AS valid_measurements, "
        "ROUND(CAST(COUNT(CASE WHEN quality_flag = 'VALID' THEN 1 END) AS DOUBLE) * 100.0 / "
        "CAST(COUNT(*) AS DOUBLE), 1) AS valid_pct FROM fact GROUP BY source, metric",
    ),
    "b2_coverage_pivot": (
        LINEITEM,
        "SELECT metric, COUNT(*) FILTER (WHERE source = 'air_quality') AS air_quality, "
        "COUNT(*) FILTER (WHERE source = 'wind') AS wind FROM fact GROUP BY metric",
    ),
    "b2_source_quality": (
        LINEITEM,
        "SELECT source, COUNT(*) AS total_measurements, "
        "COUNT(*) FILTER (WHERE quality_flag = 'VALID') AS valid_measurements, "
        "COUNT(*) - COUNT(*) FILTER (WHERE quality_flag = 'VALID') AS invalid_measurements "
        "FROM fact GROUP BY source",
    ),
    "b3_monthly_trends": (
        LINEITEM,
        "SELECT DATE_TRUNC('month', timestamp) AS month, source, COUNT(*) AS measurements FROM fact "
        "WHERE quality_flag = 'VALID' GROUP BY DATE_TRUNC('month', timestamp), source",
    ),
    "b3_monthly_pivot": (
        LINEITEM,
        "SELECT DATE_TRUNC('month', timestamp) AS month, COUNT(*) FILTER (WHERE source = 'air_quality') AS air_quality, "
        "COUNT(*) FILTER (WHERE source = 'wind') AS wind FROM fact WHERE quality_flag = 'VALID' "
        "GROUP BY DATE_TRUNC('month', timestamp)",
    ),
    "b4_pollutant_stats": (
        LINEITEM,
        "SELECT s.station_name, m.metric, m.unit, COUNT(*) AS measurements, ROUND(AVG(m.value), 2) AS avg_value, "
        "ROUND(MIN(m.value), 2) AS min_value, ROUND(MAX(m.value), 2) AS max_value, "
        "ROUND(STDDEV(m.value), 2) AS std_value FROM fact m JOIN dim s ON m.station_fk = s.station_pk "
        "WHERE m.source = 'air_quality' AND m.quality_flag = 'VALID' AND m.value IS NOT NULL "
        "GROUP BY s.station_name, m.metric, m.unit",
    ),
    "b5_box_air": (EVENTS, _box(["no2", "o3", "pm10", "pm25", "so2"], 0, 500)),
    "b5_box_wind": (EVENTS, _box(["wind_speed"], 0, 30)),
    "b6_wind_stats": (
        EVENTS,
        "SELECT s.station_name, COUNT(*) AS measurements, "
        f"ROUND({_mean("CASE WHEN m.metric = 'wind_speed' THEN m.value END")}, 2) AS avg_wind_speed, "
        "ROUND(MAX(CASE WHEN m.metric = 'wind_speed' THEN m.value END), 2) AS max_wind_speed, "
        f"ROUND({_mean("CASE WHEN m.metric = 'wind_direction' THEN m.value END")}, 1) AS avg_wind_direction "
        "FROM fact m JOIN dim s ON m.station_fk = s.station_pk "
        "WHERE m.source = 'wind' AND m.quality_flag = 'VALID' AND m.value IS NOT NULL GROUP BY s.station_name",
    ),
    "b7_shared_stations": (
        LINEITEM,
        "SELECT s.station_name, COUNT(DISTINCT m.source) AS data_sources, "
        "COUNT(CASE WHEN m.source = 'wind' THEN 1 END) AS wind_measurements, "
        "COUNT(CASE WHEN m.source = 'air_quality' THEN 1 END) AS air_quality_measurements "
        "FROM fact m JOIN dim s ON m.station_fk = s.station_pk GROUP BY s.station_name "
        "HAVING COUNT(DISTINCT m.source) > 1",
    ),
    "b8_monthly_correlation": (LINEITEM, _corr("month")),
    "b8_daily_correlation_events": (EVENTS, _corr("day")),
    "b9_quality_assessment": (
        LINEITEM,
        "SELECT source, metric, COUNT(*) AS total_records, "
        "COUNT(CASE WHEN quality_flag = 'VALID' THEN 1 END) AS valid_records, "
        "COUNT(CASE WHEN quality_flag = 'NODATA' THEN 1 END) AS nodata_records, "
        "COUNT(CASE WHEN value IS NULL THEN 1 END) AS null_values, "
        "ROUND(CAST(COUNT(CASE WHEN quality_flag = 'VALID' THEN 1 END) AS DOUBLE) * 100.0 / "
        "CAST(COUNT(*) AS DOUBLE), 1) AS valid_percentage FROM fact GROUP BY source, metric",
    ),
    "b9_overall_quality": (
        LINEITEM,
        "SELECT COUNT(*) AS total_records, COUNT(*) FILTER (WHERE quality_flag = 'VALID') AS valid_records, "
        "(CAST(COUNT(*) FILTER (WHERE quality_flag = 'VALID') AS DOUBLE) / CAST(COUNT(*) AS DOUBLE)) * 100 "
        "AS overall_quality FROM fact",
    ),
    "b10_high_pollution_days": (
        EVENTS,
        f"SELECT DATE_TRUNC('day', m.timestamp) AS date, s.station_name, m.metric, ROUND({_mean('m.value')}, 2) AS avg_value, "
        "m.unit FROM fact m JOIN dim s ON m.station_fk = s.station_pk "
        "WHERE m.source = 'air_quality' AND m.quality_flag = 'VALID' AND m.value IS NOT NULL "
        "AND m.metric IN ('no2', 'pm10') "
        f"GROUP BY DATE_TRUNC('day', m.timestamp), s.station_name, m.metric, m.unit HAVING {_mean('m.value')} > 50 "
        "ORDER BY avg_value DESC, date, s.station_name, m.metric, m.unit LIMIT 20",
    ),
    "b11_monthly_means": (
        LINEITEM,
        "SELECT DATE_TRUNC('month', f.timestamp) AS month, f.metric, AVG(f.value) AS avg_value "
        "FROM fact f JOIN dim s ON f.station_fk = s.station_pk WHERE f.quality_flag = 'VALID' "
        "GROUP BY DATE_TRUNC('month', f.timestamp), f.metric",
    ),
    "b12_station_performance": (
        LINEITEM,
        "SELECT s.station_name, COUNT(*) AS total_measurements, "
        "COUNT(CASE WHEN f.quality_flag = 'VALID' THEN 1 END) AS valid "
        "FROM fact f JOIN dim s ON f.station_fk = s.station_pk GROUP BY s.station_name",
    ),
    "j8_latest": (
        LINEITEM,
        "SELECT s.station_name, m.metric, m.value, m.unit, m.timestamp "
        "FROM fact m JOIN dim s ON m.station_fk = s.station_pk "
        "WHERE m.timestamp = (SELECT MAX(m2.timestamp) FROM fact m2 "
        "WHERE m2.station_fk = m.station_fk AND m2.metric = m.metric)",
    ),
}


def _join(preamble: str, body: str) -> str:
    body = body.strip()
    if body.startswith(","):
        return preamble.rstrip() + body + "\n"
    return preamble + body + "\n"


ORACLE_SQL: dict[str, str] = {k: _join(p, b) for k, (p, b) in _BODIES.items()}


# --------------------------------------------------------------------------
# Staged / normalised layers derived from events, load and profiling
# --------------------------------------------------------------------------

_EVENT_METRICS = ["wind_speed", "wind_direction", "no2", "o3", "pm10"]
_NATIONS = range(25)  # TPC-H nation keys 0..24
_WIDE_COLS = [f"station_{k}_{m}" for k in _NATIONS for m in _EVENT_METRICS]
_UNIT_M = _UNIT.replace("CASE metric", "CASE m.metric")

_WIDE = ",\n".join(
    f"  MAX(CASE WHEN nation = {k} AND metric = '{m}' THEN value END) AS station_{k}_{m}"
    for k in _NATIONS
    for m in _EVENT_METRICS
)

STAGED = EVENTS.rstrip() + f""",
hl AS (
  SELECT date_trunc('hour', f.timestamp) AS datetime, CAST(c.c_nationkey AS BIGINT) AS nation, f.metric, f.value
  FROM fact f JOIN customer c ON CAST(c.c_custkey AS INTEGER) = f.station_fk
),
agg AS (SELECT datetime, nation, metric, MAX(value) AS value FROM hl GROUP BY datetime, nation, metric),
hours AS (SELECT DISTINCT datetime FROM hl),
cols AS (
  SELECT CAST(n_nationkey AS BIGINT) AS station_pk, m.metric
  FROM nation CROSS JOIN (VALUES ('wind_speed'), ('wind_direction'), ('no2'), ('o3'), ('pm10')) AS m(metric)
),
melted AS (
  SELECT h.datetime, c.station_pk, c.metric, a.value
  FROM hours h CROSS JOIN cols c
  LEFT JOIN agg a ON a.datetime = h.datetime AND a.nation = c.station_pk AND a.metric = c.metric
),
stations AS (
  SELECT CAST(n_nationkey AS BIGINT) AS station_pk, 'NA' || lpad(CAST(n_nationkey AS VARCHAR), 6, '0') AS station_code,
         n_name AS station_name, 'AQM' AS location_type
  FROM nation
),
tall AS (
  SELECT m.datetime, m.station_pk, s.station_code, s.station_name, s.location_type, m.metric,
         {_UNIT_M} AS unit, m.value,
         CASE WHEN m.value IS NULL THEN 'NODATA' ELSE 'VALID' END AS quality_flag,
         CASE WHEN m.metric IN ('wind_speed', 'wind_direction') THEN 'wind' ELSE 'air_quality' END AS source,
         'staged_week_' || lpad(CAST(weekofyear(m.datetime) AS VARCHAR), 2, '0') || '_normalised.parquet' AS file
  FROM melted m LEFT JOIN stations s ON m.station_pk = s.station_pk
),
wide AS (
  SELECT datetime,
{_WIDE}
  FROM hl GROUP BY datetime
),
wf AS (
  SELECT *, 'staged_week_' || lpad(CAST(weekofyear(datetime) AS VARCHAR), 2, '0') || '.parquet' AS file FROM wide
)
"""


def _half_even(expr: str, digits: int) -> str:
    scale = float(10**digits)
    return f"(round_even(({expr}) * {scale}, 0) / {scale})"


def _pct_even(num: str, den: str, digits: int = 2) -> str:
    return (
        f"CASE WHEN {den} = 0 THEN 0.0 ELSE "
        + _half_even(f"CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) * 100.0", digits)
        + " END"
    )


_ALL_WIDE = ["datetime"] + _WIDE_COLS
_ANY_NULL = " OR ".join(f"{c} IS NULL" for c in _ALL_WIDE)

E1 = f""",
per_row AS (
  SELECT file, COUNT(*) AS n, MAX(CASE WHEN {_ANY_NULL} THEN 1 ELSE 0 END) AS has_null
  FROM wf GROUP BY file, {", ".join(_ALL_WIDE)}
)
SELECT file, CAST(SUM(n) AS BIGINT) AS rows, {len(_ALL_WIDE)} AS columns,
       CAST(SUM(n - 1) AS BIGINT) AS duplicate_rows,
       CAST(SUM(CASE WHEN has_null = 1 THEN n ELSE 0 END) AS BIGINT) AS rows_with_nulls,
       {_pct_even("SUM(CASE WHEN has_null = 1 THEN n ELSE 0 END)", "SUM(n)")} AS pct_rows_with_nulls
FROM per_row GROUP BY file
"""

E5 = ",\nmiss AS (\n" + "\nUNION ALL\n".join(
    f"  SELECT '{c}' AS \"column\", AVG(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS m FROM wide" for c in _ALL_WIDE
) + f"\n)\nSELECT \"column\", COALESCE({_half_even('CAST(m AS DOUBLE) * 100.0', 2)}, 0.0) AS pct_missing FROM miss\n"

_LI_NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
               "l_discount", "l_tax"]
E6 = "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column, CAST(COUNT({c}) AS DOUBLE) AS count,
  ROUND({_mean(f"CAST({c} AS DOUBLE)")}, 6) AS mean, ROUND(STDDEV_SAMP(CAST({c} AS DOUBLE)), 6) AS std,
  ROUND(MIN(CAST({c} AS DOUBLE)), 6) AS "min",
  ROUND(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS p25,
  ROUND(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS p50,
  ROUND(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS p75,
  ROUND(MAX(CAST({c} AS DOUBLE)), 6) AS "max"
FROM lineitem"""
    for c in _LI_NUMERIC
)

_TEXT = f"""
WITH t AS (
  SELECT 'events_' || event_type || '.xlsx' AS file, CAST(user_id AS BIGINT) AS station_pk,
         CASE event_type WHEN 'view' THEN 'wind_speed' WHEN 'error' THEN 'wind_direction'
              WHEN 'click' THEN 'no2' WHEN 'signup' THEN 'o3' WHEN 'purchase' THEN 'pm10' END AS metric,
         strftime(ts, '%-d/%-m/%Y %-H:%M') AS datetime_text,
         CASE WHEN value < 5.0 THEN '<Samp' ELSE CAST(value AS VARCHAR) END AS value_text
  FROM events
),
c AS (
  SELECT file, station_pk, metric, try_strptime(datetime_text, '%d/%m/%Y %H:%M') AS datetime,
         CASE WHEN value_text IN ('NoData', 'InVld', '<Samp', 'Down', 'RS232', 'Zero', 'Calib', '', ' ', 'NaN')
              THEN NULL ELSE TRY_CAST(value_text AS DOUBLE) END AS v0
  FROM t
),
clean AS (
  SELECT file, datetime, station_pk, metric,
         CASE WHEN isnan(v0) THEN NULL
              WHEN metric = 'wind_speed' AND v0 < 0 THEN NULL
              WHEN metric = 'wind_direction' AND (v0 < 0 OR v0 > 360) THEN NULL
              ELSE v0 END AS value
  FROM c WHERE datetime IS NOT NULL
),
vr AS (
  SELECT * FROM (VALUES ('wind_direction', CAST(0 AS DOUBLE), CAST(360 AS DOUBLE)),
    ('wind_speed', CAST(0 AS DOUBLE), CAST(100 AS DOUBLE)), ('no2', CAST(0 AS DOUBLE), CAST(500 AS DOUBLE)),
    ('o3', CAST(0 AS DOUBLE), CAST(400 AS DOUBLE)), ('pm10', CAST(0 AS DOUBLE), CAST(1000 AS DOUBLE)),
    ('pm25', CAST(0 AS DOUBLE), CAST(500 AS DOUBLE)), ('so2', CAST(0 AS DOUBLE), CAST(350 AS DOUBLE))) AS r(metric, lo, hi)
),
tagged AS (
  SELECT c.*, NULLIF(concat_ws(';',
      CASE WHEN c.datetime IS NULL THEN 'missing_datetime' END,
      CASE WHEN c.station_pk IS NULL THEN 'missing_station_pk' END,
      CASE WHEN c.metric IS NULL THEN 'missing_metric' END,
      CASE WHEN c.value IS NOT NULL AND vr.lo IS NOT NULL AND (c.value < vr.lo OR c.value > vr.hi)
           THEN 'out_of_range' END), '') AS __error__
  FROM clean c LEFT JOIN vr ON c.metric = vr.metric
)
"""

_WH = LINEITEM.rstrip() + """,
wh AS (SELECT station_fk, timestamp, metric, CAST(value AS DECIMAL(12,4)) AS value, unit, source, quality_flag FROM fact),
cur AS (SELECT * REPLACE (CASE WHEN station_fk % 10 = 3 THEN NULL ELSE source END AS source)
  FROM wh WHERE timestamp < TIMESTAMP '1999-01-01 00:00:00'),
bat AS (SELECT * REPLACE (CASE WHEN station_fk % 10 = 3 THEN NULL ELSE source END AS source, CAST(value + 0.5 AS DECIMAL(12,4)) AS value)
  FROM wh WHERE timestamp >= TIMESTAMP '1998-01-01 00:00:00'),
keyed AS (
  SELECT *, row_number() OVER (ORDER BY station_fk NULLS LAST, timestamp NULLS LAST, metric NULLS LAST,
         value NULLS LAST, unit NULLS LAST, source NULLS LAST, quality_flag NULLS LAST) AS measurement_pk
  FROM wh
),
sup AS (
  SELECT CAST(s_suppkey AS INTEGER) AS station_pk, 'ST' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS station_code,
         s_name AS station_name, 'AQM' AS location_type, 'Monitoring site of ' || s_name AS description
  FROM supplier
)
"""

_EV_DIM_SUP = EVENTS.rstrip() + """,
sup AS (
  SELECT CAST(s_suppkey AS INTEGER) AS station_pk, 'ST' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS station_code,
         s_name AS station_name, 'AQM' AS location_type, 'Monitoring site of ' || s_name AS description
  FROM supplier
),
cur AS (
  SELECT station_pk, station_code, station_name, location_type, description, TRUE AS is_active,
         TIMESTAMP '2024-01-01 00:00:00' AS created_at, TIMESTAMP '2024-01-01 00:00:00' AS updated_at
  FROM dim
)
"""

_WCOLS = "station_fk, timestamp, metric, CAST(value AS DOUBLE) AS value, unit, source, quality_flag"
_KEYMATCH = "b.timestamp = c.timestamp AND b.station_fk = c.station_fk AND b.metric = c.metric AND b.source = c.source"

_MORE: dict[str, tuple[str, str]] = {
    "p9_clean_text": (_TEXT, "SELECT file, datetime, station_pk, metric, value FROM clean"),
    "p16_split_ok": (_TEXT, "SELECT file, datetime, station_pk, metric, value FROM tagged WHERE __error__ IS NULL"),
    "p16_split_rejects": (_TEXT, "SELECT file, datetime, station_pk, metric, value, __error__ FROM tagged "
                                 "WHERE __error__ IS NOT NULL"),
    "p17_fact_value": (
        "",
        "SELECT l_orderkey, l_linenumber, "
        "CAST(CAST(l_extendedprice / l_quantity AS DECIMAL(12,4)) AS DOUBLE) AS value FROM lineitem",
    ),
    "p18_valid_air_between": (
        EVENTS,
        "SELECT * FROM fact WHERE quality_flag = 'VALID' AND value IS NOT NULL AND source = 'air_quality' "
        "AND metric IN ('no2', 'pm10') AND value BETWEEN 0 AND 500",
    ),
    "p19_recent": (
        LINEITEM,
        "SELECT * FROM fact WHERE timestamp >= "
        "CAST((SELECT CAST(MAX(timestamp) AS DATE) FROM fact) - INTERVAL 30 DAY AS TIMESTAMP)",
    ),
    "s8_with_source": (
        "",
        "SELECT *, 'events.parquet' AS file, CAST(NULL AS VARCHAR) AS year, CAST(NULL AS VARCHAR) AS pollutant "
        "FROM events",
    ),
    "p12_to_wide": (STAGED, "SELECT * FROM wide"),
    "p13_melt": (STAGED, "SELECT datetime, station_pk, metric, value FROM melted"),
    "p15_normalise": (
        STAGED,
        "SELECT datetime, station_pk, station_code, station_name, location_type, metric, unit, value, "
        "quality_flag, source FROM tall",
    ),
    "j1_missing_metadata": (
        STAGED, "SELECT COUNT(*) FILTER (WHERE station_code IS NULL) AS missing_metadata FROM tall"
    ),
    "j2_duplicate_station_keys": (
        LINEITEM_ALL, "SELECT station_pk, COUNT(*) AS count FROM dim GROUP BY station_pk HAVING COUNT(*) > 1"
    ),
    "l1_merge_dim": (
        _EV_DIM_SUP,
        "SELECT * FROM sup UNION ALL "
        "SELECT * FROM dim d WHERE NOT EXISTS (SELECT 1 FROM sup s WHERE s.station_pk = d.station_pk)",
    ),
    "l2_upsert_fact": (
        _WH,
        f"SELECT {_WCOLS} FROM (SELECT * FROM cur c WHERE NOT EXISTS (SELECT 1 FROM bat b WHERE {_KEYMATCH}) "
        "UNION ALL SELECT * FROM bat)",
    ),
    "j6_replaced_rows": (
        _WH, f"SELECT {_WCOLS} FROM cur c WHERE EXISTS (SELECT 1 FROM bat b WHERE {_KEYMATCH})"
    ),
    "u4_batch_keys": (_WH, "SELECT DISTINCT timestamp, station_fk, metric, source FROM bat"),
    "l4_fact_load_stats": (
        _WH,
        f""", d AS (SELECT COUNT(*) AS deleted FROM cur c WHERE EXISTS (SELECT 1 FROM bat b WHERE {_KEYMATCH}))
SELECT d.deleted, (SELECT COUNT(*) FROM bat) AS inserted,
       (SELECT COUNT(*) FROM cur) - d.deleted + (SELECT COUNT(*) FROM bat) AS total
FROM d""",
    ),
    "l7_replace_range": (
        _WH,
        f"SELECT {_WCOLS} FROM (SELECT * FROM cur WHERE NOT (timestamp BETWEEN (SELECT MIN(timestamp) FROM bat) "
        "AND (SELECT MAX(timestamp) FROM bat)) OR timestamp IS NULL UNION ALL SELECT * FROM bat)",
    ),
    "l5_assign_keys": (_WH, f"SELECT {_WCOLS}, measurement_pk FROM keyed"),
    "l6_seed_dim": (
        LINEITEM_ALL,
        "SELECT station_pk, station_code, station_name, location_type, description, TRUE AS is_active, "
        "TIMESTAMP '2024-01-01 00:00:00' AS created_at, TIMESTAMP '2024-01-01 00:00:00' AS updated_at FROM dim",
    ),
    "l3_upsert_dim": (
        _EV_DIM_SUP,
        """SELECT COALESCE(c.station_pk, s.station_pk) AS station_pk,
  CASE WHEN s.station_pk IS NOT NULL THEN s.station_code ELSE c.station_code END AS station_code,
  CASE WHEN s.station_pk IS NOT NULL THEN s.station_name ELSE c.station_name END AS station_name,
  CASE WHEN s.station_pk IS NOT NULL THEN s.location_type ELSE c.location_type END AS location_type,
  CASE WHEN s.station_pk IS NOT NULL THEN s.description ELSE c.description END AS description,
  CASE WHEN c.station_pk IS NULL THEN TRUE ELSE c.is_active END AS is_active,
  CASE WHEN c.station_pk IS NULL THEN TIMESTAMP '2024-02-01 00:00:00' ELSE c.created_at END AS created_at,
  CASE WHEN s.station_pk IS NOT NULL THEN TIMESTAMP '2024-02-01 00:00:00' ELSE c.updated_at END AS updated_at,
  CASE WHEN c.station_pk IS NOT NULL AND s.station_pk IS NOT NULL THEN 'updated'
       WHEN s.station_pk IS NOT NULL THEN 'inserted' ELSE 'unchanged' END AS __change
FROM cur c FULL OUTER JOIN sup s ON c.station_pk = s.station_pk""",
    ),
    "v1_measurements": (
        _WH,
        "SELECT k.measurement_pk, s.station_code, s.station_name, k.timestamp, k.metric, "
        "CAST(k.value AS DOUBLE) AS value, k.unit, k.source, k.quality_flag, "
        "TIMESTAMP '2024-01-01 00:00:00' AS created_at FROM keyed k JOIN dim s ON k.station_fk = s.station_pk",
    ),
    "e1_file_overview": (STAGED, E1),
    "e2_wide_coverage": (
        STAGED,
        f"""SELECT g.*, s.station_code, s.station_name FROM (
  SELECT 'staged_week_' || lpad(CAST(weekofyear(datetime) AS VARCHAR), 2, '0') || '.parquet' AS file,
         station_pk, metric, COUNT(value) AS non_null_points, COUNT(*) AS total_rows,
         {_pct_even("COUNT(value)", "COUNT(*)")} AS pct_non_null
  FROM melted GROUP BY 1, station_pk, metric) g LEFT JOIN stations s ON g.station_pk = s.station_pk""",
    ),
    "e3_unmapped_stations": (
        LINEITEM,
        "SELECT DISTINCT CAST(station_fk AS BIGINT) AS station_pk FROM fact f "
        "WHERE NOT EXISTS (SELECT 1 FROM dim s WHERE s.station_pk = f.station_fk)",
    ),
    "e4_completeness": (
        STAGED,
        f"SELECT station_pk, station_code, station_name, metric, COUNT(*) AS total_points, COUNT(value) AS non_null, "
        f"{_pct_even('COUNT(value)', 'COUNT(*)')} AS pct_non_null FROM tall "
        "GROUP BY station_pk, station_code, station_name, metric",
    ),
    "e5_missing_by_column": (STAGED, E5),
    "e6_describe_numeric": ("", E6),
    "e7_tall_overview": (
        STAGED,
        "SELECT file, COUNT(*) AS rows, COUNT(DISTINCT station_pk) AS stations, COUNT(DISTINCT metric) AS metrics, "
        + _half_even("AVG(CASE WHEN quality_flag = 'VALID' THEN 1.0 ELSE 0.0 END) * 100.0", 2)
        + " AS pct_valid, MIN(datetime) AS first_datetime, MAX(datetime) AS last_datetime FROM tall GROUP BY file",
    ),
    "e8_valid_coverage": (
        STAGED,
        f"""SELECT g.*, s.station_code, s.station_name FROM (
  SELECT file, station_pk, metric, COUNT(*) AS total_points,
         COUNT(*) FILTER (WHERE quality_flag = 'VALID') AS valid_points,
         {_pct_even("COUNT(*) FILTER (WHERE quality_flag = 'VALID')", "COUNT(*)")} AS pct_valid
  FROM tall GROUP BY file, station_pk, metric) g LEFT JOIN stations s ON g.station_pk = s.station_pk""",
    ),
    "e9_mean_pivot": (
        STAGED,
        "SELECT station_code, "
        + ", ".join(f"{_half_even(_mean(f'CASE WHEN metric = {chr(39)}{m}{chr(39)} THEN value END'), 2)} AS {m}"
                    for m in _EVENT_METRICS)
        + " FROM tall GROUP BY station_code",
    ),
    "e10_nodata_rate": (
        STAGED,
        "SELECT station_code, metric, "
        + _half_even("AVG(CASE WHEN quality_flag = 'NODATA' THEN 1.0 ELSE 0.0 END) * 100.0", 2)
        + " AS pct_nodata FROM tall GROUP BY station_code, metric",
    ),
    "e11_pollutant_summary": (
        STAGED,
        "SELECT metric, COUNT(value) AS count, "
        + _half_even(_mean("value"), 2) + " AS mean, "
        + _half_even("STDDEV_SAMP(value)", 2) + " AS std, "
        + _half_even("MIN(value)", 2) + " AS \"min\", "
        + _half_even("MAX(value)", 2) + " AS \"max\", "
        "COUNT(DISTINCT station_pk) AS stations, MIN(datetime) AS first_datetime, MAX(datetime) AS last_datetime "
        "FROM tall GROUP BY metric",
    ),
    "e12_flag_counts": (
        STAGED,
        "SELECT quality_flag, COUNT(*) AS count, "
        + _half_even("CAST(COUNT(*) AS DOUBLE) / CAST(SUM(COUNT(*)) OVER () AS DOUBLE) * 100.0", 1)
        + " AS percentage FROM tall GROUP BY quality_flag",
    ),
    "e13_rows_by_pollutant_year": (
        STAGED,
        "SELECT metric AS pollutant, COUNT(*) FILTER (WHERE CAST(year(datetime) AS VARCHAR) = '2024') AS \"2024\" "
        "FROM tall GROUP BY metric",
    ),
    "e13_files_by_year_pollutant": (
        STAGED,
        "SELECT year, "
        + ", ".join(f"COUNT(*) FILTER (WHERE pollutant = '{m}') AS {m}" for m in _EVENT_METRICS)
        + " FROM (SELECT DISTINCT file, metric AS pollutant, CAST(year(datetime) AS VARCHAR) AS year FROM tall) "
        "GROUP BY year",
    ),
    "a2_top10_metrics": (
        LINEITEM,
        "SELECT metric, COUNT(*) AS count, MIN(timestamp) AS earliest, MAX(timestamp) AS latest "
        "FROM fact GROUP BY metric ORDER BY count DESC, metric NULLS LAST LIMIT 10",
    ),
    "e13_mean_station_count": (
        STAGED,
        "SELECT pollutant, AVG(s) AS mean_stations FROM (SELECT metric AS pollutant, file, "
        "COUNT(DISTINCT station_pk) AS s FROM tall GROUP BY metric, file) GROUP BY pollutant",
    ),
    "e14_missing_datasets": (
        STAGED,
        """, expected AS (
  SELECT * FROM (VALUES ('no2', '2019'), ('o3', '2019'), ('pm10', '2019'), ('so2', '2019'),
    ('no2', '2020'), ('o3', '2020'), ('pm10', '2020'), ('pm25', '2020'), ('so2', '2020'),
    ('no2', '2021'), ('o3', '2021'), ('pm10', '2021'), ('pm25', '2021'), ('so2', '2021'),
    ('no2', '2022'), ('o3', '2022'), ('pm10', '2022'), ('pm25', '2022'), ('so2', '2022')) AS e(pollutant, year)
)
SELECT e.pollutant, e.year FROM expected e WHERE NOT EXISTS (
  SELECT 1 FROM tall t WHERE t.metric = e.pollutant AND CAST(year(t.datetime) AS VARCHAR) = e.year)""",
    ),
    "e15_station_overlap": (
        LINEITEM,
        "SELECT station_fk AS station_pk FROM fact WHERE source = 'wind' INTERSECT "
        "SELECT station_fk AS station_pk FROM fact WHERE source = 'air_quality'",
    ),
    "e16_dim_profile": (
        LINEITEM_ALL,
        "SELECT COUNT(*) AS rows, COUNT(DISTINCT station_pk) AS distinct_keys, MIN(station_pk) AS min_key, "
        "MAX(station_pk) AS max_key FROM dim",
    ),
    "u1_union_all": (
        EVENTS,
        "SELECT *, CAST(year(timestamp) AS VARCHAR) AS year FROM fact WHERE source = 'wind' "
        "UNION ALL SELECT *, NULL AS year FROM fact WHERE source <> 'wind'",
    ),
}

ORACLE_SQL.update({k: _join(p, b) for k, (p, b) in _MORE.items()})


_U5 = (
    "SELECT l_orderkey, l_shipdate, l_linenumber, l_suppkey, l_quantity FROM lineitem "
    "QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate {d}, l_linenumber {d}, l_suppkey {d}, l_quantity {d}) = 1"
)
ORACLE_SQL.update(
    {
        "l4_dim_load_stats": _join(
            _EV_DIM_SUP,
            "SELECT COUNT(*) FILTER (WHERE c.station_pk IS NULL) AS stations_inserted, "
            "COUNT(*) FILTER (WHERE c.station_pk IS NOT NULL) AS stations_updated, COUNT(*) AS total_stations "
            "FROM sup s LEFT JOIN cur c ON c.station_pk = s.station_pk",
        ),
        "l4_rows_per_file": "SELECT 'events.parquet' AS file, COUNT(*) AS rows FROM events",
        "u5_keep_first": _U5.format(d="ASC"),
        "u5_keep_last": _U5.format(d="DESC"),
    }
)
ORACLE_SQL.update(SHEETS_SQL)


# --------------------------------------------------------------------------
# Poor data, order as data, reference tables from a file
# --------------------------------------------------------------------------

_RAW = f"""
WITH {SHEET_LINES.strip()},
readings AS (
  SELECT l_orderkey, l_linenumber, CASE WHEN t <> 7 THEN l_shipdate END AS datetime, r.station_pk,
         CASE p_type WHEN 'ECONOMY' THEN 'wind_direction' WHEN 'LARGE' THEN 'wind_speed' WHEN 'STANDARD' THEN 'no2'
                     WHEN 'SMALL' THEN 'pm10' WHEN 'MEDIUM' THEN 'noise' END AS metric,
         CASE WHEN d = 5 THEN -l_quantity WHEN d <> 7 THEN l_quantity * 10 END AS value
  FROM lines LEFT JOIN register r ON l_suppkey = r.station_pk
),
vr AS (SELECT * FROM (VALUES ('wind_direction', 0, 360), ('wind_speed', 0, 100), ('no2', 0, 500), ('pm10', 0, 1000)) AS r(metric, lo, hi)),
tagged AS (
  SELECT c.*, NULLIF(concat_ws(';', CASE WHEN datetime IS NULL THEN 'missing_datetime' END,
      CASE WHEN station_pk IS NULL THEN 'missing_station_pk' END, CASE WHEN c.metric IS NULL THEN 'missing_metric' END,
      CASE WHEN value < lo OR value > hi THEN 'out_of_range' END), '') AS __error__
  FROM readings c LEFT JOIN vr ON c.metric = vr.metric
)
"""
_FILE = EVENTS.rstrip() + """,
defs AS (SELECT metric, MIN(value) AS a, MAX(value) AS b FROM fact GROUP BY metric)"""
_E1_FACTS = LINEITEM.rstrip() + f""",
named AS (SELECT 'facts_' || year(timestamp) || '.parquet' AS file, timestamp, station_fk, metric, value FROM fact),
grouped AS (SELECT file, timestamp, station_fk, metric, value, COUNT(*) AS n FROM named GROUP BY file, timestamp, station_fk, metric, value)
SELECT file, CAST(SUM(n) AS BIGINT) AS rows, 4 AS columns, CAST(SUM(n - 1) AS BIGINT) AS duplicate_rows,
       CAST(SUM(CASE WHEN value IS NULL THEN n ELSE 0 END) AS BIGINT) AS rows_with_nulls,
       {_pct_even("SUM(CASE WHEN value IS NULL THEN n ELSE 0 END)", "SUM(n)")} AS pct_rows_with_nulls
FROM grouped GROUP BY file
"""

ORACLE_SQL.update(
    {
        "a9_high_null_sparse": _join(SPARSE, _BODIES["a9_high_null_metrics"][1]),
        "a12_low_quality_sparse": _join(SPARSE, _BODIES["a12_low_quality_metrics"][1]),
        "a14_dq_issues_sparse": _join(SPARSE, A14),
        "j1_missing_metadata_facts": _join(
            LINEITEM, "SELECT COUNT(*) AS missing_metadata FROM fact LEFT JOIN dim ON station_fk = station_pk WHERE station_code IS NULL"
        ),
        "j2_duplicate_nations": "SELECT c_nationkey, COUNT(*) AS count FROM customer GROUP BY c_nationkey HAVING COUNT(*) > 1",
        "b8_daily_correlation_nations": _join(
            EVENTS.replace("FROM customer WHERE c_acctbal >= 0", "FROM customer").replace(
                "'CU' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS station_code,\n         c_name AS station_name",
                "'' AS station_code,\n         (SELECT n_name FROM nation WHERE n_nationkey = c_nationkey) AS station_name",
            ),
            _corr("day"),
        ),
        "e1_file_overview_facts": _E1_FACTS,
        "e14_missing_years": _join(
            LINEITEM,
            ", years AS (SELECT CAST(UNNEST(range(1994, 2003)) AS VARCHAR) AS year) "
            "SELECT DISTINCT metric AS pollutant, year FROM fact CROSS JOIN years "
            "EXCEPT SELECT metric, CAST(year(timestamp) AS VARCHAR) FROM fact",
        ),
        "p16_rejection_counts": _join(_RAW, "SELECT COALESCE(__error__, 'ok') AS reason, COUNT(*) AS rows FROM tagged GROUP BY ALL"),
        "p16_tagged_rows": _join(_RAW, "SELECT * FROM tagged"),
        "o1_placed_facts": _join(
            LINEITEM,
            "SELECT timestamp, station_fk, metric, value, ROW_NUMBER() OVER (ORDER BY timestamp NULLS LAST, station_fk NULLS LAST, "
            "metric NULLS LAST, value NULLS LAST) AS place FROM fact",
        ),
        "o1_sortedness": "SELECT COUNT(*) AS rows, CAST(0 AS BIGINT) AS inversions, CAST(0 AS BIGINT) AS overlaps FROM lineitem",
        "o2_ranked_stations": _join(
            LINEITEM, "SELECT *, ROW_NUMBER() OVER (ORDER BY count DESC, station_name) AS place FROM (" + _BODIES["a3_counts_by_station"][1] + ")"
        ),
        "s7_station_aliases": "SELECT UNNEST([s_name, s_name || ' AQM Site']) AS alias, CAST(s_suppkey AS INTEGER) AS station_pk, "
        "'ST' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS station_code, s_name AS station_name FROM supplier",
        "s7_range_rules": _join(
            _FILE,
            "SELECT f.metric, COUNT(value) AS readings, COUNT(*) FILTER (WHERE value BETWEEN a + 2 AND b - 2) AS kept "
            "FROM fact f JOIN defs d ON f.metric = d.metric GROUP BY f.metric",
        ),
        "s7_value_ranges": _join(
            EVENTS,
            A10.replace(_RANGES.strip(), "defs AS (SELECT metric, MIN(value) AS a, MAX(value) AS b FROM fact GROUP BY metric), "
                        "ranges AS (SELECT metric, a + 5 AS lo, b - 5 AS hi FROM defs)"),
        ),
        "s7_rejection_counts": _join(
            _TEXT.rstrip() + """,
defs AS (SELECT CASE event_type WHEN 'view' THEN 'wind_speed' WHEN 'error' THEN 'wind_direction' WHEN 'click' THEN 'no2'
                WHEN 'signup' THEN 'o3' WHEN 'purchase' THEN 'pm10' END AS metric,
                MIN(value * CAST(1.0936133 AS DOUBLE)) + 2 AS lo, MAX(value * CAST(1.0936133 AS DOUBLE)) - 2 AS hi
         FROM events WHERE value >= 5.0 GROUP BY ALL)
""",
            "SELECT CASE WHEN value < lo OR value > hi THEN 'out_of_range' ELSE 'ok' END AS reason, COUNT(*) AS rows "
            "FROM clean c JOIN defs d ON c.metric = d.metric GROUP BY ALL",
        ),
    }
)

_TALL_FACTS = LINEITEM.rstrip() + """,
stations AS (SELECT CAST(station_pk AS BIGINT) AS station_pk, station_code, station_name, location_type FROM dim),
tall AS (
  SELECT f.timestamp AS datetime, f.station_fk AS station_pk, s.station_code, s.station_name, f.metric, f.unit, f.value, f.quality_flag, f.source,
         'facts_' || year(f.timestamp) || '_normalised.parquet' AS file
  FROM fact f LEFT JOIN dim s ON f.station_fk = s.station_pk
)
"""
_RENAMED = _EV_DIM_SUP.replace("FROM supplier\n)", "FROM supplier WHERE s_suppkey % 3 <> 0 UNION ALL\n  "
    "SELECT CAST(s_suppkey AS INTEGER), 'ST' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0'), 'again ' || s_name, 'AQM', "
    "'Monitoring site of ' || s_name FROM supplier WHERE s_suppkey % 3 = 0\n)", 1)  # fmt: skip

ORACLE_SQL.update(
    {f"{k}_facts": _join(_TALL_FACTS, _MORE[k][1]) for k in (
        "e4_completeness", "e7_tall_overview", "e8_valid_coverage", "e9_mean_pivot", "e10_nodata_rate", "e11_pollutant_summary",
        "e12_flag_counts", "e13_mean_station_count",
    )}
    | {
        "e15_station_overlap_high": _join(
            EVENTS,
            "SELECT station_fk AS station_pk FROM fact WHERE metric = 'wind_speed' AND value > 250 INTERSECT "
            "SELECT station_fk FROM fact WHERE metric = 'pm10' AND value > 150",
        ),
        "l1_merge_dim_repeated": ORACLE_SQL["l1_merge_dim"],  # the first of several rows wins, which is the plain one
        "l3_upsert_dim_repeated": _join(_RENAMED, _MORE["l3_upsert_dim"][1]),
        "p17_special_values": "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber > 3 THEN CAST(CAST(CASE WHEN l_linenumber = 4 "
        "THEN -(l_extendedprice / l_quantity) ELSE l_extendedprice / l_quantity END AS DECIMAL(12,4)) AS DOUBLE) END AS value FROM lineitem",
    }
)
