"""DuckDB SQL of the queries over raw sheets (headers, names, cleaning end to end)."""

from __future__ import annotations

SHEET_LINES = """
lines AS (
  SELECT l.*, s.s_name, s.s_nationkey, p.p_name, p.p_type, o.o_orderstatus,
         CAST(ROUND(l_discount * 100) AS INTEGER) AS d, CAST(ROUND(l_tax * 100) AS INTEGER) AS t,
         CASE WHEN s_nationkey = 6 THEN 'Somerset-West AQM Site ' || s_suppkey ELSE s_name || ' AQM Site' END AS sheet_name
  FROM (SELECT * FROM lineitem QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_partkey, l_suppkey, l_shipdate, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus) = 1) l
  JOIN supplier s ON l_suppkey = s_suppkey JOIN part p ON l_partkey = p_partkey JOIN orders o ON l_orderkey = o_orderkey
),
register AS (
  SELECT CASE WHEN s_nationkey = 6 THEN 'Somerset West AQM Site ' || s_suppkey ELSE s_name || ' AQM Site' END AS alias,
         s_suppkey AS station_pk
  FROM supplier WHERE s_acctbal >= 0
)"""

_CELLS = """
cells AS (
  SELECT file, CAST(sheet_row AS INTEGER) AS sheet_row, CAST(col AS INTEGER) AS col, MAX(text) AS text
  FROM raw WHERE text IS NOT NULL GROUP BY file, sheet_row, col
)"""

WIND = f"""
WITH {SHEET_LINES.strip()},
raw AS (
  SELECT 'wind_' || l_orderkey || '.xlsx' AS file, c.sheet_row, c.col, c.text FROM lines, LATERAL (VALUES
    (2, l_linenumber, CASE l_returnflag WHEN 'A' THEN ' ' || sheet_name WHEN 'R' THEN '  ' END),
    (3, l_linenumber, CASE p_type WHEN 'MEDIUM' THEN p_name WHEN 'ECONOMY' THEN 'Wind Dir V' WHEN 'LARGE' THEN ' Wind Speed V '
                      WHEN 'STANDARD' THEN 'Wind Speed V' WHEN 'SMALL' THEN '' END),
    (4, l_linenumber, CASE WHEN l_linestatus = 'O' THEN ' m/s' END),
    (l_linenumber + 5, 0, CASE WHEN t = 7 THEN NULL WHEN t = 8 THEN 'Minimum'
                          WHEN (t = 6) = (l_orderkey % 2 = 0) THEN strftime(l_shipdate, '%-m/%-d/%Y %-H:%M')
                          ELSE strftime(l_shipdate, '%Y-%m-%d %H:%M') END),
    (l_linenumber + 5, l_linenumber, CASE d WHEN 7 THEN NULL WHEN 5 THEN '-' || CAST(l_quantity AS VARCHAR)
       WHEN 6 THEN CAST(l_quantity * 10 AS VARCHAR) WHEN 0 THEN 'NoData' WHEN 1 THEN 'InVld' WHEN 2 THEN 'NaN' WHEN 3 THEN 'inf'
       WHEN 4 THEN '1d' WHEN 8 THEN '1e2' ELSE CAST(l_quantity AS VARCHAR) END)
  ) AS c(sheet_row, col, text)
),
{_CELLS.strip()},
tops AS (
  SELECT file, col, trim(MAX(CASE WHEN sheet_row = 2 THEN text END)) AS st, trim(MAX(CASE WHEN sheet_row = 3 THEN text END)) AS param,
         trim(MAX(CASE WHEN sheet_row = 4 THEN text END)) AS unit
  FROM cells WHERE col >= 1 AND sheet_row < 10 GROUP BY file, col
),
header AS (
  SELECT file, col, station, param, COALESCE(unit, '') AS unit FROM (
    SELECT *, LAST_VALUE(replace(NULLIF(st, ''), 'Somerset-West', 'Somerset West') IGNORE NULLS)
              OVER (PARTITION BY file ORDER BY col ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS station FROM tops)
  WHERE param <> '' AND station IS NOT NULL
)"""

_METRIC = (
    "CASE WHEN contains(param, 'Dir') THEN 'wind_direction' WHEN contains(param, 'Speed') THEN 'wind_speed' "
    "ELSE replace(lower(param), ' ', '_') END"
)


def _number(text: str) -> str:
    """A guarded number: NaN and what is no plain decimal number or infinity are NULL."""
    form = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"
    return f"CASE WHEN regexp_full_match({text}, '{form}') THEN TRY_CAST(trim({text}) AS DOUBLE) END"


STAGE_WIND = WIND + f""",
dated AS (
  SELECT file, sheet_row, text, TRY_STRPTIME(text, '%Y-%m-%d %H:%M') AS iso, TRY_STRPTIME(text, '%m/%d/%Y %H:%M') AS us
  FROM cells WHERE col = 0
),
form AS (
  SELECT file, ARG_MIN(CASE WHEN iso IS NOT NULL THEN 'iso' ELSE 'us' END, sheet_row) AS form
  FROM dated WHERE sheet_row >= 5 AND (iso IS NOT NULL OR us IS NOT NULL) GROUP BY file
),
timed AS (
  SELECT d.file, d.sheet_row, CASE WHEN f.form = 'iso' THEN d.iso ELSE d.us END AS datetime FROM dated d JOIN form f ON d.file = f.file
),
vals AS (
  SELECT t.file, t.datetime, r.station_pk, {_METRIC} AS metric, {_number("CASE WHEN c.text IN ('NoData', 'InVld', '', ' ') THEN NULL ELSE c.text END")} AS v,
         t.sheet_row, h.col
  FROM timed t JOIN header h ON t.file = h.file JOIN register r ON h.station = r.alias
  LEFT JOIN cells c ON c.file = t.file AND c.sheet_row = t.sheet_row AND c.col = h.col
  WHERE t.datetime IS NOT NULL AND t.sheet_row >= 5
)
SELECT file, datetime, station_pk, metric,
       CASE WHEN metric = 'wind_direction' AND (v < 0 OR v > 360) THEN NULL WHEN metric = 'wind_speed' AND v < 0 THEN NULL ELSE v END AS value,
       sheet_row, col
FROM vals
"""

_LIKE = "regexp_matches(text, 'AQM|Site|Station|Atlantis|Bellville|Bothasig|Goodwood|Khayelitsha|Somerset|Tableview|Foreshore|Molteno|Plattekloof|Wallacedene')"

AIR = f"""
WITH {SHEET_LINES.strip()},
placed AS (SELECT *, CASE WHEN o_orderstatus = 'F' THEN 3 ELSE 2 END AS first,
           CASE WHEN l_returnflag = 'R' THEN s_name ELSE sheet_name END AS shown FROM lines),
raw AS (
  SELECT 'air_' || l_orderkey || '.xlsx' AS file, c.sheet_row, c.col, c.text FROM placed, LATERAL (VALUES
    (first, l_linenumber, shown),
    (first + 1, l_linenumber, CASE l_returnflag WHEN 'A' THEN 'NO2' WHEN 'N' THEN 'o3' WHEN 'R' THEN 'pollen' END),
    (first + 2, l_linenumber, CASE WHEN l_linestatus = 'O' THEN 'ug/m3' END),
    (6, l_linenumber, CASE WHEN o_orderstatus = 'P' THEN shown END),
    (l_linenumber + 7, 0, CASE WHEN t = 7 THEN NULL WHEN t = 8 THEN strftime(l_shipdate, '%-d/%-m/%Y 24:00')
                          ELSE strftime(l_shipdate, '%-d/%-m/%Y %-H:%M') END),
    (l_linenumber + 7, l_linenumber, CASE d WHEN 7 THEN NULL WHEN 0 THEN '<Samp' WHEN 1 THEN 'Down' WHEN 2 THEN 'RS232' WHEN 3 THEN 'Zero'
       WHEN 4 THEN 'Calib' WHEN 5 THEN 'NaN' WHEN 8 THEN '1e3' WHEN 9 THEN ' ' ELSE CAST(l_quantity AS VARCHAR) END)
  ) AS c(sheet_row, col, text)
),
{_CELLS.strip()},
frame AS (SELECT file, sheet_row - 1 AS frow, col, text, {_LIKE} AS station_like FROM cells),
facts AS (
  SELECT file, MAX(frow) + 1 AS frame_rows, MAX(col) AS width,
         COUNT(*) FILTER (WHERE frow = 2 AND col >= 1 AND station_like) AS st_hits,
         COUNT(*) FILTER (WHERE frow = 3 AND col >= 1 AND upper(text) IN ('NO2', 'O3', 'PM10', 'PM2.5', 'SO2')) AS pol_hits
  FROM frame GROUP BY file
),
best AS (
  SELECT file, frow AS best_row FROM (SELECT file, frow, COUNT(*) AS hits FROM frame WHERE station_like AND frow BETWEEN 0 AND 7 GROUP BY file, frow)
  WHERE hits >= 2 QUALIFY ROW_NUMBER() OVER (PARTITION BY file ORDER BY hits DESC, frow) = 1
),
layouts AS (
  SELECT f.file, layout, CASE WHEN layout = 'fallback' THEN CAST(best_row AS INTEGER) END AS best_row, width,
         CAST(1 + CASE layout WHEN 'standard' THEN 5 WHEN 'fallback' THEN best_row + 1 ELSE 1 END AS INTEGER) AS data_start
  FROM (SELECT f.*, b.best_row, CASE WHEN frame_rows >= 5 AND st_hits >= 2 AND pol_hits >= 1 THEN 'standard'
                                     WHEN b.best_row IS NOT NULL THEN 'fallback' ELSE 'synthetic' END AS layout
        FROM facts f LEFT JOIN best b ON f.file = b.file) f
),
header AS (
  SELECT c.file, c.col, COALESCE(MAX(CASE WHEN frow = CASE WHEN layout = 'standard' THEN 2 ELSE best_row END THEN text END), '') AS station,
         CASE WHEN layout = 'standard' THEN COALESCE(MAX(CASE WHEN frow = 3 THEN text END), '') ELSE 'Unknown' END AS param,
         CASE WHEN layout = 'standard' THEN COALESCE(MAX(CASE WHEN frow = 4 THEN text END), '') ELSE 'Unknown' END AS unit,
         data_start, layout
  FROM frame c JOIN layouts l ON c.file = l.file WHERE layout <> 'synthetic' AND c.col >= 1 AND frow BETWEEN 0 AND 7
  GROUP BY c.file, c.col, layout, data_start
  UNION ALL
  SELECT file, CAST(col AS INTEGER), 'Unknown_Station_' || (col - 1), 'Unknown', 'Unknown', data_start, layout
  FROM (SELECT *, UNNEST(range(1, width + 1)) AS col FROM layouts WHERE layout = 'synthetic')
)"""

STAGE_AIR = AIR + f""",
mapping AS (
  SELECT h.file, h.col, r.station_pk, h.data_start
  FROM header h JOIN register r ON replace(trim(h.station), 'Somerset-West', 'Somerset West') = r.alias
  QUALIFY ROW_NUMBER() OVER (PARTITION BY h.file, r.station_pk ORDER BY h.col DESC) = 1
),
timed AS (SELECT file, sheet_row, TRY_STRPTIME(text, '%d/%m/%Y %H:%M') AS datetime FROM cells WHERE col = 0)
SELECT t.file, t.datetime, m.station_pk, 'no2' AS metric,
       {_number("CASE WHEN c.text IN ('NoData', 'InVld', '<Samp', 'Down', 'RS232', 'Zero', 'Calib', '', ' ', 'NaN') THEN NULL ELSE c.text END")} AS value,
       t.sheet_row, m.col
FROM timed t JOIN mapping m ON t.file = m.file
LEFT JOIN cells c ON c.file = t.file AND c.sheet_row = t.sheet_row AND c.col = m.col
WHERE t.datetime IS NOT NULL AND t.sheet_row >= m.data_start
"""

NAMES = """
WITH names AS (
  SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN year(o_orderdate) || '_' || label || '_CCT.xlsx'
                     WHEN 'O' THEN 'site ' || label || ' no ' || o_orderkey || '.xls' ELSE 'PM ' || o_orderkey || '.xlsx' END AS file
  FROM (SELECT *, CASE o_orderpriority WHEN '1-URGENT' THEN 'NO2' WHEN '2-HIGH' THEN 'PM2.5' WHEN '3-MEDIUM' THEN 'pm10'
                  WHEN '4-NOT SPECIFIED' THEN 'CO' ELSE substr(o_orderpriority, 3, 9) END AS label FROM orders)
),
parts AS (SELECT *, upper(file) AS u, regexp_extract(upper(file), '^[0-9]{4}_([^_]+)_CCT[.]XLSX?$', 1) AS mid FROM names)
SELECT o_orderkey, file, CASE
  WHEN mid <> '' THEN CASE WHEN mid LIKE '%PM2.5%' OR mid LIKE '%PM25%' THEN 'pm25' WHEN mid LIKE '%PM10%' THEN 'pm10'
                           WHEN mid LIKE '%PM1%' THEN 'pm1' ELSE lower(mid) END
  ELSE COALESCE(
    (SELECT lower(n) FROM (VALUES (1, 'NO2'), (2, 'NO'), (3, 'O3'), (4, 'SO2'), (5, 'CO'), (6, 'NH3'), (7, 'H2S'), (8, 'BENZENE')) AS f(i, n)
     WHERE contains(u, n) ORDER BY i LIMIT 1),
    CASE WHEN u NOT LIKE '%PM%' THEN NULL WHEN u LIKE '%2.5%' OR u LIKE '%25%' THEN 'pm25' WHEN u LIKE '%10%' THEN 'pm10'
         WHEN u LIKE '%1%' THEN 'pm1' ELSE 'pm' END) END AS pollutant
FROM parts
"""

SHEETS_SQL: dict[str, str] = {
    "p1_wind_header": WIND + "\nSELECT file, col, station, param, unit FROM header",
    "p2_air_header": AIR + "\nSELECT file, col, station, param, unit, data_start, layout FROM header",
    "p3_air_layouts": AIR + "\nSELECT file, layout, best_row, width, data_start FROM layouts",
    "p5_metric_from_param": WIND + f"\nSELECT param, {_METRIC} AS metric, COUNT(*) AS columns FROM header GROUP BY param",
    "p6_pollutant_from_name": NAMES,
    "p7_stage_wind": STAGE_WIND,
    "p8_stage_air": STAGE_AIR,
    "j7_alias_join": WIND + "\nSELECT station, station_pk, COUNT(*) AS columns FROM header LEFT JOIN register ON station = alias GROUP BY ALL",
    "j7_unknown_stations": WIND + "\nSELECT DISTINCT file, station FROM header WHERE station NOT IN (SELECT alias FROM register)",
}
