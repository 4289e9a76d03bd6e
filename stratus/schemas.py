"""Schemas of every layer and the fixed reference values.

Layers: raw cells (D1), staged wide (D2, dynamic columns), tall fact (D3),
station file (D4), warehouse dimension (D5), warehouse fact (D6) and the
reference tables (D7). Production reads always pass these schemas; nothing is
inferred.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Schemas
# --------------------------------------------------------------------------

CELLS = T.StructType(
    [
        T.StructField("file", T.StringType(), False),
        T.StructField("sheet_row", T.IntegerType(), False),
        T.StructField("col", T.IntegerType(), False),
        T.StructField("text", T.StringType(), True),
        T.StructField("kind", T.StringType(), True),
    ]
)

TALL = T.StructType(
    [
        T.StructField("datetime", T.TimestampNTZType(), True),
        T.StructField("station_pk", T.LongType(), True),
        T.StructField("station_code", T.StringType(), True),
        T.StructField("station_name", T.StringType(), True),
        T.StructField("location_type", T.StringType(), True),
        T.StructField("metric", T.StringType(), True),
        T.StructField("unit", T.StringType(), True),
        T.StructField("value", T.DoubleType(), True),
        T.StructField("quality_flag", T.StringType(), True),
        T.StructField("source", T.StringType(), True),
    ]
)
TALL_COLUMNS = [f.name for f in TALL.fields]

STATION_FILE = T.StructType(
    [
        T.StructField("station_pk", T.LongType(), False),
        T.StructField("station_code", T.StringType(), True),
        T.StructField("station_name", T.StringType(), True),
        T.StructField("location_type", T.StringType(), True),
        T.StructField("description", T.StringType(), True),
    ]
)

DIM_STATION = T.StructType(
    [
        T.StructField("station_pk", T.IntegerType(), False),
        T.StructField("station_code", T.StringType(), False),
        T.StructField("station_name", T.StringType(), False),
        T.StructField("location_type", T.StringType(), True),
        T.StructField("latitude", T.DecimalType(10, 6), True),
        T.StructField("longitude", T.DecimalType(10, 6), True),
        T.StructField("elevation", T.DecimalType(8, 2), True),
        T.StructField("description", T.StringType(), True),
        T.StructField("is_active", T.BooleanType(), True),
        T.StructField("created_at", T.TimestampNTZType(), True),
        T.StructField("updated_at", T.TimestampNTZType(), True),
    ]
)

FACT = T.StructType(
    [
        T.StructField("measurement_pk", T.LongType(), False),
        T.StructField("station_fk", T.IntegerType(), False),
        T.StructField("timestamp", T.TimestampNTZType(), False),
        T.StructField("metric", T.StringType(), False),
        T.StructField("value", T.DecimalType(12, 4), True),
        T.StructField("unit", T.StringType(), True),
        T.StructField("source", T.StringType(), True),
        T.StructField("quality_flag", T.StringType(), True),
        T.StructField("created_at", T.TimestampNTZType(), True),
    ]
)

# Natural key of a measurement (used by load, duplicate and integrity checks).
NATURAL_KEY = ["timestamp", "station_fk", "metric", "source"]

# --------------------------------------------------------------------------
# Fixed values (must equal the source system's for identical results)
# --------------------------------------------------------------------------

# Stations: pk, code, name, aliases, location type, description.
STATIONS = [
    (1, "ATLAN001", "Atlantis AQM Site", ["Atlantis AQM Site"], "AQM", "Air Quality Monitoring site in Atlantis"),
    (2, "BELLV001", "Bellville South AQM Site", ["Bellville South AQM Site"], "AQM", "Air Quality Monitoring site in Bellville South"),
    (3, "BOTHA001", "Bothasig AQM Site", ["Bothasig AQM Site"], "AQM", "Air Quality Monitoring site in Bothasig"),
    (4, "GOODW001", "Goodwood AQM Station", ["Goodwood AQM Station"], "AQM", "Air Quality Monitoring station in Goodwood"),
    (5, "KHAYE001", "Khayelitsha AQM Site", ["Khayelitsha AQM Site"], "AQM", "Air Quality Monitoring site in Khayelitsha"),
    (6, "SOMER001", "Somerset West AQM Site", ["Somerset West AQM Site", "Somerset-West AQM Site"], "AQM", "Air Quality Monitoring site in Somerset West"),
    (7, "TABLE001", "Tableview AQM Site", ["Tableview AQM Site"], "AQM", "Air Quality Monitoring site in Tableview"),
    (8, "FORES001", "Foreshore AQM Site", ["Foreshore AQM Site"], "AQM", "Air Quality Monitoring site in Foreshore"),
    (9, "MOLTE001", "Molteno AQM Site", ["Molteno AQM Site"], "AQM", "Air Quality Monitoring site in Molteno"),
    (10, "PLATT001", "Plattekloof AQM Site", ["Plattekloof AQM Site"], "AQM", "Air Quality Monitoring site in Plattekloof"),
    (11, "WALLA001", "Wallacedene AQM Site", ["Wallacedene AQM Site"], "AQM", "Air Quality Monitoring site in Wallacedene"),
]

# Metrics: code, unit, valid range.
METRICS = [
    ("wind_direction", "degrees", [0.0, 360.0]),
    ("wind_speed", "m/s", [0.0, 100.0]),
    ("no2", "ug/m3(S)", [0.0, 500.0]),
    ("o3", "ug/m3(S)", [0.0, 400.0]),
    ("pm10", "ug/m3(S)", [0.0, 1000.0]),
    ("pm25", "ug/m3(S)", [0.0, 500.0]),
    ("so2", "ug/m3(S)", [0.0, 350.0]),
]

# Unit per metric used by the melt (metrics outside it get a NULL unit).
METRIC_UNITS = {code: unit for code, unit, _ in METRICS}

# Expected ranges of the data-quality range check (differ from METRICS ranges).
DQ_EXPECTED_RANGES = [
    ("wind_speed", 0.0, 50.0),
    ("wind_direction", 0.0, 360.0),
    ("no2", 0.0, 1000.0),
    ("o3", 0.0, 500.0),
    ("pm10", 0.0, 2000.0),
    ("pm25", 0.0, 1000.0),
    ("so2", 0.0, 1000.0),
]

# Missing-value tokens of the wind and air-quality spreadsheets.
WIND_SENTINELS = ["NoData", "InVld", "", " "]
AIR_SENTINELS = ["NoData", "InVld", "<Samp", "Down", "RS232", "Zero", "Calib", "", " ", "NaN"]

# Substrings that mark a header cell as a station name (air-quality detection).
STATION_INDICATORS = [
    "AQM", "Site", "Station", "Atlantis", "Bellville", "Bothasig", "Goodwood",
    "Khayelitsha", "Somerset", "Tableview", "Foreshore", "Molteno", "Plattekloof", "Wallacedene",
]

# Header cells that count as pollutant names (compared upper-cased).
POLLUTANT_INDICATORS = ["NO2", "O3", "PM10", "PM2.5", "SO2"]

# Standard workbook file name: year, pollutant, fixed suffix (matched upper-cased).
STANDARD_WORKBOOK_NAME = r"^\d{4}_([^_]+)_CCT\.XLSX?$"

# File-name fallback order of pollutant detection (NO2 before NO).
POLLUTANT_FALLBACK = ["NO2", "NO", "O3", "SO2", "CO", "NH3", "H2S", "BENZENE"]

# Archive members kept by name.
ARCHIVE_MEMBER_POLLUTANTS = ["NO2", "O3", "PM10", "PM2.5", "SO2"]

# Expected (pollutant, year) datasets: 2019 has no pm25.
EXPECTED_DATASETS = (
    [(p, "2019") for p in ["no2", "o3", "pm10", "so2"]]
    + [(p, y) for y in ["2020", "2021", "2022"] for p in ["no2", "o3", "pm10", "pm25", "so2"]]
)
