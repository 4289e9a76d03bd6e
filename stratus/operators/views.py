"""The warehouse views (V1-V4) as functions returning lazy DataFrames.

``register_views`` publishes them as temp views for SQL users. The ORDER BY of
the original views is applied at the edge only (a final range sort over the
result), so composing a view into another query does not pay for it: use
``ordered=False``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.plans import with_station


def v_measurements(fact: DataFrame, dim: DataFrame, ordered: bool = True) -> DataFrame:
    """V1: measurements with station code and name, newest first."""
    j = with_station(fact, dim, "inner", ("station_code", "station_name"))
    out = j.select(
        "measurement_pk", "station_code", "station_name", "timestamp", "metric", "value",
        "unit", "source", "quality_flag", "created_at",
    )
    return out.orderBy(F.desc_nulls_last("timestamp")) if ordered else out


def v_wind(fact: DataFrame, dim: DataFrame, ordered: bool = True) -> DataFrame:
    """V2: one row per station and timestamp with direction and speed side by side.

    The fact is grouped by (station key, timestamp) and joined afterwards:
    station codes are unique in the dimension, so a key maps to exactly one
    (code, name) and grouping by the key is grouping by code and name. This
    keeps the plan at one shuffle.
    """
    w = fact.filter(F.col("source") == "wind")
    per_key = w.groupBy("station_fk", "timestamp").agg(
        F.max(F.when(F.col("metric") == "wind_direction", F.col("value"))).alias("wind_direction_deg"),
        F.max(F.when(F.col("metric") == "wind_speed", F.col("value"))).alias("wind_speed_ms"),
    )
    j = with_station(per_key, dim, "inner", ("station_code", "station_name"))
    out = j.select("station_code", "station_name", "timestamp", "wind_direction_deg", "wind_speed_ms")
    return out.orderBy(F.desc_nulls_last("timestamp")) if ordered else out


def v_quality(fact: DataFrame, dim: DataFrame, ordered: bool = True) -> DataFrame:
    """V3: totals, VALID count, NULL values and first/last record per station x metric."""
    per_key = fact.groupBy("station_fk", "metric").agg(
        F.count(F.lit(1)).alias("t"),
        F.count(F.when(F.col("quality_flag") == "VALID", F.lit(1))).alias("v"),
        F.count(F.when(F.col("value").isNull(), F.lit(1))).alias("z"),
        F.min("timestamp").alias("lo"),
        F.max("timestamp").alias("hi"),
    )
    j = with_station(per_key, dim)
    out = j.groupBy("station_name", "metric").agg(
        F.sum("t").cast("long").alias("total_records"),
        F.sum("v").cast("long").alias("valid_records"),
        F.sum("z").cast("long").alias("null_values"),
        F.min("lo").alias("earliest_record"),
        F.max("hi").alias("latest_record"),
    )
    return out.orderBy(F.asc_nulls_last("station_name"), F.asc_nulls_last("metric")) if ordered else out


def station_directory(dim: DataFrame) -> DataFrame:
    """V4: key, code, name and type in key order."""
    return dim.select("station_pk", "station_code", "station_name", "location_type").orderBy("station_pk")


def register_views(fact: DataFrame, dim: DataFrame) -> None:
    """Expose the views to SQL under their warehouse names."""
    fact.createOrReplaceTempView("fact_measurement")
    dim.createOrReplaceTempView("dim_station")
    if {"measurement_pk", "created_at"} <= set(fact.columns):  # warehouse facts carry them
        v_measurements(fact, dim, ordered=False).createOrReplaceTempView("v_measurements")
    v_wind(fact, dim, ordered=False).createOrReplaceTempView("v_wind_data")
    v_quality(fact, dim, ordered=False).createOrReplaceTempView("v_data_quality_summary")
