"""Measurement facts projected from the benchmark tables.

The benchmark data holds no sensor readings, so the operators are exercised on
two projections that have the warehouse fact's shape
``(timestamp, station_fk, metric, value, unit, source, quality_flag)``:

* ``lineitem``: one measurement per line item, stations are suppliers.
  Multi-year daily grain (83 months); used by most reports.
* ``events``: one measurement per event, stations are customers (users).
  Sub-second timestamps over 30 days; used where the hour matters.

Each projection reads only the columns it needs, so the parquet scan is pruned;
nothing is filtered away: every row of the table becomes a measurement.
The station dimensions list the *active* stations only (non-negative account
balance), so measurements of inactive stations are orphans, as in a warehouse
whose register lags behind its data feeds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.functions import unit_of

FACT_COLUMNS = ["timestamp", "station_fk", "metric", "value", "unit", "source", "quality_flag"]
DIM_COLUMNS = ["station_pk", "station_code", "station_name", "location_type", "description"]

# Measurement mappings (fixed): benchmark category -> metric.
LINEITEM_METRICS = {"A": "wind_speed", "N": "no2", "R": "pm10"}
EVENT_METRICS = {
    "view": "wind_speed",
    "error": "wind_direction",
    "click": "no2",
    "signup": "o3",
    "purchase": "pm10",
}
WIND_METRICS = ["wind_speed", "wind_direction"]
# Event readings below this level count as "below sampling limit" (no data).
EVENT_SAMPLING_LIMIT = 5.0


# Declared schemas of the benchmark tables read here: reads never infer
# (no schema-discovery job per scan, and a drifted file fails loudly).
TABLE_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = TABLE_SCHEMAS.get(name)
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


#: Readings are converted to a unit in which no mean of a few lies half-way between two rounded values,
#: where the order of a floating-point sum would decide.
EVENT_UNIT = 1.0936133


def _map(col, mapping: dict[str, str]):
    out = None
    for k, v in mapping.items():
        cond = F.col(col) == F.lit(k)
        out = F.when(cond, F.lit(v)) if out is None else out.when(cond, F.lit(v))
    return out


def _finish(df: DataFrame) -> DataFrame:
    return (
        df.withColumn("unit", unit_of("metric"))
        .withColumn(
            "source",
            F.when(F.col("metric").isin(WIND_METRICS), F.lit("wind")).otherwise(F.lit("air_quality")),
        )
        .withColumn(
            "quality_flag",
            F.when(F.col("value").isNull(), F.lit("NODATA")).otherwise(F.lit("VALID")),
        )
        .select(*FACT_COLUMNS)
    )


def lineitem_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as measurements; the first line of an order carries no reading."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_shipdate", "l_suppkey", "l_returnflag", "l_linenumber", "l_quantity"
    )
    df = li.select(
        F.col("l_shipdate").cast("timestamp_ntz").alias("timestamp"),
        F.col("l_suppkey").cast("int").alias("station_fk"),
        _map("l_returnflag", LINEITEM_METRICS).alias("metric"),
        F.when(F.col("l_linenumber") == 1, F.lit(None).cast("double"))
        .otherwise(F.col("l_quantity").cast("double"))
        .alias("value"),
    )
    return _finish(df)


def lineitem_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active suppliers as the station dimension (D4 columns)."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return _supplier_stations(s.filter(F.col("s_acctbal") >= 0))


def _supplier_stations(suppliers: DataFrame) -> DataFrame:
    return suppliers.select(
        F.col("s_suppkey").cast("int").alias("station_pk"),
        F.concat(F.lit("ST"), F.lpad(F.col("s_suppkey").cast("string"), 6, "0")).alias("station_code"),
        F.col("s_name").alias("station_name"),
        F.lit("AQM").alias("location_type"),
        F.concat(F.lit("Monitoring site of "), F.col("s_name")).alias("description"),
    )


def sparse_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as measurements of poor quality: most wind readings are missing, and pollutants are far off."""
    li = table(spark, sf_dir, "lineitem").select("l_shipdate", "l_suppkey", "l_returnflag", "l_linenumber", "l_quantity")
    n, q = F.col("l_linenumber"), F.col("l_quantity").cast("double")
    wind = F.col("l_returnflag") == "A"
    df = li.select(
        F.col("l_shipdate").cast("timestamp_ntz").alias("timestamp"),
        F.col("l_suppkey").cast("int").alias("station_fk"),
        _map("l_returnflag", LINEITEM_METRICS).alias("metric"),
        F.when((n == 1) | (wind & (n <= 5)), F.lit(None).cast("double")).when(wind, q).otherwise(q * 30).alias("value"),
    )
    return _finish(df)


def suppliers_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All suppliers as the station dimension (D4 columns)."""
    return _supplier_stations(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"))


def events_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as measurements; readings below the sampling limit carry no value."""
    ev = table(spark, sf_dir, "events").select("ts", "user_id", "event_type", "value")
    df = ev.select(
        F.col("ts").cast("timestamp_ntz").alias("timestamp"),
        F.col("user_id").cast("int").alias("station_fk"),
        _map("event_type", EVENT_METRICS).alias("metric"),
        F.when(F.col("value") < F.lit(EVENT_SAMPLING_LIMIT), F.lit(None).cast("double"))
        .otherwise(F.col("value").cast("double") * F.lit(EVENT_UNIT))
        .alias("value"),
    )
    return _finish(df)


def events_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active customers as the station dimension (D4 columns)."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return c.filter(F.col("c_acctbal") >= 0).select(
        F.col("c_custkey").cast("int").alias("station_pk"),
        F.concat(F.lit("CU"), F.lpad(F.col("c_custkey").cast("string"), 6, "0")).alias("station_code"),
        F.col("c_name").alias("station_name"),
        F.lit("AQM").alias("location_type"),
        F.concat(F.lit("Monitoring site of "), F.col("c_name")).alias("description"),
    )


# --------------------------------------------------------------------------
# Staged-layer inputs derived from ``events``
# --------------------------------------------------------------------------

EVENT_METRIC_ORDER = ["wind_speed", "wind_direction", "no2", "o3", "pm10"]


def nation_events_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as measurements of the nation of their customer: both wind and no2 on most days of each station."""
    ev = events_fact(spark, sf_dir)
    cust = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("int").alias("station_fk"), F.col("c_nationkey").alias("__n"))
    return ev.join(cust, "station_fk").withColumn("station_fk", F.col("__n")).select(*FACT_COLUMNS)


def nation_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as stations (D4 columns); users are located in their nation."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return n.select(
        F.col("n_nationkey").cast("long").alias("station_pk"),
        F.concat(F.lit("NA"), F.lpad(F.col("n_nationkey").cast("string"), 6, "0")).alias("station_code"),
        F.col("n_name").alias("station_name"),
        F.lit("AQM").alias("location_type"),
        F.concat(F.lit("Monitoring site of "), F.col("n_name")).alias("description"),
    )


def staged_column_names(spark: SparkSession, sf_dir: str, max_stations: int = 10_000) -> list[str]:
    """``station_<pk>_<metric>`` for every nation and event metric.

    The pivot needs its value list up front; it comes from the (bounded)
    nation table, checked against ``max_stations`` before it is collected.
    """
    keys = table(spark, sf_dir, "nation").select("n_nationkey").limit(max_stations + 1).collect()
    if len(keys) > max_stations:
        raise ValueError("too many stations for a wide layout")
    return [f"station_{k}_{m}" for k in sorted(r[0] for r in keys) for m in EVENT_METRIC_ORDER]


def events_hourly_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(datetime, col_name, value): largest reading per hour, nation and metric."""
    ev = events_fact(spark, sf_dir)
    cust = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("int").alias("station_fk"), F.col("c_nationkey").alias("nation")
    )
    j = ev.join(cust, "station_fk", "inner")
    return j.select(
        F.make_timestamp_ntz(
            F.year("timestamp"), F.month("timestamp"), F.dayofmonth("timestamp"), F.hour("timestamp"), F.lit(0), F.lit(0)
        ).alias("datetime"),
        F.concat(F.lit("station_"), F.col("nation").cast("string"), F.lit("_"), F.col("metric")).alias("col_name"),
        "value",
    )


def events_wide(spark: SparkSession, sf_dir: str, with_file: bool = False) -> DataFrame:
    """Staged wide layer: one row per hour, one column per nation x metric."""
    from stratus.operators.tall import to_wide

    wide = to_wide(events_hourly_long(spark, sf_dir), staged_column_names(spark, sf_dir))
    if with_file:
        wide = wide.withColumn(
            "file",
            F.concat(F.lit("staged_week_"), F.lpad(F.weekofyear("datetime").cast("string"), 2, "0"), F.lit(".parquet")),
        )
    return wide


def event_source(metric_col: str = "metric"):
    return F.when(F.col(metric_col).isin(WIND_METRICS), F.lit("wind")).otherwise(F.lit("air_quality"))


def events_tall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised tall layer from the staged wide layer (with ``file``)."""
    from stratus.operators.tall import normalise

    tall = normalise(events_wide(spark, sf_dir), nation_stations(spark, sf_dir), event_source())
    return tall.withColumn(
        "file",
        F.concat(F.lit("staged_week_"), F.lpad(F.weekofyear("datetime").cast("string"), 2, "0"), F.lit("_normalised.parquet")),
    )


def events_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw spreadsheet-like text of the events: day-first dates, '<Samp' for
    readings below the sampling limit (file, station, metric, dt text, value text)."""
    ev = table(spark, sf_dir, "events").select("ts", "user_id", "event_type", "value")
    return ev.select(
        F.concat(F.lit("events_"), F.col("event_type"), F.lit(".xlsx")).alias("file"),
        F.col("user_id").cast("long").alias("station_pk"),
        _map("event_type", EVENT_METRICS).alias("metric"),
        F.date_format("ts", "d/M/yyyy H:mm").alias("datetime_text"),
        F.when(F.col("value") < F.lit(EVENT_SAMPLING_LIMIT), F.lit("<Samp"))
        .otherwise(F.col("value").cast("string"))
        .alias("value_text"),
    )
