"""Analytic reports over the star schema.

Client-side post-processing of the original notebooks (pivots, group sums,
correlations) is part of the plan here, so nothing but the final small report
reaches the driver. Pivots always receive their value list, which avoids the
extra distinct-values job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.functions import BITMAP_DAYS, BITMAP_IDS, bitmap_of_days, bitmap_of_ids, bucket_of, count_if, day_number, duck_round, trunc_ts
from stratus.operators.stats import banded, combined_moments, moments, null_safe_join, quantiles_of, sketched
from stratus.plans import with_station

SOURCES = ["air_quality", "wind"]


def _valid(fact: DataFrame) -> DataFrame:
    return fact.filter((F.col("quality_flag") == "VALID") & F.col("value").isNotNull())


# ------------------------------------------------------------------ B1, B2


def metric_coverage(fact: DataFrame) -> DataFrame:
    """B1: per source x metric: rows, distinct stations, period, distinct
    days, VALID rows and their share (1 decimal).

    One scan: days and stations are collected as bitmaps per bucket (1024 days,
    32,768 station keys), merged map-side, and OR-ed per bucket by ``GROUPING
    SETS``, so distinct counts need no expanded rows. A NULL station counts as none.
    """
    station = bucket_of("station_fk", BITMAP_IDS)
    maps = fact.groupBy(
        "source", "metric", bucket_of(day_number("timestamp"), BITMAP_DAYS).alias("__d"), station.alias("__s")
    ).agg(
        F.count(F.lit(1)).alias("__n"),
        count_if(F.col("quality_flag") == "VALID").alias("__v"),
        F.min("timestamp").alias("__lo"),
        F.max("timestamp").alias("__hi"),
        bitmap_of_days("timestamp").alias("__days"),
        bitmap_of_ids("station_fk").alias("__stations"),
    )
    keys = [F.col("source"), F.col("metric")]
    g = maps.groupingSets([[*keys, F.col("__d")], [*keys, F.col("__s")]], "source", "metric", "__d", "__s").agg(
        F.grouping("__s").alias("__by_day"),
        F.sum("__n").alias("__n"),
        F.sum("__v").alias("__v"),
        F.min("__lo").alias("__lo"),
        F.max("__hi").alias("__hi"),
        F.bitmap_or_agg("__days").alias("__days"),
        F.bitmap_or_agg("__stations").alias("__stations"),
    )
    by_day = F.col("__by_day") == 1
    g = g.groupBy("source", "metric").agg(
        F.sum(F.when(by_day, F.col("__n"))).cast("long").alias("total_measurements"),
        F.coalesce(F.sum(F.when(~by_day, F.bitmap_count("__stations"))), F.lit(0)).cast("long").alias("stations"),
        F.min("__lo").alias("earliest_date"),
        F.max("__hi").alias("latest_date"),
        F.coalesce(F.sum(F.when(by_day, F.bitmap_count("__days"))), F.lit(0)).cast("long").alias("days_covered"),
        F.sum(F.when(by_day, F.col("__v"))).cast("long").alias("valid_measurements"),
    )
    return g.withColumn(
        "valid_pct", duck_round(F.col("valid_measurements") * F.lit(100.0) / F.col("total_measurements"), 1)
    ).orderBy(F.asc_nulls_last("source"), F.asc_nulls_last("metric"))


def coverage_pivot(fact: DataFrame, sources=SOURCES) -> DataFrame:
    """B2: measurement counts as a metric x source cross-tab (0 when absent)."""
    g = fact.groupBy("metric").pivot("source", list(sources)).agg(F.count(F.lit(1)))
    return g.na.fill(0, subset=list(sources)).orderBy(F.asc_nulls_last("metric"))


def source_quality(fact: DataFrame) -> DataFrame:
    """B2: valid / invalid totals per source."""
    g = fact.groupBy("source").agg(
        F.count(F.lit(1)).alias("total_measurements"),
        count_if(F.col("quality_flag") == "VALID").alias("valid_measurements"),
    )
    return g.withColumn(
        "invalid_measurements", F.col("total_measurements") - F.col("valid_measurements")
    ).orderBy(F.asc_nulls_last("source"))


# --------------------------------------------------------------------- B3


def monthly_trends(fact: DataFrame) -> DataFrame:
    """VALID measurements per month and source."""
    v = fact.filter(F.col("quality_flag") == "VALID")
    return (
        v.groupBy(trunc_ts("timestamp", "month").alias("month"), "source")
        .agg(F.count(F.lit(1)).alias("measurements"))
        .orderBy("month", F.asc_nulls_last("source"))
    )


def monthly_pivot(fact: DataFrame, sources=SOURCES) -> DataFrame:
    """Month x source cross-tab of VALID measurements (0 when absent)."""
    v = fact.filter(F.col("quality_flag") == "VALID")
    g = v.groupBy(trunc_ts("timestamp", "month").alias("month")).pivot("source", list(sources)).agg(
        F.count(F.lit(1))
    )
    return g.na.fill(0, subset=list(sources)).orderBy("month")


# ------------------------------------------------------------------ B4, B5, B6


def pollutant_stats(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Per station x pollutant x unit: count, mean, min, max, sample stddev.

    Moments (count, mean, squared deviations) are taken per station key and
    combined per station name after the join, so the join sees one row per
    station key, pollutant and unit instead of the readings.
    """
    f = _valid(fact.filter(F.col("source") == "air_quality"))
    v = F.col("value").cast("double")
    per_key = f.groupBy("station_fk", "metric", "unit").agg(*moments(v), F.min(v).alias("__lo"), F.max(v).alias("__hi"))
    keys = ["station_name", "metric", "unit"]
    g = combined_moments(with_station(per_key, dim), keys, F.min("__lo").alias("__lo"), F.max("__hi").alias("__hi"))
    return g.select(
        *keys,
        F.col("__n").cast("long").alias("measurements"),
        duck_round("__mean", 2).alias("avg_value"),
        duck_round("__lo", 2).alias("min_value"),
        duck_round("__hi", 2).alias("max_value"),
        duck_round("__std", 2).alias("std_value"),
    ).orderBy(*[F.asc_nulls_last(k) for k in keys])


def box_stats(
    fact: DataFrame,
    dim: DataFrame,
    metrics: list[str] | None = None,
    lo: float = 0.0,
    hi: float = 500.0,
) -> DataFrame:
    """Box-plot numbers per metric x station over VALID values in [lo, hi].

    Exact quartiles (interpolated), 1.5 IQR fences, whisker ends (most extreme
    values inside the fences) and the number of points outside them. Two passes:
    the sketches of the first (``stats.sketched``) bound the quartiles, and with
    them the fences; the second counts the few values in those bands one by one
    and all others in between as one row per band gap. Whiskers and outliers are
    read off that small copy, the readings are not visited again.
    """
    f = _valid(fact)
    if metrics is not None:
        f = f.filter(F.col("metric").isin(metrics))
    v = F.col("value").cast("double")
    f = f.filter(v.between(lo, hi)).select("metric", "station_fk", v.alias("v"))
    j = with_station(f, dim)
    keys, probs = ["metric", "station_name"], [0.25, 0.5, 0.75]
    first = sketched(j, keys, "v", probs)
    lo1, hi1, lo3, hi3 = (F.col(c) for c in ("__lo0", "__hi0", "__lo2", "__hi2"))
    # between which values the fences can lie, with room for rounding
    ends = {"__lo3": 2.5 * lo1 - 1.5 * hi3, "__hi3": 2.5 * hi1 - 1.5 * lo3, "__lo4": 2.5 * lo3 - 1.5 * hi1, "__hi4": 2.5 * hi3 - 1.5 * lo1}
    room = {"__lo3": -1e-9, "__hi3": 1e-9, "__lo4": -1e-9, "__hi4": 1e-9}
    fenced = first.withColumns({c: x + F.lit(room[c]) * F.abs(x) for c, x in ends.items()})
    copy = banded(j, keys, "v", fenced, 5)
    q = quantiles_of(copy, keys, probs, ["q1", "median", "q3"])
    q = q.withColumn("iqr", F.col("q3") - F.col("q1")).withColumn(
        "lower_fence", F.col("q1") - F.lit(1.5) * F.col("iqr")
    ).withColumn("upper_fence", F.col("q3") + F.lit(1.5) * F.col("iqr"))
    per_group = [F.col("__n").alias("n"), "q1", "median", "q3", "iqr", "lower_fence", "upper_fence"]
    w = null_safe_join(copy, q.drop("__n"), keys)
    low, high = F.col("lower_fence"), F.col("upper_fence")
    inside = (F.col("__v") >= low) & (F.col("__top") <= high)
    outside = (F.col("__top") < low) | (F.col("__v") > high)
    sure = F.when(~inside & ~outside, F.raise_error(F.lit("a fence lies outside of its sketched band; run the query again")))
    # the per-group statistics are constant inside a group: grouping by them
    # adds no groups and keeps the plan free of a second join
    out = w.groupBy(*keys, *per_group).agg(
        F.min("__v").alias("min"),
        F.max("__top").alias("max"),
        F.min(F.when(inside, F.col("__v")).otherwise(sure.cast("double"))).alias("lower_whisker"),
        F.max(F.when(inside, F.col("__top"))).alias("upper_whisker"),
        F.coalesce(F.sum(F.when(outside, F.col("__c"))), F.lit(0)).cast("long").alias("outliers"),
    )
    # fences and outliers come from unrounded quartiles; what is reported has 6 decimals
    out = out.withColumns({c: duck_round(c, 6) for c in ("q1", "median", "q3", "iqr", "lower_fence", "upper_fence")})
    return out.select(
        *keys, "n", "min", "q1", "median", "q3", "max", "iqr", "lower_fence", "upper_fence", "lower_whisker", "upper_whisker", "outliers"
    ).orderBy(*[F.asc_nulls_last(k) for k in keys])


def wind_stats(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Per station: measurements, mean and max speed, mean direction."""
    f = _valid(fact.filter(F.col("source") == "wind"))
    v = F.col("value").cast("double")
    spd, direction = F.when(F.col("metric") == "wind_speed", v), F.when(F.col("metric") == "wind_direction", v)
    per_key = f.groupBy("station_fk").agg(
        F.count(F.lit(1)).alias("n"), F.sum(spd).alias("s"), F.count(spd).alias("sn"), F.max(spd).alias("m"),
        F.sum(direction).alias("d"), F.count(direction).alias("dn"),
    )
    g = with_station(per_key, dim).groupBy("station_name").agg(
        F.sum("n").cast("long").alias("measurements"),
        duck_round(F.try_divide(F.sum("s"), F.sum("sn").cast("double")), 2).alias("avg_wind_speed"),
        duck_round(F.max("m"), 2).alias("max_wind_speed"),
        duck_round(F.try_divide(F.sum("d"), F.sum("dn").cast("double")), 1).alias("avg_wind_direction"),
    )
    return g.orderBy(F.desc_nulls_last("avg_wind_speed"), F.asc_nulls_last("station_name"))


# ------------------------------------------------------------------ B7, B8


def shared_stations(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Stations with more than one source, with per-source counts."""
    per_key = fact.groupBy("station_fk", "source").agg(F.count(F.lit(1)).alias("n"))
    j = with_station(per_key, dim)
    g = j.groupBy("station_name").agg(
        F.count_distinct("source").alias("data_sources"),
        F.coalesce(F.sum(F.when(F.col("source") == "wind", F.col("n"))), F.lit(0)).cast("long").alias("wind_measurements"),
        F.coalesce(F.sum(F.when(F.col("source") == "air_quality", F.col("n"))), F.lit(0)).cast("long").alias(
            "air_quality_measurements"
        ),
    )
    return g.filter(F.col("data_sources") > 1).orderBy(
        F.desc("wind_measurements"), F.asc_nulls_last("station_name")
    )


def period_pairs(
    fact: DataFrame, dim: DataFrame, m1: str = "wind_speed", m2: str = "no2", grain: str = "day"
) -> DataFrame:
    """B8 data: per station and period, the means of two metrics where both exist."""
    f = _valid(fact.filter(F.col("metric").isin(m1, m2)))
    v = F.col("value").cast("double")
    one, two = F.when(F.col("metric") == m1, v), F.when(F.col("metric") == m2, v)
    per_key = f.groupBy("station_fk", trunc_ts("timestamp", grain).alias("date")).agg(
        F.sum(one).alias("s1"), F.count(one).alias("n1"), F.sum(two).alias("s2"), F.count(two).alias("n2")
    )
    g = with_station(per_key, dim).groupBy("station_name", "date").agg(
        F.try_divide(F.sum("s1"), F.sum("n1").cast("double")).alias(f"avg_{m1}"),
        F.try_divide(F.sum("s2"), F.sum("n2").cast("double")).alias(f"avg_{m2}"),
    )
    return g.filter(F.col(f"avg_{m1}").isNotNull() & F.col(f"avg_{m2}").isNotNull())


def daily_correlation(
    fact: DataFrame,
    dim: DataFrame,
    m1: str = "wind_speed",
    m2: str = "no2",
    grain: str = "day",
    min_periods: int = 10,
) -> DataFrame:
    """Pearson correlation of the per-period means of two metrics, for all
    stations in one job, reported only with more than ``min_periods`` periods.

    A station whose means of one metric never vary has no correlation: NaN, as in SQL (``corr`` itself would divide
    by zero and fail the query, also for stations of too few periods)."""
    p = period_pairs(fact, dim, m1, m2, grain)
    one, two = f"avg_{m1}", f"avg_{m2}"
    g = p.groupBy("station_name").agg(
        F.count(F.lit(1)).alias("periods"),
        F.covar_pop(one, two).alias("__cov"),
        (F.stddev_pop(one) * F.stddev_pop(two)).alias("__dev"),
    )
    r = F.when(F.col("__dev") == 0, F.lit(float("nan"))).otherwise(F.col("__cov") / F.col("__dev"))
    g = g.withColumn("__r", F.when(F.col("periods") > 1, r))
    return (
        g.filter(F.col("periods") > min_periods)
        .select("station_name", "periods", duck_round("__r", 6).alias("correlation"))
        .orderBy(F.asc_nulls_last("station_name"))
    )


# ------------------------------------------------------------------ B9-B12


def quality_assessment(fact: DataFrame) -> DataFrame:
    """Per source x metric: totals, VALID, NODATA, NULL values and VALID share."""
    g = fact.groupBy("source", "metric").agg(
        F.count(F.lit(1)).alias("total_records"),
        count_if(F.col("quality_flag") == "VALID").alias("valid_records"),
        count_if(F.col("quality_flag") == "NODATA").alias("nodata_records"),
        count_if(F.col("value").isNull()).alias("null_values"),
    )
    return g.withColumn(
        "valid_percentage", duck_round(F.col("valid_records") * F.lit(100.0) / F.col("total_records"), 1)
    ).orderBy(F.desc("valid_percentage"), F.asc_nulls_last("source"), F.asc_nulls_last("metric"))


def overall_quality(fact: DataFrame) -> DataFrame:
    """Grand totals and the overall VALID share, from the grouped result."""
    qa = quality_assessment(fact)
    g = qa.agg(
        F.sum("total_records").cast("long").alias("total_records"),
        F.sum("valid_records").cast("long").alias("valid_records"),
    )
    return g.withColumn(
        "overall_quality", F.try_divide(F.col("valid_records").cast("double"), F.col("total_records")) * F.lit(100.0)
    )


def high_pollution_days(
    fact: DataFrame,
    dim: DataFrame,
    metrics=("no2", "pm10"),
    threshold: float = 50.0,
    k: int = 20,
) -> DataFrame:
    """Top-k (day, station, metric) means above the threshold.

    The HAVING test is on the unrounded mean; ranking is by the rounded mean,
    then date, station and metric so the top-k is deterministic.
    """
    f = _valid(fact.filter((F.col("source") == "air_quality") & F.col("metric").isin(list(metrics))))
    v = F.col("value").cast("double")
    per_key = f.groupBy("station_fk", "metric", "unit", trunc_ts("timestamp", "day").alias("date")).agg(
        F.sum(v).alias("s"), F.count(v).alias("n")
    )
    g = with_station(per_key, dim).groupBy("date", "station_name", "metric", "unit").agg(
        F.try_divide(F.sum("s"), F.sum("n").cast("double")).alias("__m")
    )
    return (
        g.filter(F.col("__m") > F.lit(threshold))
        .select("date", "station_name", "metric", duck_round("__m", 2).alias("avg_value"), "unit")
        .orderBy(F.desc("avg_value"), "date", F.asc_nulls_last("station_name"), F.asc_nulls_last("metric"),
                 F.asc_nulls_last("unit"))
        .limit(k)
    )


def monthly_means(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Mean VALID value per month and metric (stations must exist)."""
    f = fact.filter(F.col("quality_flag") == "VALID")
    per_key = f.groupBy(trunc_ts("timestamp", "month").alias("month"), "metric", "station_fk").agg(
        F.sum(F.col("value").cast("double")).alias("s"), F.count("value").alias("c")
    )
    j = with_station(per_key, dim, columns=())
    g = j.groupBy("month", "metric").agg(F.sum("s").alias("s"), F.sum("c").alias("c"))
    return g.select("month", "metric", F.try_divide(F.col("s"), F.col("c")).alias("avg_value")).orderBy(
        "month", F.asc_nulls_last("metric")
    )


def station_performance(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Total and VALID measurements per station."""
    per_key = fact.groupBy("station_fk").agg(
        F.count(F.lit(1)).alias("t"), count_if(F.col("quality_flag") == "VALID").alias("v")
    )
    g = with_station(per_key, dim).groupBy("station_name").agg(
        F.sum("t").cast("long").alias("total_measurements"), F.sum("v").cast("long").alias("valid")
    )
    return g.orderBy(F.asc_nulls_last("station_name"))


# --------------------------------------------------------------------- J8


def latest(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """The newest measurement(s) of every station x metric, ties kept.

    Equivalent to the correlated ``ts = (SELECT MAX(ts) ...)`` form: the
    maxima are a partial aggregate (one row per station x metric, so a hot
    station never lands in one task) and are joined back to the fact, broadcast
    or shuffled as their size at run time allows.
    """
    mx = fact.groupBy("station_fk", "metric").agg(F.max("timestamp").alias("__mx"))
    f = fact.join(mx, ["station_fk", "metric"], "inner").filter(F.col("timestamp") == F.col("__mx"))
    j = with_station(f, dim)
    return j.select("station_name", "metric", "value", "unit", "timestamp").orderBy(
        F.asc_nulls_last("station_name"), F.asc_nulls_last("metric"), F.desc_nulls_last("timestamp")
    )
