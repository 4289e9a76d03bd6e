"""Integrity, data-quality and coverage reports.

Every report is one lazy DataFrame. Reports over the fact aggregate first and
join afterwards: groups are few (metrics, sources, stations, flags), so the
shuffle after the map-side partial aggregation carries a handful of rows per
task no matter how many measurements there are, and a hot metric or station
costs nothing extra. Windows only ever run over such aggregated frames.
Distinct counts over time are computed from an hour-grain pre-aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratus.functions import BITMAP_DAYS, bitmap_of_days, bitmap_of_hours, bucket_of, count_if, day_number, duck_round, pct, trunc_ts
from stratus.operators.stats import with_quantiles
from stratus.plans import with_station
from stratus.schemas import DQ_EXPECTED_RANGES, NATURAL_KEY


def _scalar(df: DataFrame) -> Column:
    """A one-row, one-column aggregate as a scalar subquery column."""
    return df.scalar()


# ---------------------------------------------------------------- A0, A16, A1


def total(df: DataFrame, name: str = "total_rows") -> DataFrame:
    """A0: row count."""
    return df.agg(F.count(F.lit(1)).alias(name))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for each named table."""
    parts = [t.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
             for n, t in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def counts_by(fact: DataFrame, *keys: str, order: str = "count_desc") -> DataFrame:
    """A1: row counts per key; ordered by count (desc) or by key."""
    g = fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    if order == "count_desc":
        return g.orderBy(F.desc("count"), *[F.asc_nulls_last(k) for k in keys])
    return g.orderBy(*[F.asc_nulls_last(k) for k in keys])


def counts_by_metric(fact: DataFrame, top: int | None = None) -> DataFrame:
    """A2: count, first and last timestamp per metric, largest first."""
    g = fact.groupBy("metric").agg(
        F.count(F.lit(1)).alias("count"),
        F.min("timestamp").alias("earliest"),
        F.max("timestamp").alias("latest"),
    ).orderBy(F.desc("count"), F.asc_nulls_last("metric"))
    return g.limit(top) if top else g


def counts_by_station(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """A3: measurements per station name (inner join) with the share of *all* rows.

    One scan: rows are counted per station key first. Orphans stay in the
    grouped frame until the total has been taken over its few rows.
    """
    per_key = fact.groupBy("station_fk").agg(F.count(F.lit(1)).alias("n"))
    known = dim.select(F.col("station_pk").alias("__pk"), "station_name")
    joined = per_key.join(known, per_key["station_fk"] == known["__pk"], "left")
    g = joined.groupBy(F.col("__pk").isNotNull().alias("__known"), "station_name").agg(F.sum("n").cast("long").alias("count"))
    all_rows = F.sum("count").over(Window.partitionBy())
    share = F.col("count").cast("double") * F.lit(100.0) / all_rows.cast("double")
    return g.withColumn("share_pct", share).filter("__known").select("station_name", "count", "share_pct").orderBy(
        F.desc("count"), F.asc_nulls_last("station_name")
    )


# ------------------------------------------------------------ A4, A5, A6, J5


def duplicate_key_groups(fact: DataFrame, keys=NATURAL_KEY) -> DataFrame:
    """Natural keys that occur more than once, with their multiplicity."""
    return fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).filter(F.col("cnt") > 1)


def duplicate_keys(fact: DataFrame, keys=NATURAL_KEY) -> DataFrame:
    """A4: number of natural-key groups with more than one row."""
    return duplicate_key_groups(fact, keys).agg(F.count(F.lit(1)).alias("dup_count"))


def required_nulls(fact: DataFrame) -> DataFrame:
    """A5: NULLs in the required columns, one pass."""
    return fact.agg(
        count_if(F.col("timestamp").isNull()).alias("null_timestamps"),
        count_if(F.col("station_fk").isNull()).alias("null_stations"),
        count_if(F.col("metric").isNull()).alias("null_metrics"),
        count_if(F.col("source").isNull()).alias("null_sources"),
    )


def value_stats(fact: DataFrame) -> DataFrame:
    """NULL / non-NULL values and NODATA / VALID flags."""
    return fact.agg(
        count_if(F.col("value").isNull()).alias("null_values"),
        count_if(F.col("value").isNotNull()).alias("valid_values"),
        count_if(F.col("quality_flag") == "NODATA").alias("nodata_flags"),
        count_if(F.col("quality_flag") == "VALID").alias("valid_flags"),
    )


def orphans(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Fact rows whose station is not in the dimension (NOT EXISTS)."""
    keys = dim.select(F.col("station_pk").alias("__pk"))
    return fact.join(keys, fact["station_fk"] == keys["__pk"], "left_anti")


def orphan_count(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """J5 as the integrity check reports it.

    The fact is reduced to one row per station key before the anti join, so
    the join never sees more rows than there are distinct stations.
    """
    per_key = fact.groupBy("station_fk").agg(F.count(F.lit(1)).alias("n"))
    return orphans(per_key, dim).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("orphan_count"))


def integrity(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Orphans, duplicate keys and required NULLs with the overall verdict.

    One scan: rows are counted per natural key, the keys added up per station,
    and the few station rows meet the dimension.
    """
    per_key = fact.groupBy(*NATURAL_KEY).agg(F.count(F.lit(1)).alias("n"))
    missing = {"null_timestamps": "timestamp", "null_stations": "station_fk", "null_metrics": "metric", "null_sources": "source"}
    n = F.col("n")
    per_station = per_key.groupBy(F.col("station_fk").alias("__s")).agg(
        F.sum("n").alias("rows"),
        count_if(n > 1).alias("duplicate_keys"),
        *[F.sum(F.when(F.col(c).isNull(), n)).alias(name) for name, c in missing.items()],
    )
    known = dim.select(F.col("station_pk").alias("__pk")).distinct()
    joined = per_station.join(known, per_station["__s"] == known["__pk"], "left")
    count = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    counts = {"orphan_measurements": F.when(F.col("__pk").isNull(), F.col("rows"))} | {c: F.col(c) for c in ("duplicate_keys", *missing)}
    out = joined.agg(*[count(c).alias(name) for name, c in counts.items()])
    ok = F.lit(True)
    for c in counts:
        ok = ok & (F.col(c) == 0)
    return out.withColumn("integrity_ok", ok)


# ------------------------------------------------------------ A8, A9, A12, A13


def _null_agg(value_col: str = "value") -> list[Column]:
    nulls = count_if(F.col(value_col).isNull())
    return [
        F.count(F.lit(1)).alias("total"),
        nulls.alias("nulls"),
        pct(nulls, F.count(F.lit(1))).alias("null_pct"),
    ]


def null_rates(fact: DataFrame, dim: DataFrame | None = None, by: str | None = None) -> DataFrame:
    """Null share overall (by=None), per metric (by='metric') or per station
    name (by='station', inner join with the dimension). 0 for an empty input."""
    if by is None:
        return fact.agg(*_null_agg())
    if by == "metric":
        return fact.groupBy("metric").agg(*_null_agg()).orderBy(F.desc("null_pct"), F.asc_nulls_last("metric"))
    if by == "station":
        per_key = fact.groupBy("station_fk").agg(
            F.count(F.lit(1)).alias("t"), count_if(F.col("value").isNull()).alias("z")
        )
        g = with_station(per_key, dim).groupBy("station_name").agg(
            F.sum("t").cast("long").alias("total"), F.sum("z").cast("long").alias("nulls")
        )
        return g.withColumn("null_pct", pct("nulls", "total")).orderBy(
            F.desc("null_pct"), F.asc_nulls_last("station_name")
        )
    raise ValueError(by)


def high_null_metrics(fact: DataFrame, threshold: float = 50.0) -> DataFrame:
    """Metrics whose *rounded* null percentage exceeds the threshold."""
    return null_rates(fact, by="metric").filter(F.col("null_pct") > F.lit(threshold))


def low_quality_metrics(fact: DataFrame, threshold: float = 50.0) -> DataFrame:
    """Metrics whose *unrounded* NODATA share exceeds the threshold."""
    nodata = count_if(F.col("quality_flag") == "NODATA")
    g = fact.groupBy("metric").agg(
        nodata.alias("nodata"),
        F.count(F.lit(1)).alias("total"),
        pct(nodata, F.count(F.lit(1)), digits=None).alias("__raw"),
    )
    return (
        g.filter(F.col("__raw") > F.lit(threshold))
        .select("metric", "nodata", "total", duck_round("__raw", 2).alias("nodata_pct"))
        .orderBy(F.desc("nodata_pct"), F.asc_nulls_last("metric"))
    )


def dq_summary(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Totals, station count and null share in one row."""
    nulls = count_if(F.col("value").isNull())
    agg = fact.agg(
        F.count(F.lit(1)).alias("total_measurements"),
        nulls.alias("null_values"),
        count_if(F.col("value").isNotNull()).alias("valid_values"),
        pct(nulls, F.count(F.lit(1))).alias("null_percentage"),
    )
    return agg.select(
        "total_measurements",
        _scalar(dim.agg(F.count(F.lit(1)))).alias("total_stations"),
        "null_values",
        "valid_values",
        "null_percentage",
    )


# ------------------------------------------------------------------------ A10


def _ranges_map(ranges) -> tuple[Column, Column]:
    lo, hi = [], []
    for metric, mn, mx in ranges:
        lo += [F.lit(metric), F.lit(float(mn))]
        hi += [F.lit(metric), F.lit(float(mx))]
    return F.create_map(*lo), F.create_map(*hi)


def value_ranges(fact: DataFrame, ranges=DQ_EXPECTED_RANGES) -> DataFrame:
    """A10: per checked metric: counts, min, max, mean, exact median and the
    number of values below / above the expected range.

    Two passes replace one scan per metric: the first has all statistics and a
    sketch per metric, the second the exact median among the few values that the
    sketch leaves (``stats.with_quantiles``), so a metric with most of the
    readings is spread over many tasks. The expected ranges are a literal map (a
    handful of entries), looked up per row; metrics outside the list or without
    rows produce no output row.
    """
    lo_map, hi_map = _ranges_map(ranges)
    checked = [m for m, _, _ in ranges]
    f = fact.filter(F.col("metric").isin(checked)).select("metric", F.col("value").cast("double").alias("v"))
    lo, hi = F.element_at(lo_map, F.col("metric")), F.element_at(hi_map, F.col("metric"))
    stats = with_quantiles(
        f, ["metric"], "v", [0.5], ["median"],
        duck_round(F.avg("v"), 2).alias("avg"),
        count_if(F.col("v") < lo).alias("below_min"),
        count_if(F.col("v") > hi).alias("above_max"),
        few_groups=True,
    )
    return stats.select(
        "metric", F.col("__rows").alias("total"), F.col("__n").alias("non_null"), F.col("__min").alias("min"),
        F.col("__max").alias("max"), "avg", "median", "below_min", "above_max", lo.alias("expected_min"),
        hi.alias("expected_max"),
    )


def outliers_exist(fact: DataFrame, ranges=DQ_EXPECTED_RANGES) -> DataFrame:
    return value_ranges(fact, ranges).agg(
        F.coalesce(F.max((F.col("below_min") > 0) | (F.col("above_max") > 0)), F.lit(False)).alias("outliers_exist")
    )


# ------------------------------------------------------------------------ A11


#: Levels of the coverage report: name and the columns it groups by.
COVERAGE_LEVELS = {"overall": (), "source": ("source",), "metric": ("metric",)}


def _time_bitmaps(fact: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """One row per key and bucket of 1024 days: its hours and days as bitmaps, first and last timestamp.

    The bitmaps (4 KB each) merge map-side, so the shuffle carries a few rows per task, and a hot key no more
    than any other.
    """
    return fact.groupBy(*by, bucket_of(day_number("timestamp"), BITMAP_DAYS).alias("__b")).agg(
        bitmap_of_hours("timestamp").alias("__hours"), bitmap_of_days("timestamp").alias("__days"),
        F.min("timestamp").alias("__lo"), F.max("timestamp").alias("__hi"),
    )


def _merged(maps: DataFrame, by: list[str]) -> list[Column]:
    return [
        F.min("__lo").alias("earliest"),
        F.max("__hi").alias("latest"),
        F.sum(F.bitmap_count("__days")).cast("long").alias("days"),
        F.sum(F.bitmap_count("__hours")).cast("long").alias("hours"),
    ]


def coverage(fact: DataFrame, by: tuple[str, ...] = (), hours: bool | None = None) -> DataFrame:
    """first/last timestamp, distinct days (and hours when ungrouped)."""
    maps = _time_bitmaps(fact, by)
    g = maps.groupBy(*by).agg(*_merged(maps, list(by)))
    if hours if hours is not None else not by:
        g = g.withColumn("hours_covered", F.coalesce("hours", F.lit(0).cast("long")))
    g = g.withColumn("days", F.coalesce("days", F.lit(0).cast("long"))).drop("hours")
    return g.orderBy(*[F.asc_nulls_last(k) for k in by]) if by else g.withColumnRenamed("days", "days_covered")


def coverage_levels(fact: DataFrame) -> DataFrame:
    """A11 as one report: coverage overall, by source and by metric, from one scan.

    Bitmaps per (source, metric, bucket) are merged to every level by ``GROUPING SETS``; the counts of the
    merged bitmaps are the distinct days and hours. A level's row names its key (NULL overall).
    """
    maps = _time_bitmaps(fact, ("source", "metric"))
    sets = [[*keys, "__b"] for keys in COVERAGE_LEVELS.values()]
    level = F.grouping_id("source", "metric", "__b").alias("__level")
    g = maps.groupingSets([[F.col(c) for c in s] for s in sets], "source", "metric", "__b").agg(
        level, F.bitmap_or_agg("__hours").alias("__hours"), F.bitmap_or_agg("__days").alias("__days"),
        F.min("__lo").alias("__lo"), F.max("__hi").alias("__hi"),
    )
    # grouping_id has a bit for each column left out: source is the highest of three
    name = F.when(F.col("__level") == 6, "overall").when(F.col("__level") == 2, "source").otherwise("metric")
    key = F.when(F.col("__level") == 2, F.col("source")).when(F.col("__level") == 4, F.col("metric"))
    return g.groupBy(name.alias("level"), key.alias("key")).agg(*_merged(g, ["level", "key"])).orderBy(
        "level", F.asc_nulls_last("key")
    )


# ------------------------------------------------------------------------ A14


def dq_issues(fact: DataFrame, ranges=DQ_EXPECTED_RANGES) -> DataFrame:
    """The issue list of the full quality report, one row per issue.

    Everything derives from one per-metric aggregate (a few rows), so the fact
    is scanned once; the individual tests run on that small frame.
    """
    lo_map, hi_map = _ranges_map(ranges)
    v = F.col("value").cast("double")
    per_metric = fact.groupBy("metric").agg(
        F.count(F.lit(1)).alias("total"),
        count_if(v.isNull()).alias("nulls"),
        count_if(F.col("quality_flag") == "NODATA").alias("nodata"),
        count_if(v < F.element_at(lo_map, F.col("metric"))).alias("below"),
        count_if(v > F.element_at(hi_map, F.col("metric"))).alias("above"),
    )
    overall = per_metric.agg(
        pct(F.sum("nulls"), F.sum("total")).alias("null_pct"),
    )
    by_metric = per_metric.withColumn("null_pct", pct("nulls", "total")).withColumn(
        "nodata_raw", pct("nodata", "total", digits=None)
    )
    high = by_metric.filter(F.col("null_pct") > 50.0)
    high_list = high.agg(
        F.array_join(
            F.transform(
                F.sort_array(F.collect_list(F.struct(-F.col("null_pct"), F.col("metric")))),
                lambda s: s.getField("metric"),
            ),
            ", ",
        ).alias("names"),
        F.count(F.lit(1)).alias("n"),
    )
    ranged = by_metric.filter(F.col("metric").isin([m for m, _, _ in ranges]))
    outl = ranged.agg(count_if((F.col("below") > 0) | (F.col("above") > 0)).alias("n"))
    lowq = by_metric.agg(count_if(F.col("nodata_raw") > 50.0).alias("n"))
    parts = [
        overall.filter(F.col("null_pct") > 30.0).select(
            F.lit(1).alias("issue_no"),
            F.concat(F.lit("High overall null rate: "), F.col("null_pct").cast("string"), F.lit("%")).alias("issue"),
        ),
        high_list.filter(F.col("n") > 0).select(
            F.lit(2).alias("issue_no"), F.concat(F.lit("High null metrics: "), F.col("names")).alias("issue")
        ),
        outl.filter(F.col("n") > 0).select(
            F.lit(3).alias("issue_no"), F.lit("Outlier values detected outside expected ranges").alias("issue")
        ),
        lowq.filter(F.col("n") > 0).select(
            F.lit(4).alias("issue_no"),
            F.concat(F.lit("Low quality metrics detected: "), F.col("n").cast("string")).alias("issue"),
        ),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("issue_no")


# ------------------------------------------------------------------ A15, A17


def top_stations(fact: DataFrame, dim: DataFrame, k: int = 5) -> DataFrame:
    """The k stations with most measurements (name breaks ties)."""
    per_key = fact.groupBy("station_fk").agg(F.count(F.lit(1)).alias("n"))
    g = with_station(per_key, dim).groupBy("station_name").agg(
        F.sum("n").cast("long").alias("measurement_count")
    )
    return g.orderBy(F.desc("measurement_count"), F.asc_nulls_last("station_name")).limit(k)


def recent(fact: DataFrame, days: int, as_of: Column) -> DataFrame:
    """Rows at or after midnight of ``as_of - days`` (as_of is a DATE)."""
    cutoff = F.date_sub(as_of, days).cast("timestamp_ntz")
    return fact.filter(F.col("timestamp") >= cutoff)


def latest_date(fact: DataFrame) -> Column:
    """Date of the newest measurement as a scalar (reproducible 'today')."""
    return _scalar(fact.agg(F.to_date(F.max("timestamp"))))


def daily_counts(fact: DataFrame, days: int, as_of: Column | None = None) -> DataFrame:
    """Measurements per day in the last ``days`` days before ``as_of``."""
    as_of = latest_date(fact) if as_of is None else as_of
    r = recent(fact, days, as_of)
    return (
        r.groupBy(trunc_ts("timestamp", "day").alias("date"))
        .agg(F.count(F.lit(1)).alias("measurements"))
        .orderBy(F.desc("date"))
    )


def freshness(fact: DataFrame) -> DataFrame:
    """Newest timestamp."""
    return fact.agg(F.max("timestamp").alias("latest_data"))


# --------------------------------------------------------------------- J4


def station_coverage(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Every station of the dimension with its measurement count (0 when
    silent) and newest timestamp; the fact is aggregated per key first."""
    per_key = fact.groupBy("station_fk").agg(
        F.count("station_fk").alias("n"), F.max("timestamp").alias("mx")
    )
    d = dim.select("station_pk", "station_name")
    j = d.join(per_key, d["station_pk"] == per_key["station_fk"], "left")
    return (
        j.groupBy("station_name")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("measurements"), F.max("mx").alias("latest"))
        .orderBy(F.desc("measurements"), F.asc_nulls_last("station_name"))
    )


# --------------------------------------------------------------------- W1, W2


def share_of_total(fact: DataFrame, key: str = "quality_flag") -> DataFrame:
    """``COUNT(*) * 100.0 / SUM(COUNT(*)) OVER ()`` per key.

    The window runs over the grouped frame (one row per key), never over
    the fact itself.
    """
    g = fact.groupBy(key).agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy()
    return g.select(
        key, "count", pct(F.col("count"), F.sum("count").over(w)).alias("percentage")
    ).orderBy(F.desc("count"), F.asc_nulls_last(key))


def share_within(fact: DataFrame, part: str = "source", key: str = "quality_flag") -> DataFrame:
    """Share of each key inside its partition (``OVER (PARTITION BY part)``)."""
    g = fact.groupBy(part, key).agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy(part)
    return g.select(
        part, key, "count", pct(F.col("count"), F.sum("count").over(w)).alias("percentage")
    ).orderBy(F.asc_nulls_last(part), F.desc("count"), F.asc_nulls_last(key))


# ------------------------------------------------------------------------ O2


def ranked(report: DataFrame, *order: Column) -> DataFrame:
    """O2 as data: a report with each row's place in its order (a window over the report's few rows)."""
    return report.withColumn("place", F.row_number().over(Window.orderBy(*order)))
