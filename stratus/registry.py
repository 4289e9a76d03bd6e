"""Registered queries: one per inventory operator that yields a table.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
*whole* benchmark tables (see ``stratus.sources.drivertables`` for how
measurements are projected from them). ``stratus.oracle`` holds the matching
independent SQL for DuckDB.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from stratus import schemas
from stratus.functions import metric_from_param, pollutant_from_filename, to_fact_value
from stratus.operators import analytics as B
from stratus.operators import clean as P
from stratus.operators import load as L
from stratus.operators import profile as E
from stratus.operators import quality as A
from stratus.operators import tall as TL
from stratus.operators import views as V
from stratus.session import checkpoint_dir
from stratus.sources import reference, sheets
from stratus.sources.files import read_layer, with_source
from stratus.sources.drivertables import (
    EVENT_METRIC_ORDER,
    event_source,
    events_dim,
    events_fact,
    events_hourly_long,
    events_tall,
    events_text,
    events_wide,
    lineitem_dim,
    lineitem_fact,
    nation_events_fact,
    nation_stations,
    sparse_fact,
    staged_column_names,
    suppliers_dim,
    table,
)

Query = Callable[[SparkSession, str], DataFrame]


def _li(fn) -> Query:
    return lambda spark, d: fn(lineitem_fact(spark, d), lineitem_dim(spark, d))


def _li_fact(fn) -> Query:
    return lambda spark, d: fn(lineitem_fact(spark, d))


def _ev(fn) -> Query:
    return lambda spark, d: fn(events_fact(spark, d), events_dim(spark, d))


def _ev_fact(fn) -> Query:
    return lambda spark, d: fn(events_fact(spark, d))


QUERIES: dict[str, Query] = {
    # --- integrity / quality / coverage
    "a0_total": _li_fact(lambda f: A.total(f, "total_rows")),
    "a1_counts_by_source": _li_fact(lambda f: A.counts_by(f, "source")),
    "a2_counts_by_metric": _li_fact(A.counts_by_metric),
    "a3_counts_by_station": _li(A.counts_by_station),
    "a4_duplicate_keys": _li_fact(A.duplicate_keys),
    "a5_required_nulls": _li_fact(A.required_nulls),
    "a6_value_stats": _li_fact(A.value_stats),
    "a7_integrity": _li(A.integrity),
    "a8_null_rate_overall": _li_fact(A.null_rates),
    "a8_null_rate_by_metric": _li_fact(lambda f: A.null_rates(f, by="metric")),
    "a8_null_rate_by_station": _li(lambda f, d: A.null_rates(f, d, by="station")),
    "a9_high_null_metrics": _li_fact(A.high_null_metrics),
    "a10_value_ranges": _li_fact(A.value_ranges),
    "a10_value_ranges_events": _ev_fact(A.value_ranges),
    "a11_coverage_overall": _ev_fact(A.coverage),
    "a11_coverage_by_source": _ev_fact(lambda f: A.coverage(f, ("source",))),
    "a11_coverage_levels": _ev_fact(A.coverage_levels),
    "a11_coverage_by_metric": _li_fact(lambda f: A.coverage(f, ("metric",))),
    "a12_low_quality_metrics": _li_fact(A.low_quality_metrics),
    "a13_dq_summary": lambda spark, d: A.dq_summary(lineitem_fact(spark, d), suppliers_dim(spark, d)),
    "a14_dq_issues": _li_fact(A.dq_issues),
    "a14_dq_issues_events": _ev_fact(A.dq_issues),
    "a15_top_stations": _li(A.top_stations),
    "a16_table_counts": lambda spark, d: A.table_counts(
        {"fact_measurement": lineitem_fact(spark, d), "dim_station": suppliers_dim(spark, d)}
    ),
    "a17_daily_counts": _ev_fact(lambda f: A.daily_counts(f, 7)),
    "a17_freshness": _li_fact(A.freshness),
    "j4_station_coverage": _li(A.station_coverage),
    "j5_orphan_count": _li(A.orphan_count),
    "j5_orphans": _li(lambda f, d: A.orphans(f, d)),
    "w1_share_of_total": _li_fact(A.share_of_total),
    "w2_share_within": _li_fact(A.share_within),
    # --- views
    "v2_wind": _ev(V.v_wind),
    "v3_quality": _li(V.v_quality),
    "v4_station_directory": lambda spark, d: V.station_directory(suppliers_dim(spark, d)),
    # --- analytics
    "b1_metric_coverage": _li_fact(B.metric_coverage),
    "b2_coverage_pivot": _li_fact(B.coverage_pivot),
    "b2_source_quality": _li_fact(B.source_quality),
    "b3_monthly_trends": _li_fact(B.monthly_trends),
    "b3_monthly_pivot": _li_fact(B.monthly_pivot),
    "b4_pollutant_stats": _li(B.pollutant_stats),
    "b5_box_air": _ev(lambda f, d: B.box_stats(f, d, ["no2", "o3", "pm10", "pm25", "so2"], 0.0, 500.0)),
    "b5_box_wind": _ev(lambda f, d: B.box_stats(f, d, ["wind_speed"], 0.0, 30.0)),
    "b6_wind_stats": _ev(B.wind_stats),
    "b7_shared_stations": _li(B.shared_stations),
    "b8_monthly_correlation": _li(lambda f, d: B.daily_correlation(f, d, "wind_speed", "no2", grain="month")),
    "b8_daily_correlation_events": _ev(lambda f, d: B.daily_correlation(f, d, "wind_speed", "no2", grain="day")),
    "b9_quality_assessment": _li_fact(B.quality_assessment),
    "b9_overall_quality": _li_fact(B.overall_quality),
    "b10_high_pollution_days": _ev(B.high_pollution_days),
    "b11_monthly_means": _li(B.monthly_means),
    "b12_station_performance": _li(B.station_performance),
    "j8_latest": _li(B.latest),
}


# Fixed load times used by the load operators' registered forms (any literal
# works; current-time columns are parameters, never compared).
LOAD_TIME_0 = "2024-01-01 00:00:00"
LOAD_TIME_1 = "2024-02-01 00:00:00"
# Two deliveries of the line-item feed that overlap in 1998 (a re-delivery).
FIRST_DELIVERY_END = "1999-01-01 00:00:00"
SECOND_DELIVERY_START = "1998-01-01 00:00:00"


def _ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _warehouse(spark, d):
    """Line-item measurements as warehouse fact rows (DECIMAL(12,4) values)."""
    f = lineitem_fact(spark, d)
    return f.select(
        "station_fk", "timestamp", "metric", to_fact_value(F.col("value")).alias("value"),
        "unit", "source", "quality_flag",
    )


def _deliveries(spark, d):
    """Two deliveries: rows of the overlap come again with other values, and some stations' rows have no source."""
    w = _warehouse(spark, d)
    w = w.withColumn("source", F.when(F.col("station_fk") % 10 != 3, F.col("source")))
    later = w.withColumn("value", (F.col("value") + F.lit("0.5").cast("decimal(12,4)")).cast("decimal(12,4)"))
    return w.filter(F.col("timestamp") < _ts(FIRST_DELIVERY_END)), later.filter(
        F.col("timestamp") >= _ts(SECOND_DELIVERY_START)
    )


def _double_value(df):
    return df.withColumn("value", F.col("value").cast("double"))


def _keyed(spark, d):
    w = _warehouse(spark, d)
    return L.assign_keys(w, w.columns, start=0)


def _clean_text(spark, d):
    t = events_text(spark, d)
    t = t.withColumn("datetime", P.to_ts(F.col("datetime_text"), P.AIR_TS_FORMATS))
    t = P.clean_values(t, "value_text", schemas.AIR_SENTINELS, "metric", P.WIND_RANGE_RULES)
    return TL.drop_untimed(t).select("file", "datetime", "station_pk", "metric", "value")


def _split(spark, d):
    return P.split_valid(_clean_text(spark, d), reference.metric_ranges(spark))


def _tall_with_files(spark, d):
    t = events_tall(spark, d)
    return t.withColumn("pollutant", F.col("metric")).withColumn("year", F.year("datetime").cast("string"))


def _years(df, max_years: int = 1000):
    rows = df.select("year").distinct().limit(max_years + 1).collect()
    if len(rows) > max_years:
        raise ValueError("too many years for a cross-tab")
    return sorted(r[0] for r in rows if r[0] is not None)


def _rows_by_pollutant_year(spark, d):
    t = _tall_with_files(spark, d)
    return E.rows_by_pollutant_year(t, _years(t))


QUERIES.update(
    {
        # --- cleaning, staging and melt
        "p9_clean_text": _clean_text,
        "p16_split_ok": lambda spark, d: _split(spark, d)[0],
        "p16_split_rejects": lambda spark, d: _split(spark, d)[1],
        "p17_fact_value": lambda spark, d: table(spark, d, "lineitem").select(
            "l_orderkey", "l_linenumber",
            to_fact_value(F.col("l_extendedprice") / F.col("l_quantity")).cast("double").alias("value"),
        ),
        "p18_valid_air_between": _ev_fact(
            lambda f: P.value_between(P.metrics_in(P.for_source(P.valid_only(f), "air_quality"), ["no2", "pm10"]), 0, 500)
        ),
        "p19_recent": _li_fact(lambda f: A.recent(f, 30, A.latest_date(f))),
        "s8_with_source": lambda spark, d: with_source(read_layer(spark, d, "events.parquet")),
        "p12_to_wide": lambda spark, d: TL.to_wide(events_hourly_long(spark, d), staged_column_names(spark, d)),
        "p13_melt": lambda spark, d: TL.melt(events_wide(spark, d)),
        "p15_normalise": lambda spark, d: TL.normalise(events_wide(spark, d), nation_stations(spark, d), event_source()),
        "j1_missing_metadata": lambda spark, d: TL.missing_metadata(
            TL.normalise(events_wide(spark, d), nation_stations(spark, d), event_source())
        ),
        "j2_duplicate_station_keys": lambda spark, d: TL.duplicate_station_keys(suppliers_dim(spark, d)),
        # --- load
        "l1_merge_dim": lambda spark, d: L.merge_dim(
            events_dim(spark, d),
            table(spark, d, "supplier").select(
                F.col("s_suppkey").cast("int").alias("station_pk"),
                F.concat(F.lit("ST"), F.lpad(F.col("s_suppkey").cast("string"), 6, "0")).alias("station_code"),
                F.col("s_name").alias("station_name"),
                F.lit("AQM").alias("location_type"),
                F.concat(F.lit("Monitoring site of "), F.col("s_name")).alias("description"),
            ),
        ),
        "l2_upsert_fact": lambda spark, d: _double_value(L.upsert_fact(*_deliveries(spark, d))),
        "j6_replaced_rows": lambda spark, d: _double_value(L.replaced_rows(*_deliveries(spark, d))),
        "u4_batch_keys": lambda spark, d: L.batch_keys(_deliveries(spark, d)[1]),
        "l4_fact_load_stats": lambda spark, d: L.fact_load_stats(*_deliveries(spark, d)),
        "l7_replace_range": lambda spark, d: _double_value(L.replace_range(*_deliveries(spark, d))),
        "l5_assign_keys": lambda spark, d: _double_value(_keyed(spark, d)),
        "l6_seed_dim": lambda spark, d: L.seed_dim(suppliers_dim(spark, d), _ts(LOAD_TIME_0)).drop(
            "latitude", "longitude", "elevation"
        ),
        "l3_upsert_dim": lambda spark, d: L.upsert_dim(
            L.seed_dim(events_dim(spark, d), _ts(LOAD_TIME_0)),
            table(spark, d, "supplier").select(
                F.col("s_suppkey").cast("int").alias("station_pk"),
                F.concat(F.lit("ST"), F.lpad(F.col("s_suppkey").cast("string"), 6, "0")).alias("station_code"),
                F.col("s_name").alias("station_name"),
                F.lit("AQM").alias("location_type"),
                F.concat(F.lit("Monitoring site of "), F.col("s_name")).alias("description"),
            ),
            _ts(LOAD_TIME_1),
        ).drop("latitude", "longitude", "elevation"),
        "v1_measurements": lambda spark, d: _double_value(
            V.v_measurements(_keyed(spark, d).withColumn("created_at", _ts(LOAD_TIME_0)), lineitem_dim(spark, d),
                             ordered=False)
        ),
        # --- profiling
        "e1_file_overview": lambda spark, d: E.file_overview(events_wide(spark, d, with_file=True)),
        "e2_wide_coverage": lambda spark, d: E.wide_coverage(
            events_wide(spark, d, with_file=True), nation_stations(spark, d)
        ),
        "e3_unmapped_stations": lambda spark, d: E.unmapped_stations(
            lineitem_fact(spark, d).withColumnRenamed("station_fk", "station_pk"), lineitem_dim(spark, d)
        ),
        "e4_completeness": lambda spark, d: E.completeness(events_tall(spark, d)),
        "e5_missing_by_column": lambda spark, d: E.missing_by_column(events_wide(spark, d)).select(
            "column", "pct_missing"
        ),
        "e6_describe_numeric": lambda spark, d: E.describe_numeric(table(spark, d, "lineitem"), digits=6),
        "e7_tall_overview": lambda spark, d: E.tall_overview(events_tall(spark, d)),
        "e8_valid_coverage": lambda spark, d: E.valid_coverage(events_tall(spark, d), nation_stations(spark, d)),
        "e9_mean_pivot": lambda spark, d: E.mean_pivot(events_tall(spark, d), EVENT_METRIC_ORDER),
        "e10_nodata_rate": lambda spark, d: E.nodata_rate(events_tall(spark, d)),
        "e11_pollutant_summary": lambda spark, d: E.pollutant_summary(events_tall(spark, d)),
        "e12_flag_counts": lambda spark, d: E.flag_counts(events_tall(spark, d)),
        "e13_rows_by_pollutant_year": _rows_by_pollutant_year,
        "e13_files_by_year_pollutant": lambda spark, d: E.files_by_year_pollutant(
            _tall_with_files(spark, d).select("file", "pollutant", "year").distinct(), EVENT_METRIC_ORDER
        ),
        "a2_top10_metrics": _li_fact(lambda f: A.counts_by_metric(f, top=10)),
        "e13_mean_station_count": lambda spark, d: E.mean_station_count(_tall_with_files(spark, d)),
        "e14_missing_datasets": lambda spark, d: E.missing_datasets(
            _tall_with_files(spark, d),
            spark.createDataFrame(schemas.EXPECTED_DATASETS, "pollutant string, year string"),
        ),
        "e15_station_overlap": _li_fact(
            lambda f: E.station_overlap(
                f.filter(F.col("source") == "wind").select(F.col("station_fk").alias("station_pk")),
                f.filter(F.col("source") == "air_quality").select(F.col("station_fk").alias("station_pk")),
            )
        ),
        "e16_dim_profile": lambda spark, d: E.dim_profile(suppliers_dim(spark, d)),
        "u1_union_all": _ev_fact(
            lambda f: E.union_all(
                f.filter(F.col("source") == "wind").withColumn("year", F.year("timestamp").cast("string")),
                f.filter(F.col("source") != "wind"),
            )
        ),
    }
)


def _sparse(fn) -> Query:
    return lambda spark, d: fn(sparse_fact(spark, d))


def _raw_readings(spark: SparkSession, d: str) -> DataFrame:
    """Readings as sheets give them, nothing dropped: some without date, station or metric, some out of range."""
    df = sheets.lines(spark, d, "readings", F.sort_array(F.collect_list(F.struct("p_type"))))
    df = df.select("*", F.explode("of_part").alias("part")).select("*", "part.p_type")  # a reading for each row of a part
    tax, disc = F.round(F.col("l_tax") * 100).cast("int"), F.round(F.col("l_discount") * 100).cast("int")
    metrics = {"ECONOMY": "wind_direction", "LARGE": "wind_speed", "STANDARD": "no2", "SMALL": "pm10", "MEDIUM": "noise"}
    known = sheets.register(spark, d).select("station_pk")
    df = df.join(known, df["l_suppkey"] == known["station_pk"], "left")
    metric = F.create_map(*[F.lit(x) for kv in metrics.items() for x in kv])
    return df.select(
        F.col("o_orderkey").alias("l_orderkey"),
        "l_linenumber",
        F.when(tax != 7, F.col("l_shipdate")).alias("datetime"),
        "station_pk",
        F.element_at(metric, F.col("p_type")).alias("metric"),
        F.when(disc == 5, -F.col("l_quantity")).when(disc != 7, F.col("l_quantity") * 10).alias("value"),
    )


def _reference(spark: SparkSession, d: str) -> reference.Reference:
    """A reference file made from the tables, written as JSON lines and read with the declared schema.

    Stations are suppliers with two aliases each; a metric's valid range leaves 2 off the readings of the events
    at either end, its expected range 5.
    """
    path = f"{checkpoint_dir(spark)}/reference-{uuid.uuid4().hex}"
    s = suppliers_dim(spark, d)
    names = F.array("station_name", F.concat("station_name", F.lit(" AQM Site")))
    station = F.struct("station_pk", "station_code", "station_name", names.alias("normalised_names"), "location_type", "description")
    s.select(F.array(station).alias("stations")).write.json(f"{path}/stations")
    lo, hi = F.min("value"), F.max("value")
    m = events_fact(spark, d).groupBy("metric").agg((lo + 2).alias("a"), (hi - 2).alias("b"), (lo + 5).alias("min"), (hi - 5).alias("max"))
    metric = F.struct(F.col("metric").alias("metric_code"), F.upper("metric").alias("metric_name"), F.array("a", "b").alias("valid_range"))
    m.select(F.array(metric).alias("metrics"), F.array(F.struct("metric", "min", "max")).alias("expected_ranges")).write.json(f"{path}/metrics")
    return reference.read_reference(spark, f"{path}/*", multiline=False)


def _ruled(spark: SparkSession, d: str) -> DataFrame:
    """P11 with the rules of a file: readings left per metric."""
    f = events_fact(spark, d)
    value = P.apply_range_rules(F.col("metric"), F.col("value"), _reference(spark, d).range_rules())
    return f.groupBy("metric").agg(F.count("value").alias("readings"), F.count(value).alias("kept"))


def _fact_by_file(spark: SparkSession, d: str) -> DataFrame:
    """Measurements as rows of yearly files, without what tells equal readings apart."""
    f = lineitem_fact(spark, d)
    name = F.concat(F.lit("facts_"), F.year("timestamp").cast("string"), F.lit(".parquet"))
    return f.select(name.alias("file"), "timestamp", "station_fk", "metric", "value")


def _tall_names(f: DataFrame) -> DataFrame:
    return f.withColumnsRenamed({"timestamp": "datetime", "station_fk": "station_pk"})


def _tall_facts(spark: SparkSession, d: str) -> DataFrame:
    """The normalised layer made of all line items: yearly files, stations of the register, orphans without metadata."""
    f = _tall_names(lineitem_fact(spark, d))
    file = F.concat(F.lit("facts_"), F.year("datetime").cast("string"), F.lit("_normalised.parquet"))
    return TL.with_station_meta(f, lineitem_dim(spark, d)).withColumn("file", file).withColumn("pollutant", F.col("metric"))


def _on_tall(fn) -> Query:
    return lambda spark, d: fn(_tall_facts(spark, d))


def _renamed_again(spark: SparkSession, d: str) -> DataFrame:
    """A batch that holds every third station a second time, under another name."""
    once = suppliers_dim(spark, d)
    again = once.filter(F.col("station_pk") % 3 == 0).withColumn("station_name", F.concat(F.lit("again "), F.col("station_name")))
    return once.unionByName(again)


def _special_values(spark: SparkSession, d: str) -> DataFrame:
    """P17 on values that no decimal holds: NaN and both infinities become NULL, the others are narrowed."""
    n, q = F.col("l_linenumber"), F.col("l_extendedprice") / F.col("l_quantity")
    special = {1: "nan", 2: "inf", 3: "-inf"}
    value = F.when(n == 4, -q).otherwise(q)
    for k, v in special.items():
        value = F.when(n == k, F.lit(float(v))).otherwise(value)
    t = table(spark, d, "lineitem")
    return t.select("l_orderkey", "l_linenumber", to_fact_value(value).cast("double").alias("value"))


def _expected_years(f: DataFrame) -> DataFrame:
    """The datasets of 1994-2002 of all metrics that occur; not all years do."""
    years = F.explode(F.array(*[F.lit(str(y)) for y in range(1994, 2003)]))
    return f.select(F.col("metric").alias("pollutant")).distinct().withColumn("year", years)


def _supplier_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").cast("int").alias("station_pk"),
        F.concat(F.lit("ST"), F.lpad(F.col("s_suppkey").cast("string"), 6, "0")).alias("station_code"),
        F.col("s_name").alias("station_name"),
        F.lit("AQM").alias("location_type"),
        F.concat(F.lit("Monitoring site of "), F.col("s_name")).alias("description"),
    )


def _dim_stats(spark: SparkSession, d: str) -> DataFrame:
    batch = _supplier_batch(spark, d)
    return L.dim_load_stats(L.upsert_dim(L.seed_dim(events_dim(spark, d), _ts(LOAD_TIME_0)), batch, _ts(LOAD_TIME_1)), batch)


def _keep_one(keep: str):
    columns = ["l_orderkey", "l_shipdate", "l_linenumber", "l_suppkey", "l_quantity"]
    return lambda spark, d: E.dedupe_by_key(
        table(spark, d, "lineitem").select(*columns), ["l_orderkey"], [F.col("l_shipdate"), F.col("l_linenumber")], keep
    )


QUERIES.update(
    {
        # --- poor data: every check has something to report
        "a9_high_null_sparse": _sparse(A.high_null_metrics),
        "a12_low_quality_sparse": _sparse(A.low_quality_metrics),
        "a14_dq_issues_sparse": _sparse(A.dq_issues),
        "j1_missing_metadata_facts": lambda spark, d: TL.missing_metadata(
            TL.with_station_meta(_tall_names(lineitem_fact(spark, d)), lineitem_dim(spark, d))
        ),
        "j2_duplicate_nations": lambda spark, d: TL.duplicate_station_keys(table(spark, d, "customer"), ("c_nationkey",)),
        "b8_daily_correlation_nations": lambda spark, d: B.daily_correlation(
            nation_events_fact(spark, d), nation_stations(spark, d), "wind_speed", "no2", grain="day"
        ),
        "e1_file_overview_facts": lambda spark, d: E.file_overview(_fact_by_file(spark, d)),
        "e14_missing_years": lambda spark, d: E.missing_datasets(
            lineitem_fact(spark, d).select(F.col("metric").alias("pollutant"), F.year("timestamp").cast("string").alias("year")),
            _expected_years(lineitem_fact(spark, d)),
        ),
        "p16_rejection_counts": lambda spark, d: P.rejection_counts(_raw_readings(spark, d), reference.metric_ranges(spark)),
        "p16_tagged_rows": lambda spark, d: P.tagged_rows(_raw_readings(spark, d), reference.metric_ranges(spark)),
        # --- profiles of a layer that grows with the tables, with stations that the register lacks
        "e4_completeness_facts": _on_tall(E.completeness),
        "e7_tall_overview_facts": _on_tall(E.tall_overview),
        "e8_valid_coverage_facts": lambda spark, d: E.valid_coverage(_tall_facts(spark, d), lineitem_dim(spark, d)),
        "e9_mean_pivot_facts": _on_tall(lambda t: E.mean_pivot(t, EVENT_METRIC_ORDER)),
        "e10_nodata_rate_facts": _on_tall(E.nodata_rate),
        "e11_pollutant_summary_facts": _on_tall(E.pollutant_summary),
        "e12_flag_counts_facts": _on_tall(E.flag_counts),
        "e13_mean_station_count_facts": _on_tall(E.mean_station_count),
        "e15_station_overlap_high": _ev_fact(
            lambda f: E.station_overlap(
                *[
                    f.filter((F.col("metric") == m) & (F.col("value") > limit)).select(F.col("station_fk").alias("station_pk"))
                    for m, limit in (("wind_speed", 250), ("pm10", 150))
                ]
            )
        ),
        "l1_merge_dim_repeated": lambda spark, d: L.merge_dim(events_dim(spark, d), _renamed_again(spark, d)),
        "l3_upsert_dim_repeated": lambda spark, d: L.upsert_dim(
            L.seed_dim(events_dim(spark, d), _ts(LOAD_TIME_0)), _renamed_again(spark, d), _ts(LOAD_TIME_1)
        ).drop("latitude", "longitude", "elevation"),
        "p17_special_values": _special_values,
        # --- order as data
        "o1_placed_facts": _li_fact(
            lambda f: TL.placed(f, ["timestamp", "station_fk", "metric", "value"]).select("timestamp", "station_fk", "metric", "value", "place")
        ),
        "o1_sortedness": _li_fact(lambda f: TL.sortedness(TL.sorted_tall(_tall_names(f), global_order=True))),
        "o2_ranked_stations": _li(
            lambda f, dim: A.ranked(A.counts_by_station(f, dim), F.desc("count"), F.asc_nulls_last("station_name"))
        ),
        # --- reference tables from a file
        "s7_station_aliases": lambda spark, d: _reference(spark, d).check().aliases(),
        "s7_range_rules": _ruled,
        "s7_value_ranges": lambda spark, d: A.value_ranges(events_fact(spark, d), _reference(spark, d).expected()),
        "s7_rejection_counts": lambda spark, d: P.rejection_counts(
            _clean_text(spark, d), reference.ranges_of(_reference(spark, d).metrics)
        ),
        # --- raw sheets (one per order): headers, names, cleaning end to end
        "p1_wind_header": lambda spark, d: P.wind_header(sheets.wind_sheets(spark, d)),
        "p2_air_header": lambda spark, d: P.air_header(sheets.air_sheets(spark, d)),
        "p3_air_layouts": lambda spark, d: P.air_layouts(sheets.air_sheets(spark, d)),
        "p5_metric_from_param": lambda spark, d: P.wind_header(sheets.wind_sheets(spark, d))
        .groupBy("param", metric_from_param(F.col("param")).alias("metric"))
        .agg(F.count(F.lit(1)).alias("columns")),
        "p6_pollutant_from_name": lambda spark, d: sheets.workbook_names(spark, d).withColumn(
            "pollutant", pollutant_from_filename(F.col("file"))
        ),
        "p7_stage_wind": lambda spark, d: P.stage_wind(sheets.wind_sheets(spark, d), sheets.register(spark, d)),
        "p8_stage_air": lambda spark, d: P.stage_air(sheets.air_sheets(spark, d), sheets.register(spark, d), F.lit("no2")),
        "j7_alias_join": lambda spark, d: P.resolve_stations(
            P.wind_header(sheets.wind_sheets(spark, d)), sheets.register(spark, d)
        )
        .groupBy("station", "station_pk")
        .agg(F.count(F.lit(1)).alias("columns")),
        "j7_unknown_stations": lambda spark, d: P.unknown_stations(
            P.wind_header(sheets.wind_sheets(spark, d)), sheets.register(spark, d)
        ),
        "l4_dim_load_stats": _dim_stats,
        "l4_rows_per_file": lambda spark, d: L.rows_per_file(with_source(read_layer(spark, d, "events.parquet"))),
        "u5_keep_first": _keep_one("first"),
        "u5_keep_last": _keep_one("last"),
    }
)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3, the data-quality summary per station x metric."""
    return QUERIES["v3_quality"](spark, sf_dir)
