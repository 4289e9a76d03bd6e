"""Profiling of the staged (wide) and normalised (tall) layers.

The notebook loops over files become one ``groupBy(file)`` each; per-column
statistics are one aggregate with one expression per column followed by an
``unpivot`` into one row per column. Quantiles are exact (distributed sort,
``stats.exact_quantiles``), never the approximate ``summary()``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.functions import count_if, duck_round, half_even_round
from stratus.operators.stats import number, with_quantiles


def _pct2(num: Column, den: Column) -> Column:
    return F.when(den == 0, F.lit(0.0)).otherwise(half_even_round(num.cast("double") / den.cast("double") * 100.0, 2))


# ---------------------------------------------------------------------- E1


def row_prints(columns: list[str]) -> tuple[Column, Column]:
    """Two independent 64-bit prints of a row; NULLs count by their place."""
    nulls = F.concat(*[F.when(F.col(f"`{c}`").isNull(), F.lit("0")).otherwise(F.lit("1")) for c in columns])
    cols = [F.col(f"`{c}`") for c in columns]
    return F.xxhash64(nulls, *cols), F.xxhash64(F.lit("second print"), *cols, nulls)


def file_overview(df: DataFrame, file_col: str = "file") -> DataFrame:
    """Per file: rows, columns, duplicate rows, rows with any NULL and their share.

    Duplicate rows = sum over groups of identical rows of (count - 1). Rows are
    grouped by a 128-bit print, not by all their columns; only rows whose print
    occurs again are then grouped by their values, so the count is exact even if
    different rows shared a print.
    """
    data_cols = [c for c in df.columns if c != file_col]
    any_null = F.lit(False)
    for c in data_cols:
        any_null = any_null | F.col(f"`{c}`").isNull()
    one, two = row_prints(data_cols)
    prints = df.groupBy(file_col, one.alias("__1"), two.alias("__2")).agg(
        F.count(F.lit(1)).alias("__n"), count_if(any_null).alias("__null")
    )
    g = prints.groupBy(file_col).agg(F.sum("__n").cast("long").alias("rows"), F.sum("__null").cast("long").alias("rows_with_nulls"))
    again = prints.filter(F.col("__n") > 1).select(F.col(file_col).alias("__f"), F.col("__1").alias("__a"), F.col("__2").alias("__b"))
    marked = df.withColumns({"__1": one, "__2": two})
    same = (marked["__1"] == again["__a"]) & (marked["__2"] == again["__b"]) & marked[file_col].eqNullSafe(again["__f"])
    exact = marked.join(again, same, "left_semi").groupBy(file_col, *[F.col(f"`{c}`") for c in data_cols]).agg(F.count(F.lit(1)).alias("__n"))
    repeated = exact.groupBy(F.col(file_col).alias("__f")).agg(F.sum(F.col("__n") - 1).cast("long").alias("duplicate_rows"))
    g = g.join(repeated, g[file_col].eqNullSafe(repeated["__f"]), "left").drop("__f")
    return g.select(
        file_col,
        "rows",
        F.lit(len(data_cols)).alias("columns"),
        F.coalesce("duplicate_rows", F.lit(0)).cast("long").alias("duplicate_rows"),
        "rows_with_nulls",
        _pct2(F.col("rows_with_nulls"), F.col("rows")).alias("pct_rows_with_nulls"),
    ).orderBy(file_col)


# ------------------------------------------------------------------ E2, E3


def wide_coverage(wide: DataFrame, stations: DataFrame, file_col: str = "file") -> DataFrame:
    """Non-NULL points per file x station x metric of a wide frame."""
    cols = [c for c in wide.columns if c.startswith("station_")]
    stacked = wide.select(file_col, "datetime", *cols)
    m = melt_with_key(stacked, file_col)
    g = m.groupBy(file_col, "station_pk", "metric").agg(
        F.count("value").alias("non_null_points"), F.count(F.lit(1)).alias("total_rows")
    )
    g = g.withColumn("pct_non_null", _pct2(F.col("non_null_points"), F.col("total_rows")))
    meta = stations.select(F.col("station_pk").cast("long").alias("station_pk"), "station_code", "station_name")
    return g.join(meta, "station_pk", "left").orderBy(file_col, "station_pk", "metric")


def melt_with_key(df: DataFrame, key: str) -> DataFrame:
    """Melt that keeps an extra key column (e.g. the file) next to the values."""
    from stratus.operators.tall import STATION_COLUMN, station_columns

    cols = [c for c in station_columns(df, "datetime") if c != key]
    prepared = df.select(key, "datetime", *[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in cols])
    long = prepared.unpivot([key, "datetime"], cols, "__col", "value")
    return long.select(
        key,
        "datetime",
        F.regexp_extract("__col", STATION_COLUMN, 1).cast("long").alias("station_pk"),
        F.lower(F.regexp_extract("__col", STATION_COLUMN, 2)).alias("metric"),
        "value",
    )


def unmapped_stations(tall: DataFrame, stations: DataFrame) -> DataFrame:
    """Station keys present in the data but missing from the mapping."""
    present = tall.select(F.col("station_pk").cast("long").alias("station_pk")).distinct()
    known = stations.select(F.col("station_pk").cast("long").alias("station_pk"))
    return present.join(known, "station_pk", "left_anti")


# ------------------------------------------------------------------ E4-E6


def completeness(tall: DataFrame) -> DataFrame:
    """Per station x metric: rows, non-NULL values, share."""
    g = tall.groupBy("station_pk", "station_code", "station_name", "metric").agg(
        F.count(F.lit(1)).alias("total_points"), F.count("value").alias("non_null")
    )
    return g.withColumn("pct_non_null", _pct2(F.col("non_null"), F.col("total_points"))).orderBy(
        "station_pk", "metric"
    )


def missing_by_column(df: DataFrame) -> DataFrame:
    """E5: missing share per column (one pass), largest first."""
    exprs = []
    for f in df.schema.fields:
        c = F.col(f.name)
        miss = c.isNull()
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            miss = miss | F.isnan(c)
        exprs.append(F.avg(miss.cast("double")).alias(f.name))
    one = df.agg(*exprs)
    long = one.unpivot([], [f.name for f in df.schema.fields], "column", "missing")
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    pairs = []
    for k, v in types.items():
        pairs += [F.lit(k), F.lit(v)]
    return long.select(
        "column",
        F.element_at(F.create_map(*pairs), F.col("column")).alias("dtype"),
        F.coalesce(half_even_round(F.col("missing") * 100.0, 2), F.lit(0.0)).alias("pct_missing"),
    ).orderBy(F.desc("pct_missing"), "column")


def describe_numeric(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Count, mean, std, min, quartiles (exact, interpolated) and max per
    numeric column, optionally rounded to ``digits`` decimals.

    The columns are stacked into (column, value) rows; one pass over these has
    the moments and a sketch per column, a second the exact quartiles."""
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    if not num:
        return df.sparkSession.createDataFrame([("No numeric columns detected",)], "message string")
    stacked = df.select(*[number(c).alias(c) for c in num]).unpivot([], num, "column", "v")
    more = [F.avg("v").alias("mean"), F.stddev_samp("v").alias("std")]
    both = with_quantiles(stacked, ["column"], "v", [0.25, 0.5, 0.75], ["p25", "p50", "p75"], *more, few_groups=True)
    both = both.withColumns({"count": F.col("__n").cast("double"), "min": F.col("__min"), "max": F.col("__max")})

    def r(c: str) -> Column:
        return F.col(c) if digits is None else duck_round(F.col(c), digits)

    return both.select(
        "column", "count", r("mean").alias("mean"), r("std").alias("std"), r("min").alias("min"),
        r("p25").alias("p25"), r("p50").alias("p50"), r("p75").alias("p75"), r("max").alias("max"),
    )


# ------------------------------------------------------------------ E7-E12


def tall_overview(tall: DataFrame, file_col: str = "file") -> DataFrame:
    """Per file: rows, distinct stations and metrics, VALID share, date span."""
    g = tall.groupBy(file_col).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("station_pk").alias("stations"),
        F.count_distinct("metric").alias("metrics"),
        F.avg((F.col("quality_flag") == "VALID").cast("double")).alias("__v"),
        F.min("datetime").alias("first_datetime"),
        F.max("datetime").alias("last_datetime"),
    )
    return g.select(
        file_col, "rows", "stations", "metrics", half_even_round(F.col("__v") * 100.0, 2).alias("pct_valid"),
        "first_datetime", "last_datetime",
    ).orderBy(file_col)


def valid_coverage(tall: DataFrame, stations: DataFrame, file_col: str = "file") -> DataFrame:
    """VALID points per file x station x metric with station code and name."""
    g = tall.groupBy(file_col, "station_pk", "metric").agg(
        F.count(F.lit(1)).alias("total_points"), count_if(F.col("quality_flag") == "VALID").alias("valid_points")
    )
    g = g.withColumn("pct_valid", _pct2(F.col("valid_points"), F.col("total_points")))
    meta = stations.select(F.col("station_pk").cast("long").alias("station_pk"), "station_code", "station_name")
    return g.join(meta, "station_pk", "left").orderBy(file_col, "station_pk", "metric")


def mean_pivot(tall: DataFrame, metrics: list[str]) -> DataFrame:
    """Mean value per station code x metric, one column per metric."""
    g = tall.groupBy("station_code").pivot("metric", list(metrics)).agg(F.avg("value"))
    return g.select("station_code", *[half_even_round(F.col(m), 2).alias(m) for m in metrics]).orderBy(
        "station_code"
    )


def nodata_rate(tall: DataFrame) -> DataFrame:
    """NODATA share per station code x metric, worst first."""
    g = tall.groupBy("station_code", "metric").agg(
        F.avg((F.col("quality_flag") == "NODATA").cast("double")).alias("__r")
    )
    return g.select("station_code", "metric", half_even_round(F.col("__r") * 100.0, 2).alias("pct_nodata")).orderBy(
        F.desc("pct_nodata"), F.asc_nulls_last("station_code"), F.asc_nulls_last("metric")
    )


def pollutant_summary(tall: DataFrame) -> DataFrame:
    """Per metric: count, mean, std, min, max, distinct stations, date span."""
    v = F.col("value").cast("double")
    return tall.groupBy("metric").agg(
        F.count(v).alias("count"),
        half_even_round(F.avg(v), 2).alias("mean"),
        half_even_round(F.stddev_samp(v), 2).alias("std"),
        half_even_round(F.min(v), 2).alias("min"),
        half_even_round(F.max(v), 2).alias("max"),
        F.count_distinct("station_pk").alias("stations"),
        F.min("datetime").alias("first_datetime"),
        F.max("datetime").alias("last_datetime"),
    ).orderBy("metric")


def flag_counts(tall: DataFrame) -> DataFrame:
    """Rows per quality flag with their share (1 decimal)."""
    from pyspark.sql import Window

    g = tall.groupBy("quality_flag").agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy())
    return g.select(
        "quality_flag", "count", half_even_round(F.col("count").cast("double") / total * 100.0, 1).alias("percentage")
    ).orderBy(F.desc("count"), "quality_flag")


# ------------------------------------------------------------------ E13-E16


def files_by_year_pollutant(files: DataFrame, pollutants: list[str]) -> DataFrame:
    """Number of files per year x pollutant (0 when absent)."""
    g = files.groupBy("year").pivot("pollutant", list(pollutants)).agg(F.count(F.lit(1)))
    return g.na.fill(0, subset=list(pollutants)).orderBy("year")


def rows_by_pollutant_year(tall: DataFrame, years: list[str]) -> DataFrame:
    """Rows per pollutant x year (0 when absent)."""
    g = tall.groupBy("pollutant").pivot("year", list(years)).agg(F.count(F.lit(1)))
    return g.na.fill(0, subset=list(years)).orderBy("pollutant")


def mean_station_count(tall: DataFrame, file_col: str = "file") -> DataFrame:
    """Mean number of distinct stations per file, by pollutant."""
    per_file = tall.groupBy("pollutant", file_col).agg(F.count_distinct("station_pk").alias("__s"))
    return per_file.groupBy("pollutant").agg(F.avg("__s").alias("mean_stations")).orderBy("pollutant")


def missing_datasets(observed: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected (pollutant, year) datasets that are not present."""
    obs = observed.select("pollutant", "year").distinct()
    return expected.join(obs, ["pollutant", "year"], "left_anti").orderBy("year", "pollutant")


def station_overlap(a: DataFrame, b: DataFrame) -> DataFrame:
    """Station keys present in both frames."""
    return a.select("station_pk").intersect(b.select("station_pk")).orderBy("station_pk")


def dim_profile(dim: DataFrame, key: str = "station_pk") -> DataFrame:
    """Rows, distinct keys, smallest and largest key."""
    return dim.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(key).alias("distinct_keys"),
        F.min(key).alias("min_key"),
        F.max(key).alias("max_key"),
    )


# ------------------------------------------------------------------ sets


def union_all(*dfs: DataFrame) -> DataFrame:
    """UNION ALL by column name; missing columns (e.g. ``year``) become NULL."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def dedupe_by_key(df: DataFrame, keys: list[str], order: list[Column], keep: str = "first") -> DataFrame:
    """One row per key; the first (or last) row in ``order`` wins.

    Expressed as a min (max) over a struct whose leading fields are the order
    columns: a declarative aggregate, so rows collapse map-side and a key
    holding a large share of the rows never becomes one sorted task (a
    per-key window would). Ties in ``order`` are broken by the remaining
    columns, which makes the choice deterministic.
    """
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(*[o.alias(f"__o{i}") for i, o in enumerate(order)], *[F.col(c) for c in rest])
    pick = F.min(packed) if keep == "first" else F.max(packed)
    return df.groupBy(*keys).agg(pick.alias("__r")).select(*keys, *[F.col(f"__r.{c}").alias(c) for c in rest])
