"""End-to-end jobs: raw workbooks -> staged -> normalised -> warehouse -> reports.

These are the entry points a user of the original batch tasks calls (stage
the wind workbooks, stage the air-quality archives, normalise, load, verify,
run the quality suite). Each is one or two Spark jobs over *all* files at
once; there is no per-file loop on the driver.

Layout under a root directory:

* ``staged/``     clean long rows (file, datetime, station_pk, metric, value),
                  partitioned by source / year. A single dataset cannot hold a
                  different column set per file without NULL padding, so the
                  staged layer is stored long; ``tall.to_wide`` gives the
                  one-column-per-station view when wanted.
* ``normalised/`` the tall schema, partitioned by source / year.
* ``warehouse/fact``  fact rows partitioned by source / year, upserted per
                  touched partition; ``warehouse/dim`` versioned station dimension.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.functions import pollutant_from_filename
from stratus.operators import clean as P
from stratus.operators import load as L
from stratus.operators import quality as A
from stratus.operators import tall as TL
from stratus.schemas import TALL
from stratus.sources import reference
from stratus.sources.files import write_staged, write_tall
from stratus.sources.workbook import archive_cells, expand_archives, read_grid, undecoded_members


def _year_of(file_col: Column) -> Column:
    return F.regexp_extract(file_col, r"(19|20)\d{2}", 0)


def stage_wind_files(spark: SparkSession, raw_dir: str, staged_dir: str) -> DataFrame:
    """Every ``wind_*.xlsx`` under ``raw_dir`` -> clean staged rows (returned and written)."""
    cells = read_grid(spark, raw_dir, "wind_*.xlsx")
    long = P.stage_wind(cells, reference.station_aliases(spark)).select("file", "datetime", "station_pk", "metric", "value")
    out = long.withColumn("source", F.lit("wind")).withColumn("pollutant", F.lit("wind")).withColumn(
        "year", _year_of(F.col("file"))
    )
    write_staged(out, staged_dir)
    return out


def stage_air_archives(spark: SparkSession, raw_dir: str, staged_dir: str) -> DataFrame:
    """Every ``air_quality_*.zip`` under ``raw_dir`` -> clean staged rows.

    The pollutant comes from each member's file name; members it cannot
    classify are skipped, like files without a recognisable pollutant.
    """
    members = expand_archives(spark, raw_dir)
    cells = archive_cells(members)
    pol = pollutant_from_filename(F.col("file"))
    long = P.stage_air(cells, reference.station_aliases(spark), pol).filter(F.col("metric").isNotNull())
    out = long.select("file", "datetime", "station_pk", "metric", "value").withColumn(
        "source", F.lit("air_quality")
    ).withColumn("pollutant", F.col("metric")).withColumn("year", _year_of(F.col("file")))
    write_staged(out, staged_dir)
    return out


def undecoded_air_members(spark: SparkSession, raw_dir: str) -> DataFrame:
    """Archive members that staging had to leave out."""
    return undecoded_members(expand_archives(spark, raw_dir))


def normalise_staged(spark: SparkSession, staged_dir: str, normalised_dir: str) -> DataFrame:
    """Staged rows -> tall rows with units, flags and station metadata (written)."""
    staged = spark.read.parquet(staged_dir)
    # year is the file's year (from its name), as the staged partition carries it
    cols = staged.select("datetime", "station_pk", "metric", "value", "source", F.col("year").cast("string").alias("year"))
    annotated = TL.annotate(cols, F.col("source"))
    tall = TL.with_station_meta(TL.drop_untimed(annotated), reference.station_dim(spark))
    out = TL.select_tall(tall)
    write_tall(out, normalised_dir)
    return out


def load_warehouse(spark: SparkSession, normalised_dir: str, warehouse_dir: str, now: Column | None = None) -> dict:
    """Dimension upsert + partition-scoped fact upsert; returns load statistics."""
    now = now if now is not None else F.current_timestamp()
    dim_root = os.path.join(warehouse_dir, "dim")
    current_dim = L.read_current(spark, dim_root)
    stations = reference.station_dim(spark)
    if current_dim is None:
        new_dim = L.seed_dim(stations, now)
        dim_stats = {"stations_inserted": new_dim.count(), "stations_updated": 0, "total_stations": stations.count()}
    else:
        up = L.upsert_dim(current_dim, stations, now)
        s = L.dim_load_stats(up, stations).first()
        dim_stats = s.asDict()
        new_dim = up.drop("__change")

    tall = spark.read.schema(T.StructType(TALL.fields + [T.StructField("year", T.StringType())])).parquet(
        normalised_dir
    )
    rows = L.with_partitions(L.to_fact_rows(tall))
    fact_dir = os.path.join(warehouse_dir, "fact")
    L.recover_partitions(spark, fact_dir, len(L.PARTITIONS))
    keyed = L.assign_keys(rows, ["timestamp", "station_fk", "metric", "source"], L.largest_key(spark, fact_dir))
    keyed = keyed.withColumn("created_at", now.cast("timestamp_ntz"))
    touched = L.upsert_partitions(spark, fact_dir, keyed, L.PARTITIONS, gate=L.integrity_gate(new_dim))
    L.publish(new_dim, dim_root)
    return {"dimension": dim_stats, "partitions_loaded": touched}


def warehouse(spark: SparkSession, warehouse_dir: str) -> tuple[DataFrame, DataFrame]:
    """(fact, dim) of the published warehouse."""
    fact = spark.read.parquet(os.path.join(warehouse_dir, "fact"))
    dim = L.read_current(spark, os.path.join(warehouse_dir, "dim"))
    return fact, dim


def integrity_report(spark: SparkSession, warehouse_dir: str) -> DataFrame:
    """A7 over the published warehouse."""
    fact, dim = warehouse(spark, warehouse_dir)
    return A.integrity(fact, dim)


def quality_suite(spark: SparkSession, warehouse_dir: str) -> dict[str, DataFrame]:
    """The full data-quality report as named lazy frames (one per section)."""
    fact, dim = warehouse(spark, warehouse_dir)
    return {
        "summary": A.dq_summary(fact, dim),
        "flag_distribution": A.share_of_total(fact),
        "source_distribution": A.counts_by(fact, "source"),
        "by_metric": A.counts_by_metric(fact),
        "by_station": A.counts_by_station(fact, dim),
        "null_rates_by_metric": A.null_rates(fact, by="metric"),
        "null_rates_by_station": A.null_rates(fact, dim, by="station"),
        "high_null_metrics": A.high_null_metrics(fact),
        "value_ranges": A.value_ranges(fact),
        "coverage": A.coverage(fact),
        "coverage_by_source": A.coverage(fact, ("source",)),
        "coverage_by_metric": A.coverage(fact, ("metric",)),
        "flags_by_source": A.share_within(fact),
        "low_quality_metrics": A.low_quality_metrics(fact),
        "issues": A.dq_issues(fact),
    }
