"""Layer readers and writers.

Layers are directories of Parquet files named by convention (``wind_*``,
``air_quality_*``, ``*_normalised``). A layer is read as one logical scan
with an explicit schema (no inference, no per-file loop on the driver); file
provenance comes from the scan's hidden ``_metadata`` column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

YEAR_PATTERN = r"(19|20)\d{2}"


def read_layer(
    spark: SparkSession,
    directory: str,
    pattern: str = "*.parquet",
    schema: StructType | None = None,
    recursive: bool = False,
) -> DataFrame:
    """S3 + S4: every Parquet file of ``directory`` matching ``pattern`` as one scan."""
    r = spark.read.option("pathGlobFilter", pattern)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(directory)


def file_name() -> Column:
    return F.col("_metadata.file_name")


def with_source(df: DataFrame, file_col: str = "file") -> DataFrame:
    """Tag rows with their file name, the year and the pollutant in it.

    Year is the first 19xx/20xx in the name; the pollutant follows the
    ``air_quality_<pollutant>_<year>`` convention (NULL for other names).
    """
    name = file_name()
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    parts = F.split(stem, "_")
    is_air = stem.startswith("air_quality_")
    return df.select(
        "*",
        name.alias(file_col),
        F.when(stem.rlike(YEAR_PATTERN), F.regexp_extract(stem, YEAR_PATTERN, 0)).alias("year"),
        F.when(is_air, F.element_at(parts, 3)).alias("pollutant"),
    )


def write_staged(df: DataFrame, directory: str, partition_by: tuple[str, ...] = ("source", "pollutant", "year")) -> None:
    """Staged wide rows, one directory per source / pollutant / year.

    Dynamic partition overwrite replaces only the partitions present in
    ``df``, so re-staging one year leaves the others untouched.
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(directory)
    )


def write_tall(df: DataFrame, directory: str, partition_by: tuple[str, ...] = ("source", "year")) -> None:
    """Normalised tall rows, idempotent per partition, sorted inside files.

    Rows are clustered by partition columns (few files per folder), but by
    rebalancing: AQE splits a large partition over several writers and merges
    small ones. Rows are sorted by (datetime, station_pk, metric) inside each
    file so min/max statistics make time filters prune row groups.
    """
    keys = [F.col(c) for c in partition_by]
    (
        df.hint("rebalance", *keys)
        .sortWithinPartitions(*partition_by, "datetime", "station_pk", "metric")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(directory)
    )
