"""Wide -> tall normalisation.

The staged layer has one column per station x metric (``station_<pk>_<metric>``).
The melt is a single ``unpivot`` (an Expand node inside one codegen stage, no
shuffle); station key and metric are parsed from the column name with
``regexp_extract`` on the unpivoted name column. Station metadata is joined by
a many-to-one join against a small dimension.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.functions import to_number, unit_of
from stratus.schemas import TALL_COLUMNS

STATION_COLUMN = r"^station_(\d+)_(.+)$"
_STATION_COLUMN_RE = re.compile(STATION_COLUMN)


def station_columns(df: DataFrame, id_col: str = "datetime") -> list[str]:
    """Columns named ``station_<pk>_<metric>``; anything else is skipped."""
    return [c for c in df.columns if c != id_col and _STATION_COLUMN_RE.match(c)]


def to_wide(
    long: DataFrame,
    columns: list[str],
    keys: tuple[str, ...] = ("datetime",),
    name_col: str = "col_name",
    value_col: str = "value",
) -> DataFrame:
    """Long (keys, column name, value) -> one row per key, one column per name.

    The column list is passed explicitly, so no distinct-values job runs. When
    a (key, column) pair occurs more than once the largest value is kept,
    which makes the result independent of row order.
    """
    return long.groupBy(*keys).pivot(name_col, list(columns)).agg(F.max(value_col))


def melt(df: DataFrame, id_col: str = "datetime") -> DataFrame:
    """Wide -> (datetime, station_pk, metric, value).

    Value columns are coerced like ``pandas.to_numeric(errors='coerce')``:
    numbers stay, NaN becomes NULL, text goes through the guarded parser.
    One output row per input row and station column, including NULL values.
    """
    cols = station_columns(df, id_col)
    if not cols:
        raise ValueError("no station columns found to normalise")

    def numeric(c: str) -> Column:
        dt = df.schema[c].dataType
        if isinstance(dt, T.NumericType):
            x = F.col(c).cast("double")
            return F.nanvl(x, F.lit(None).cast("double"))
        return to_number(F.col(c))

    prepared = df.select(F.col(id_col), *[numeric(c).alias(c) for c in cols])
    long = prepared.unpivot([id_col], cols, "__col", "value")
    return long.select(
        F.col(id_col).alias("datetime"),
        F.regexp_extract("__col", STATION_COLUMN, 1).cast("long").alias("station_pk"),
        F.lower(F.regexp_extract("__col", STATION_COLUMN, 2)).alias("metric"),
        "value",
    )


def annotate(long: DataFrame, source: str | Column, year: str | Column | None = None) -> DataFrame:
    """Unit (NULL when unknown), source, quality flag and optional year.

    The flag is decided before infinities are nulled at load time, so an
    infinite reading is VALID here and NULL in the warehouse.
    """
    src = F.lit(source) if isinstance(source, str) else source
    out = long.withColumn("unit", unit_of("metric")).withColumn("source", src).withColumn(
        "quality_flag", F.when(F.col("value").isNull(), F.lit("NODATA")).otherwise(F.lit("VALID"))
    )
    if year is not None:
        out = out.withColumn("year", F.lit(year) if isinstance(year, str) else year)
    return out


def drop_untimed(df: DataFrame, col: str = "datetime") -> DataFrame:
    """P10: rows without a timestamp are dropped."""
    return df.filter(F.col(col).isNotNull())


def duplicate_station_keys(dim: DataFrame, keys: tuple[str, ...] = ("station_pk",)) -> DataFrame:
    """Keys that occur more than once in the dimension (must be empty)."""
    return dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") > 1)


def require_unique(dim: DataFrame, keys: tuple[str, ...] = ("station_pk",)) -> None:
    """J2 as a guard: raise when the right side of a many-to-one join repeats a key."""
    bad = duplicate_station_keys(dim, keys).limit(5).collect()
    if bad:
        raise ValueError(f"dimension keys are not unique: {[tuple(r) for r in bad]}")


def with_station_meta(long: DataFrame, stations: DataFrame) -> DataFrame:
    """LEFT JOIN station metadata (code, name, location type) on station_pk."""
    meta = stations.select(
        F.col("station_pk").cast("long").alias("__pk"), "station_code", "station_name", "location_type"
    )
    return long.join(meta, long["station_pk"] == meta["__pk"], "left").drop("__pk")


def missing_metadata(tall: DataFrame) -> DataFrame:
    """Number of rows left without station metadata."""
    return tall.agg(F.count(F.when(F.col("station_code").isNull(), F.lit(1))).alias("missing_metadata"))


def select_tall(df: DataFrame) -> DataFrame:
    """The tall schema's column order (``year`` last when present)."""
    cols = list(TALL_COLUMNS) + (["year"] if "year" in df.columns else [])
    return df.select(*cols)


def normalise(
    wide: DataFrame,
    stations: DataFrame,
    source: str | Column,
    year: str | Column | None = None,
    id_col: str = "datetime",
) -> DataFrame:
    """Staged wide frame -> tall fact rows (P13 + P14 + P10 + J1 + P15)."""
    long = melt(wide, id_col)
    long = long.withColumn("datetime", F.col("datetime").cast("timestamp_ntz"))
    tall = with_station_meta(drop_untimed(annotate(long, source, year)), stations)
    return select_tall(tall)


TALL_ORDER = ("datetime", "station_pk", "metric")


def sorted_tall(df: DataFrame, global_order: bool = False) -> DataFrame:
    """O1: (datetime, station_pk, metric) order. Within partitions by default
    (what a writer needs); a total order only when asked for."""
    keys = [F.asc_nulls_last(c) for c in TALL_ORDER]
    return df.orderBy(*keys) if global_order else df.sortWithinPartitions(*keys)


def placed(df: DataFrame, order: list[str], name: str = "place") -> DataFrame:
    """O1 / O2 as data: each row with its place (from 1) in the total order of ``order``, NULLs last.

    Distributed like the surrogate keys: ranges of the order are counted and numbered on their own.
    """
    from stratus.operators.load import assign_keys

    return assign_keys(df, list(order), 0, name)


def sortedness(df: DataFrame, order: tuple[str, ...] = TALL_ORDER) -> DataFrame:
    """O1 as a check: rows, partitions, rows that come before their predecessor inside a partition, and
    neighbouring partitions that overlap, for ``df`` as it is partitioned and ordered.

    A partition is read as a stream: every row is compared with the one before it, and only each partition's
    first and last key go on to the comparison with its neighbours.
    """
    key = F.struct(*[c for n in order for c in (F.col(n).isNull(), F.col(n))])
    rows = df.select(key.alias("k"), F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("i"))
    inside = Window.partitionBy("p").orderBy("i")
    stepped = rows.withColumn("back", F.coalesce(F.col("k") < F.lag("k").over(inside), F.lit(False)))
    per = stepped.groupBy("p").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("back").alias("back"), F.min("k").alias("lo"), F.max("k").alias("hi")
    )
    overlap = F.coalesce(F.col("lo") < F.lag("hi").over(Window.orderBy("p")), F.lit(False))
    return per.withColumn("overlap", overlap).agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows"),
        F.coalesce(F.sum("back"), F.lit(0)).cast("long").alias("inversions"),
        F.count_if("overlap").alias("overlaps"),
    )
