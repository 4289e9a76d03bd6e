"""The reference tables as DataFrames (stations, aliases, metrics, flags).

They come from the fixed rows in ``stratus.schemas``, whose size is known when
the plan is built, or from a user's JSON file (``read_reference``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus import schemas

STATIONS_SCHEMA = T.StructType(
    [
        T.StructField("station_pk", T.IntegerType(), False),
        T.StructField("station_code", T.StringType(), False),
        T.StructField("station_name", T.StringType(), False),
        T.StructField("normalised_names", T.ArrayType(T.StringType(), False), False),
        T.StructField("location_type", T.StringType(), True),
        T.StructField("description", T.StringType(), True),
    ]
)

METRICS_SCHEMA = T.StructType(
    [
        T.StructField("metric_code", T.StringType(), False),
        T.StructField("metric_name", T.StringType(), True),
        T.StructField("unit", T.StringType(), True),
        T.StructField("description", T.StringType(), True),
        T.StructField("valid_range", T.ArrayType(T.DoubleType(), False), True),
    ]
)


def stations(spark: SparkSession, rows=None) -> DataFrame:
    return spark.createDataFrame(rows or schemas.STATIONS, STATIONS_SCHEMA)


def station_dim(spark: SparkSession, rows=None) -> DataFrame:
    """The station file columns."""
    return stations(spark, rows).select(
        F.col("station_pk").cast("long").alias("station_pk"),
        "station_code",
        "station_name",
        "location_type",
        "description",
    )


def station_aliases(spark: SparkSession, rows=None) -> DataFrame:
    """One row per (alias, station); unknown header names are found by anti join."""
    return stations(spark, rows).select(
        F.explode("normalised_names").alias("alias"),
        "station_pk",
        "station_code",
        "station_name",
    )


def metrics(spark: SparkSession, rows=None) -> DataFrame:
    """Metric definitions; the fixed ones have no names or descriptions, a user's file may (``read_reference``)."""
    fixed = [(code, None, unit, None, valid) for code, unit, valid in schemas.METRICS]
    return F.broadcast(spark.createDataFrame(rows or fixed, METRICS_SCHEMA))


def metric_ranges(spark: SparkSession, rows=None) -> DataFrame:
    """(metric, min, max) from the metric definitions' valid ranges."""
    return ranges_of(metrics(spark, rows))


def ranges_of(metrics: DataFrame) -> DataFrame:
    return metrics.select(
        F.col("metric_code").alias("metric"),
        F.get("valid_range", F.lit(0)).alias("valid_min"),
        F.get("valid_range", F.lit(1)).alias("valid_max"),
    )


# ------------------------------------------------------- S7 from a user's file

FLAGS_SCHEMA = T.StructType([T.StructField("flag_code", T.StringType()), T.StructField("description", T.StringType())])
EXPECTED_SCHEMA = T.StructType(
    [T.StructField("metric", T.StringType()), T.StructField("min", T.DoubleType()), T.StructField("max", T.DoubleType())]
)
#: A reference file: nested lists by name. Any number of documents; their lists add up.
REFERENCE_SCHEMA = T.StructType(
    [
        T.StructField("stations", T.ArrayType(STATIONS_SCHEMA)),
        T.StructField("metrics", T.ArrayType(METRICS_SCHEMA)),
        T.StructField("quality_flags", T.ArrayType(FLAGS_SCHEMA)),
        T.StructField("expected_ranges", T.ArrayType(EXPECTED_SCHEMA)),
        T.StructField("_corrupt_record", T.StringType()),
    ]
)
#: More metrics than this are no set of definitions; range rules are literals of a plan.
MOST_METRICS = 10_000


@dataclass
class Reference:
    """The reference tables of a file; ``stations`` keep their alias lists."""

    stations: DataFrame
    metrics: DataFrame
    quality_flags: DataFrame
    expected_ranges: DataFrame
    corrupt: DataFrame

    def aliases(self) -> DataFrame:
        """(alias, station_pk, station_code, station_name), a row for each alias."""
        return self.stations.select(F.explode("normalised_names").alias("alias"), "station_pk", "station_code", "station_name")

    def problems(self) -> DataFrame:
        """(kind, subject) of what must not be loaded: documents that are no JSON, keys, aliases or metrics given
        twice, ranges that are no pair or run backwards, and expected ranges that overlap no valid range."""
        m, e = self.metrics, self.expected_ranges
        valid = F.col("valid_range")
        pair = (F.size(valid) == 2) & valid[0].isNotNull() & valid[1].isNotNull()
        no_pair = m.filter(valid.isNotNull() & ~pair)
        backwards = m.filter(pair & (F.get(valid, F.lit(0)) > F.get(valid, F.lit(1))))
        ranges = ranges_of(m.filter(pair)).withColumnRenamed("metric", "__m")
        apart = e.join(ranges, e["metric"] == ranges["__m"]).filter((F.col("min") > F.col("valid_max")) | (F.col("max") < F.col("valid_min")))

        def named(kind: str, df: DataFrame, subject: str) -> DataFrame:
            return df.select(F.lit(kind).alias("kind"), F.col(subject).cast("string").alias("subject"))

        def twice(kind: str, df: DataFrame, subject: str) -> DataFrame:
            return named(kind, df.groupBy(subject).agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), subject)

        found = [
            named("corrupt document", self.corrupt, "_corrupt_record"),
            twice("repeated station key", self.stations, "station_pk"),
            twice("repeated alias", self.aliases(), "alias"),
            twice("repeated metric", m, "metric_code"),
            twice("repeated expected range", e, "metric"),
            named("range is no pair", no_pair, "metric_code"),
            named("range runs backwards", backwards, "metric_code"),
            named("range runs backwards", e.filter(F.col("min") > F.col("max")), "metric"),
            named("ranges do not overlap", apart, "metric"),
        ]
        out = found[0]
        for f in found[1:]:
            out = out.unionByName(f)
        return out

    def check(self) -> "Reference":
        """Raises if there are problems, naming the first few."""
        bad = [tuple(r) for r in self.problems().orderBy("kind", "subject").limit(20).collect()]
        if bad:
            raise ValueError(f"reference tables not usable: {bad}")
        return self

    def range_rules(self) -> dict[str, tuple[float | None, float | None]]:
        """P11's rules from the valid ranges."""
        return {r.metric: (r.valid_min, r.valid_max) for r in self._few(ranges_of(self.metrics))}

    def expected(self) -> list[tuple[str, float, float]]:
        """A10's expected ranges."""
        return [(r.metric, r.min, r.max) for r in self._few(self.expected_ranges)]

    def _few(self, df: DataFrame) -> list:
        rows = df.limit(MOST_METRICS + 1).collect()
        if len(rows) > MOST_METRICS:
            raise ValueError("too many metric definitions")
        return rows


def read_reference(spark: SparkSession, path: str, multiline: bool = True) -> Reference:
    """Reference tables from JSON files with the declared nested schema.

    ``multiline`` reads one document per file, otherwise one per line (for
    registers too large for one document). Lists that a document lacks are empty.
    """
    text = spark.read.text(path, wholetext=multiline).filter(F.trim("value") != "")
    docs = text.select(F.from_json("value", REFERENCE_SCHEMA).alias("doc")).select("doc.*")

    def table(name: str) -> DataFrame:
        return docs.select(F.inline(name))

    broken = docs.select("_corrupt_record").filter(F.col("_corrupt_record").isNotNull())
    return Reference(table("stations"), table("metrics"), table("quality_flags"), table("expected_ranges"), broken)
