"""Distributed exact quantiles against numpy on a skewed input."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from stratus.operators.stats import banded, column_quantiles, combined_moments, exact_quantiles, moments, sketched, with_quantiles


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(7)
    hot = rng.integers(0, 500, 20000).astype(float) / 4  # one group with most rows and many ties
    rows = [("hot", float(v)) for v in hot] + [("one", 3.0), ("two", 1.0), ("two", 2.0), ("nulls", None),
                                                  ("nan", float("nan")), ("nan", 5.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {r.g: [r[f"q{i}"] for i in range(len(probs))] for r in exact_quantiles(df, ["g"], "v", probs).collect()}
    assert got["hot"] == [float(np.quantile(hot, p)) for p in probs] or np.allclose(
        got["hot"], [np.quantile(hot, p) for p in probs], rtol=0, atol=1e-12)
    assert got["one"] == [3.0] * 6
    assert np.allclose(got["two"], [1.0, 1.25, 1.5, 1.75, 1.9, 2.0])
    assert got["nan"] == [5.0] * 6  # NaN ignored
    assert "nulls" not in got  # no values -> no group row


def test_column_quantiles(spark):
    df = spark.range(1, 101).select(F.col("id").alias("a"), (F.col("id") * 2).alias("b"))
    got = {r.column: (r.p25, r.p50) for r in column_quantiles(df, ["a", "b"], [0.25, 0.5], ["p25", "p50"]).collect()}
    assert got == {"a": (25.75, 50.5), "b": (51.5, 101.0)}


def test_extreme_values_and_null_groups(spark):
    inf = float("inf")
    rows = [(None, v) for v in (-inf, -1e300, -2.0, -0.0, 0.0, 1e-300, 3.0, 1e300, inf)] + [("same", 7.0)] * 1000
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.q0, r.q1, r.q2) for r in exact_quantiles(df, ["g"], "v", [0.0, 0.5, 1.0]).collect()}
    assert got == {None: (-inf, 0.0, inf), "same": (7.0, 7.0, 7.0)}


@pytest.mark.parametrize("value", ["id % 20000 / 7 - 500", "1.7e9 + id % 20000 / 1000", "exp(id % 20000 / 400 - 25)", "-exp(id % 20000 / 400 - 25)"])
def test_buckets_keep_the_order_and_split_a_hot_group(spark, value):
    """No task sorts more than a small part of a group that holds most readings, spread out, close together or skewed."""
    from stratus.operators.stats import coarse_bucket, part_of_range

    hot = spark.range(0, 60000).select(F.expr(value).alias("v"))
    ends = hot.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    rows = hot.crossJoin(ends).select("v", coarse_bucket(F.col("v")).alias("b"), part_of_range(F.col("v"), F.col("lo"), F.col("hi")).alias("f")).collect()
    rows.sort()
    assert all((a.b, a.f) <= (b.b, b.f) for a, b in zip(rows, rows[1:]))
    from collections import Counter

    assert max(Counter((r.b, r.f) for r in rows).values()) < 0.01 * len(rows)


def test_building_quantiles_runs_no_job(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    spark.sparkContext.setJobGroup("quantiles", "")
    exact_quantiles(df, ["g"], "v", [0.5])
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("quantiles")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_large_group_with_narrow_bands(spark):
    """Groups beyond the sketch's exact size: bands, gaps, ties across a band's end, and values between equal ones."""
    rng = np.random.default_rng(3)
    a = rng.lognormal(0, 2, 30000)
    b = np.r_[np.full(15000, 4.0), rng.normal(size=4999), np.full(6000, -2.5)]  # ranks inside long runs of one value
    rows = [("a", float(v)) for v in a] + [("b", float(v)) for v in b] + [("b", None), ("c", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    names = [f"q{i}" for i in range(len(probs))]
    got = {r.g: r for r in with_quantiles(df, ["g"], "v", probs, names, F.avg("v").alias("mean")).collect()}
    for g, x in (("a", a), ("b", b)):
        assert np.allclose([got[g][n] for n in names], np.quantile(x, probs), rtol=0, atol=1e-12)
        assert (got[g]["__n"], got[g]["__min"], got[g]["__max"]) == (len(x), x.min(), x.max())
    assert got["b"]["__rows"] == len(b) + 1
    assert (got["c"]["__n"], got["c"]["__rows"], got["c"]["q3"], got["c"]["__min"]) == (0, 1, None, None)


def test_bands_leave_a_small_copy(spark):
    """What the second pass passes on does not grow with the group: a few hundredths of it."""
    df = spark.range(200_000).select(F.lit("hot").alias("g"), F.rand(5).alias("v"))
    first = sketched(df, ["g"], "v", [0.5])
    copy = banded(df, ["g"], "v", first, 1)
    assert copy.count() < 0.06 * 200_000
    assert copy.agg(F.sum("__c")).first()[0] == 200_000


def test_moments_of_parts_are_those_of_the_whole(spark):
    """Combined squared deviations keep their digits where the mean is large against the spread."""
    rng = np.random.default_rng(9)
    x = 1e9 + rng.normal(size=3000)
    df = spark.createDataFrame([(int(i % 7), float(v)) for i, v in enumerate(x)] + [(8, None)], "part int, v double")
    parts = df.groupBy("part").agg(*moments(F.col("v"))).withColumn("g", F.lit("all"))
    got = combined_moments(parts.filter(F.col("__n") > 0), ["g"]).first()
    assert got["__n"] == 3000
    assert np.isclose(got["__mean"], x.mean(), rtol=1e-15)
    assert np.isclose(got["__std"], x.std(ddof=1), rtol=1e-6)
    one = combined_moments(parts.filter("part = 0").withColumn("__n", F.lit(1)), ["g"]).first()
    assert one["__std"] is None


def test_correlation_of_means_that_never_vary(spark):
    """A station whose means are constant has no correlation (NaN); it does not stop the query, whatever its periods."""
    from stratus.operators.analytics import daily_correlation

    days = [(1, d, 3.0, float(d)) for d in range(1, 13)]  # constant wind
    days += [(2, d, float(d), 2.0 * d + 1) for d in range(1, 13)]
    days += [(3, d, 5.0, 5.0) for d in (1, 2)]  # constant, and of too few periods
    days += [(4, d, 7.0, 8.0) for d in range(1, 13)]
    rows = [(k, f"2024-01-{d:02d} 10:00:00", m, v, "VALID") for k, d, a, b in days for m, v in (("wind_speed", a), ("no2", b))]
    fact = spark.createDataFrame(rows, "station_fk int, timestamp string, metric string, value double, quality_flag string")
    fact = fact.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    dim = spark.createDataFrame([(k, f"s{k}") for k in (1, 2, 3, 4)], "station_pk int, station_name string")
    got = {r.station_name: (r.periods, r.correlation) for r in daily_correlation(fact, dim).collect()}
    assert set(got) == {"s1", "s2", "s4"} and got["s2"] == (12, 1.0)
    assert np.isnan(got["s1"][1]) and np.isnan(got["s4"][1])
