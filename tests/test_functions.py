"""Scalar helpers: rounding parity (T10), coercion (T5, P8), timestamps (T3), names (P4-P6), P17."""
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stratus.functions import (
    duck_round,
    half_even_round,
    metric_from_param,
    normalise_station,
    pct,
    pollutant_from_filename,
    python_strip,
    to_fact_value,
    to_number,
    to_ts,
    trunc_ts,
)
from stratus.plans.checks import physical_plan


def _one(spark, values, schema, expr):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr(F.col(df.columns[0]))).collect()]


def test_duck_round_ties(spark):
    assert _one(spark, [0.285, 1.005, 2.675, -0.285], "x double", lambda c: duck_round(c, 2)) == [0.28, 1.0, 2.68, -0.28]


def test_half_even_round(spark):
    assert _one(spark, [0.285, 2.675, 0.125], "x double", lambda c: half_even_round(c, 2)) == [0.28, 2.68, 0.12]


def test_pct_zero_denominator(spark):
    df = spark.createDataFrame([(1, 0), (1, 3)], "n long, d long")
    assert [r[0] for r in df.select(pct("n", "d")).collect()] == [0.0, 33.33]


def test_to_number(spark):
    vals = ["12.5", "-3", "<Samp", "Down", "RS232", "Zero", "Calib", "InVld", "NaN", "", " ", "1d", "1e3", "inf", "0x1p3"]
    got = _one(spark, vals, "x string", to_number)
    assert got[:2] == [12.5, -3.0]
    assert got[2:12] == [None] * 10
    assert got[12] == 1000.0 and got[13] == float("inf") and got[14] is None


def test_to_ts_day_first(spark):
    vals = ["31/12/2019 23:00", "1/2/2019 0:00", "31/12/2019 24:00", "Minimum"]
    got = _one(spark, vals, "x string", lambda c: to_ts(c, ["d/M/yyyy H:mm"]))
    assert got == [dt.datetime(2019, 12, 31, 23), dt.datetime(2019, 2, 1, 0), None, None]


def test_trunc_ts_independent_of_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = spark.createDataFrame([(dt.datetime(2019, 3, 10, 2, 30, 5),)], "t timestamp_ntz")
        r = df.select(trunc_ts("t", "hour"), trunc_ts("t", "day"), trunc_ts("t", "month")).first()
        assert tuple(r) == (dt.datetime(2019, 3, 10, 2), dt.datetime(2019, 3, 10), dt.datetime(2019, 3, 1))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


@pytest.mark.parametrize(
    "name,code",
    [
        ("2019_NO2_CCT.xls", "no2"),
        ("2020_PM2.5_CCT.xlsx", "pm25"),
        ("2021_PM10_CCT.xlsx", "pm10"),
        ("2022_CO_CCT.xlsx", "co"),
        ("nitrogen_NO2_x.xlsx", "no2"),
        ("readme.txt", None),
    ],
)
def test_pollutant_from_filename(spark, name, code):
    assert _one(spark, [name], "x string", pollutant_from_filename) == [code]


def test_station_and_metric_names(spark):
    assert _one(spark, ["  Somerset-West AQM Site\t"], "x string", normalise_station) == ["Somerset West AQM Site"]
    assert _one(spark, ["Wind Dir V", "Wind Speed V", "Air Temp"], "x string", metric_from_param) == [
        "wind_direction", "wind_speed", "air_temp"]


def test_to_fact_value(spark):
    got = _one(spark, [1.23455, -1.23455, float("nan"), float("inf"), None], "x double", to_fact_value)
    assert got == [Decimal("1.2346"), Decimal("-1.2346"), None, None, None]
    with pytest.raises(Exception):
        _one(spark, [123456789.5], "x double", to_fact_value)


def test_strip_is_that_of_the_pattern_without_its_time(spark):
    """Native trimming, but for texts that end in a line end which ``$`` passes over and ``\\s`` does not know."""
    ends = ["", " ", "\t\n", "\x0b\f\r", "\x85", "\u2028", " \u2029", "\xa0", "\x1c "]
    df = spark.createDataFrame([(a + x + b,) for a in ends for b in ends for x in ("", "a", "Somerset-West b")] + [(None,)], "t string")
    assert df.filter(~python_strip("t").eqNullSafe(F.regexp_replace("t", r"^\s+|\s+$", ""))).count() == 0
    assert "regexp" not in physical_plan(df.select(normalise_station("t")), "simple").split("ELSE")[-1]
