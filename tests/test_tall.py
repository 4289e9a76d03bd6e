"""Wide -> tall (P13-P15, J1, J2; traps T6, T18, T21) and P16."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratus.operators import clean as P
from stratus.operators import load as L
from stratus.operators import tall as TL
from stratus.sources import reference


@pytest.fixture()
def wide(spark):
    rows = [
        (dt.datetime(2020, 1, 1, 0), None, 2.0, float("inf"), 5.0, "x"),
        (dt.datetime(2020, 1, 1, 1), 1.5, float("nan"), 3.0, None, "y"),
        (None, 9.0, 9.0, 9.0, 9.0, "z"),
    ]
    schema = ("datetime timestamp_ntz, station_1_wind_speed double, station_1_wind_direction double, "
              "station_2_no2 double, station_99_co double, unknown_station_3 string")
    return spark.createDataFrame(rows, schema)


def test_melt_rows_and_parsing(spark, wide):
    m = TL.melt(wide)
    assert m.columns == ["datetime", "station_pk", "metric", "value"]
    assert m.count() == 3 * 4  # rows x station columns; unknown_station_* skipped
    assert {(r.station_pk, r.metric) for r in m.collect()} == {
        (1, "wind_speed"), (1, "wind_direction"), (2, "no2"), (99, "co")}


def test_normalise_flags_and_metadata(spark, wide):
    tall = TL.normalise(wide, reference.station_dim(spark), "wind", year="2020")
    assert tall.columns == TL.select_tall(tall).columns and tall.columns[-1] == "year"
    rows = {(r.datetime.hour, r.station_pk, r.metric): r for r in tall.collect()}
    assert len(rows) == 8  # the untimed row is dropped
    assert rows[(0, 1, "wind_speed")].quality_flag == "NODATA"
    assert rows[(1, 1, "wind_direction")].value is None  # NaN -> NULL
    inf_row = rows[(0, 2, "no2")]
    assert inf_row.quality_flag == "VALID" and inf_row.value == float("inf")  # T6: flag before nulling
    co = rows[(0, 99, "co")]
    assert co.station_code is None and co.unit is None  # unknown station and metric
    assert TL.missing_metadata(tall).first().missing_metadata == 2
    fact = L.to_fact_rows(tall)
    assert fact.filter((F.col("station_fk") == 2) & (F.col("timestamp") == dt.datetime(2020, 1, 1, 0))).first().value is None


def test_require_unique(spark):
    dim = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "station_pk long, station_code string")
    assert [tuple(r) for r in TL.duplicate_station_keys(dim).collect()] == [(1, 2)]
    with pytest.raises(ValueError):
        TL.require_unique(dim)
    TL.require_unique(reference.station_dim(spark))


def test_split_valid_partitions_input(spark):
    rows = [
        (dt.datetime(2020, 1, 1), 1, "wind_direction", 400.0),
        (dt.datetime(2020, 1, 1), 1, "wind_speed", 5.0),
        (None, 1, "no2", 3.0),
        (dt.datetime(2020, 1, 1), None, "so2", 999.0),
        (dt.datetime(2020, 1, 1), 2, "unknown_metric", -5.0),
    ]
    df = spark.createDataFrame(rows, "datetime timestamp_ntz, station_pk long, metric string, value double")
    ok, rej = P.split_valid(df, reference.metric_ranges(spark))
    assert ok.count() + rej.count() == df.count()
    reasons = {r["metric"]: r["__error__"] for r in rej.collect()}
    assert reasons == {
        "wind_direction": "out_of_range",
        "no2": "missing_datetime",
        "so2": "missing_station_pk;out_of_range",
    }


def test_sorted_tall(spark, wide):
    tall = TL.normalise(wide, reference.station_dim(spark), "wind")
    keys = [(r.datetime, r.station_pk, r.metric) for r in TL.sorted_tall(tall, global_order=True).collect()]
    assert keys == sorted(keys)


def test_dedupe_by_key_first_and_last(spark):
    from stratus.operators.profile import dedupe_by_key

    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, o int, v string")
    first = {r.k: r.v for r in dedupe_by_key(df, ["k"], [F.col("o")], keep="first").collect()}
    last = {r.k: r.v for r in dedupe_by_key(df, ["k"], [F.col("o")], keep="last").collect()}
    assert first == {1: "a", 2: "c"} and last == {1: "b", 2: "c"}


def test_pivot_then_melt_keeps_every_value(spark):
    """SURVEY §5 property: wide -> tall returns every non-NULL value of the wide layer."""
    from stratus.sources import drivertables as D
    from tests.conftest import SF_SMALL

    long = D.events_hourly_long(spark, SF_SMALL)
    expected = long.groupBy("datetime", "col_name").agg(F.max("value").alias("v")).filter(F.col("v").isNotNull())
    melted = TL.melt(D.events_wide(spark, SF_SMALL)).filter(F.col("value").isNotNull())
    assert melted.count() == expected.count()
    rows = D.events_wide(spark, SF_SMALL).count()
    assert TL.melt(D.events_wide(spark, SF_SMALL)).count() == rows * len(D.staged_column_names(spark, SF_SMALL))


def test_blank_cells_are_readings_without_a_value(spark):
    from stratus.operators import clean as P
    from stratus.operators import tall as TL
    from stratus.sources import reference

    def cell(row, col, text, kind="s"):
        return ("wind_2020.xlsx", row, col, text, kind)

    cells = spark.createDataFrame(
        [cell(2, 1, "Atlantis AQM Site"), cell(3, 1, "Wind Dir V"), cell(3, 2, "Wind Speed V"), cell(4, 1, "Deg"), cell(4, 2, "m/s"),
         cell(5, 0, "2020-01-01 00:00:00", "d"), cell(5, 1, "90", "n"), cell(5, 2, "3", "n"),
         cell(6, 0, "2020-01-01 01:00:00", "d"), cell(6, 1, "91", "n"),  # no speed
         cell(7, 1, "5", "n")],  # no time: the row goes
        "file string, sheet_row int, col int, text string, kind string",
    )
    rows = P.stage_wind(cells, reference.station_aliases(spark)).collect()
    assert sorted((r.sheet_row, r.metric, r.value) for r in rows if r.value is not None) == [
        (5, "wind_direction", 90.0), (5, "wind_speed", 3.0), (6, "wind_direction", 91.0)]
    assert [(r.sheet_row, r.metric) for r in rows if r.value is None] == [(6, "wind_speed")]


def test_means_keep_small_values_and_infinities(spark):
    import datetime as dt

    from stratus.operators import profile as E

    at = dt.datetime(2020, 1, 1)
    schema = "metric string, value double, station_code string, station_pk long, datetime timestamp_ntz"
    rows = [("a", 0.00004, "S", 1, at), ("a", 0.00004, "S", 1, at), ("b", 1.0, "S", 1, at), ("b", float("inf"), "S", 1, at)]
    tall = spark.createDataFrame(rows, schema)
    assert {r.column: r.mean for r in E.describe_numeric(tall.filter("metric = 'a'")).collect()}["value"] == 4e-05
    assert {r.metric: r["mean"] for r in E.pollutant_summary(tall).collect()}["b"] == float("inf")
