"""Raw sheets derived from the tables: every branch of header parsing and cleaning occurs in them."""
import re

import pytest
from pyspark.sql import functions as F

from stratus.operators import clean as P
from stratus.plans.checks import physical_plan
from stratus.registry import QUERIES
from stratus.sources import sheets
from tests.conftest import SF_MID, SF_SMALL


def _cells(spark, rows):
    return spark.createDataFrame(rows, "file string, sheet_row int, col int, text string").withColumn("kind", F.lit("s"))


def test_every_layout_and_tie_occurs(spark):
    got = {r.layout: r.n for r in QUERIES["p3_air_layouts"](spark, SF_SMALL).groupBy("layout").agg(F.count("*").alias("n")).collect()}
    assert set(got) == {"standard", "fallback", "synthetic"} and min(got.values()) > 5
    cells = sheets.air_sheets(spark, SF_SMALL)
    like = F.col("text").contains("AQM")
    rows = cells.filter(like & (F.col("sheet_row") < 9)).groupBy("file", "sheet_row").agg(F.count("*").alias("n")).filter("n >= 2")
    tied = rows.groupBy("file").agg(F.count("*").alias("rows"), F.min("sheet_row").alias("first")).filter("rows > 1")
    chosen = tied.join(P.air_layouts(cells), "file").filter("layout = 'fallback'").select("first", "best_row").collect()
    assert chosen and all(r.best_row == r["first"] - 1 for r in chosen)  # the earliest of equal rows


def test_wind_branches_occur(spark):
    cells = sheets.wind_sheets(spark, SF_MID)
    columns = cells.filter("col >= 1 AND sheet_row < 5")
    header = P.wind_header(cells)
    assert 0 < header.count() < columns.select("file", "col").distinct().count()  # some columns have no parameter or station
    own = cells.filter("sheet_row = 2 AND trim(text) <> ''").select("file", "col")
    assert header.join(own, ["file", "col"], "left_anti").count() > 0  # carried from the left
    assert P.unknown_stations(header, sheets.register(spark, SF_MID)).count() > 0
    assert header.filter(F.col("station").startswith("Somerset West")).count() > 0
    metrics = {r.metric for r in QUERIES["p5_metric_from_param"](spark, SF_MID).collect()}
    assert {"wind_direction", "wind_speed"} < metrics and any("_" in m and not m.startswith("wind") for m in metrics)


def test_junk_readings_occur(spark):
    wind = QUERIES["p7_stage_wind"](spark, SF_SMALL)
    assert wind.filter("value = double('inf')").count() > 0
    assert wind.filter("value = 100.0").count() > 0  # 1e2
    assert wind.filter("metric = 'wind_direction' AND value > 360").count() == 0
    assert wind.filter("metric NOT IN ('wind_direction', 'wind_speed') AND value < 0").count() > 0  # no rule for other metrics
    assert 0 < wind.filter("value IS NULL").count() < wind.count()
    stamps = sheets.wind_sheets(spark, SF_SMALL).filter("col = 0")
    assert wind.select("file", "sheet_row").distinct().count() < stamps.count()  # undated rows are dropped


def test_synthetic_names_cover_the_width(spark):
    cells = _cells(spark, [("a", 1, 2, "just one Site"), ("a", 9, 5, "7"), ("b", 0, 3, "x")])
    got = sorted((r.file, r.col, r.station, r.layout, r.data_start) for r in P.air_header(cells).collect())
    assert got == [("a", c, f"Unknown_Station_{c - 1}", "synthetic", 2) for c in range(1, 6)] + [
        ("b", c, f"Unknown_Station_{c - 1}", "synthetic", 2) for c in range(1, 4)
    ]


def test_empty_input(spark):
    cells = _cells(spark, [])
    assert P.air_header(cells).count() == 0 and P.wind_header(cells).count() == 0 and P.air_layouts(cells).count() == 0


@pytest.mark.parametrize("kind", ["wind", "air"])
def test_headers_need_no_shuffle_of_cells(spark, kind):
    """The lines are dealt by sheet once; neither the cells nor the header cells are shuffled after that."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with large dimensions
        cells = sheets.wind_sheets(spark, SF_SMALL) if kind == "wind" else sheets.air_sheets(spark, SF_SMALL)
        plan = physical_plan(P.wind_header(cells) if kind == "wind" else P.air_header(cells), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", plan)
    assert keys and not any("sheet_row" in k or "col#" in k for k in keys)
    # lines by sheet, supplier and part with both sides, then joined lines and orders by sheet
    assert len(keys) == 7


def test_header_agrees_with_layout_on_odd_cells(spark):
    """Files and columns without a name, columns left of the frame and rows above it count as they do in the layout."""
    site = "A AQM Site"
    rows = [("std", 3, 1, site), ("std", 3, 2, site), ("std", 4, 1, "NO2"), ("std", 5, 2, "ppb"), ("std", 9, 3, "1"), ("std", 0, 4, site)]
    rows += [("fall", 4, 0, site), ("fall", 4, 2, site), ("fall", 6, 1, site), ("fall", 6, 2, None), ("fall", 1, None, site)]
    rows += [("none", 3, 0, site), ("none", 2, 0, "x"), ("nocol", 2, None, "x"), ("tall", 30, 2, "5")]
    rows += [(None, 4, 1, site), (None, 4, 2, site), ("norow", None, 2, site)]
    cells = _cells(spark, rows)
    got = sorted((r.file, r.col, r.station, r.param, r.unit, r.data_start, r.layout) for r in P.air_header(cells).collect())
    unknown = ("Unknown", "Unknown")
    made = lambda f, n: [(f, c, f"Unknown_Station_{c - 1}", *unknown, 2, "synthetic") for c in range(1, n + 1)]
    assert got == sorted(
        [("std", 1, site, "NO2", "", 6, "standard"), ("std", 2, site, "", "ppb", 6, "standard")]
        + [("fall", 1, "", *unknown, 5, "fallback"), ("fall", 2, site, *unknown, 5, "fallback")]
        + made("tall", 2) + made("norow", 2)
    )
    layouts = {r.file: r.layout for r in P.air_layouts(cells).collect()}
    assert all(layouts[r[0]] == r[6] for r in got) and layouts["nocol"] == "synthetic"


def _shuffle_keys(df):
    return re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", physical_plan(df, "simple"))


@pytest.mark.parametrize("query", ["p8_stage_air", "p7_stage_wind"])
def test_staging_needs_no_shuffle_of_cells(spark, query):
    """Readings find their cells in the sheet's rows: neither the grid of rows and columns nor the cells are dealt again."""
    keys = _shuffle_keys(QUERIES[query](spark, SF_SMALL))
    assert keys and not any("sheet_row" in k or "col#" in k for k in keys)


def test_staged_blanks_repeats_and_gaps(spark):
    """Each mapped column of a timed row gives a reading for each of its cells, or one without a value."""
    site = lambda n: f"S{n} AQM Site"
    top = [("f", 3, c, site(c)) for c in (1, 2, 4, 6)] + [("f", 4, 1, "NO2"), ("f", 1, 3, "x")]
    data = [("f", 6, 0, "1/2/2020 5:00"), ("f", 6, 2, "7"), ("f", 6, 3, "8"), ("f", 6, 4, "9"), ("f", 6, 4, "10"), ("f", 6, 9, "11")]
    data += [("f", 7, 0, "2/2/2020 5:00"), ("f", 7, 0, "3/2/2020 5:00"), ("f", 7, -1, "4"), ("f", 7, 6, "12")]
    data += [("f", 8, 0, "no date"), ("f", 8, 1, "1"), ("f", 9, 1, "1"), ("f", 5, 0, "1/1/2020 1:00"), ("f", None, 0, "1/1/2020 1:00")]
    data += [(None, 6, 0, "1/2/2020 5:00"), ("g", 6, 0, "1/2/2020 5:00"), ("f", 10, 0, "4/2/2020 5:00"), ("f", 10, None, "5")]
    aliases = spark.createDataFrame([(site(c), c * 10) for c in (1, 2, 4)], "alias string, station_pk long")
    got = P.stage_air(_cells(spark, top + data), aliases, F.lit("no2")).collect()
    found = sorted((r.sheet_row, r.datetime.day, r.station_pk, r.col, r.value is not None, r.value or 0) for r in got)
    expected = [(6, 1, 10, 1, False, 0), (6, 1, 20, 2, True, 7), (6, 1, 40, 4, True, 9), (6, 1, 40, 4, True, 10)]
    expected += [(row, day, c * 10, c, False, 0) for row, day in ((7, 2), (7, 3), (10, 4)) for c in (1, 2, 4)]
    assert found == sorted(expected)


def test_lines_are_dealt_after_the_parts_have_joined(spark):
    """With parts too many to broadcast a line is shuffled by part and by sheet, once each."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "6000")  # more than the suppliers, less than the parts
        keys = _shuffle_keys(QUERIES["j7_unknown_stations"](spark, SF_MID))
    finally:
        spark.conf.set(name, before)
    assert sorted(k.split("#")[0] for k in keys) == ["file", "file", "l_partkey", "p_partkey"]  # with parts and orders


@pytest.mark.parametrize("kind", ["wind", "air"])
def test_parts_of_the_deal_hold_a_bounded_number_of_lines(spark, monkeypatch, kind):
    monkeypatch.setattr(sheets, "DEALT", 1000)
    n = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    cells = sheets.wind_sheets(spark, SF_SMALL) if kind == "wind" else sheets.air_sheets(spark, SF_SMALL)
    assert cells.rdd.getNumPartitions() == -(-n // 1000) > spark.sparkContext.defaultParallelism


def test_keys_that_repeat(spark, tmp_dir):
    """Of repeated lines the least counts, also when its part is missing; repeated parts give the greatest text, or a reading each."""
    from stratus import registry
    from stratus.sources.drivertables import TABLE_SCHEMAS

    def write(name, rows):
        spark.createDataFrame(rows, TABLE_SCHEMAS[name].replace("timestamp_ntz", "string")).select(
            *[F.col(c.split()[0]).cast(c.split()[1]) for c in TABLE_SCHEMAS[name].split(", ")]
        ).write.parquet(f"{tmp_dir}/{name}.parquet")

    line = lambda order, part, n: (order, part, 1, n, 5.0, 1.0, 0.1, 0.01, "A", "O", "2020-01-02 03:00:00")
    write("lineitem", [line(1, 1, 1), line(1, 1, 1), line(1, 2, 1), line(1, 9, 2), line(1, 3, 3), line(1, 8, 3), line(2, 0, 1), line(2, 1, 1), line(None, 1, 1)])
    write("part", [(1, "a", "b", "ECONOMY", 1, 1.0), (1, "a", "b", "STANDARD", 1, 1.0), (2, "a", "b", "LARGE", 1, 1.0), (3, "a", "b", None, 1, 1.0), (None, "a", "b", "SMALL", 1, 1.0)])
    write("supplier", [(1, "S", 1, 1.0)])
    write("orders", [(k, 1, "F", 1.0, "2020-01-01 00:00:00", "x") for k in (1, 2)])
    header = P.wind_header(sheets.wind_sheets(spark, tmp_dir)).collect()
    assert [(r.file, r.col, r.param) for r in header] == [("wind_1.xlsx", 1, "Wind Speed V")]
    found = sorted((r.l_orderkey, r.l_linenumber, str(r.metric)) for r in registry._raw_readings(spark, tmp_dir).collect())
    assert found == [(1, 1, "no2"), (1, 1, "wind_direction"), (1, 3, "None")]
