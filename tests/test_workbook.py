"""Raw spreadsheets -> cells -> clean measurements (S1, S2, P1-P12, J7; traps T1-T5, T18, T20)."""
import datetime as dt
import os

from pyspark.sql import functions as F

from stratus.operators import clean as P
from stratus.operators.tall import to_wide
from stratus.sources import reference
from stratus.sources.workbook import archive_cells, expand_archives, read_grid
from tests import xlsx

WIND = {
    (0, 0): "Wind data 2019 (hourly)",
    (2, 0): "Date & Time", (2, 1): "Atlantis AQM Site", (2, 3): "Somerset-West AQM Site", (2, 4): "Nowhere Site",
    (3, 1): "Wind Dir V", (3, 2): "Wind Speed V", (3, 3): "Wind Speed V", (3, 4): "Wind Speed V",
    (4, 1): "Deg", (4, 2): "m/s", (4, 3): "m/s", (4, 4): "m/s",
    (5, 0): "2019-01-01 00:00", (5, 1): 361, (5, 2): 3.5, (5, 3): -1, (5, 4): 2,
    (6, 0): "2019-01-01 01:00", (6, 1): 0, (6, 2): "NoData", (6, 3): 200, (6, 4): 2,
    (7, 0): "Minimum", (7, 1): 1, (7, 2): 1, (7, 3): 1, (7, 4): 1,
}

AIR_STANDARD = {
    (0, 0): "MultiStation: Periodically report",
    (3, 0): "Date & Time", (3, 1): "Bellville South AQM Site", (3, 2): "Foreshore AQM Site", (3, 3): "Unknown Place",
    (4, 1): "NO2", (4, 2): "NO2", (4, 3): "NO2",
    (5, 1): "ug/m3", (5, 2): "ug/m3", (5, 3): "ug/m3",
    (6, 0): "31/12/2019 23:00", (6, 1): "12.5", (6, 2): "-3", (6, 3): "1",
    (7, 0): "1/2/2019 0:00", (7, 1): "<Samp", (7, 2): "1e3", (7, 3): "1",
    (8, 0): "31/12/2019 24:00", (8, 1): "5", (8, 2): "5",
    (9, 0): "2/2/2019 1:00", (9, 1): "Down", (9, 2): "RS232",
    (10, 0): "2/2/2019 2:00", (10, 1): "Zero", (10, 2): "Calib",
    (11, 0): "2/2/2019 3:00", (11, 1): "InVld", (11, 2): "NaN",
    (12, 0): "2/2/2019 4:00", (12, 1): "1d", (12, 2): " ",
}

AIR_SHIFTED = {
    (0, 0): "MultiStation: Periodically report",
    (2, 0): "Date & Time", (2, 1): "Bellville South AQM Site", (2, 2): "Foreshore AQM Site",
    (3, 1): "NO2", (3, 2): "NO2",
    (4, 1): "ug/m3", (4, 2): "ug/m3",
    (5, 0): "31/12/2019 23:00", (5, 1): "7", (5, 2): "8",
}


def _write(tmp_dir, name, cells):
    path = os.path.join(tmp_dir, name)
    with open(path, "wb") as fh:
        fh.write(xlsx.workbook(cells))
    return path


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_read_grid_cells(spark, tmp_dir):
    _write(tmp_dir, "wind_2019.xlsx", WIND)
    cells = read_grid(spark, tmp_dir)
    assert cells.schema.names == ["file", "sheet_row", "col", "text", "kind"]
    got = {(r.sheet_row, r.col): (r.text, r.kind) for r in cells.collect()}
    assert got[(2, 1)] == ("Atlantis AQM Site", "s")
    assert got[(5, 2)] == ("3.5", "n")
    assert (2, 2) not in got  # blank cells are absent


def test_wind_header_carry_and_unknown(spark, tmp_dir):
    _write(tmp_dir, "wind_2019.xlsx", WIND)
    cells = read_grid(spark, tmp_dir)
    hdr = P.wind_header(cells)
    assert _rows(hdr, ["col", "station", "param"]) == [
        (1, "Atlantis AQM Site", "Wind Dir V"),
        (2, "Atlantis AQM Site", "Wind Speed V"),  # carried right
        (3, "Somerset West AQM Site", "Wind Speed V"),  # hyphen variant normalised
        (4, "Nowhere Site", "Wind Speed V"),
    ]
    unknown = P.unknown_stations(hdr, reference.station_aliases(spark))
    assert [r.station for r in unknown.collect()] == ["Nowhere Site"]


def test_stage_wind_values(spark, tmp_dir):
    _write(tmp_dir, "wind_2019.xlsx", WIND)
    long = P.stage_wind(read_grid(spark, tmp_dir), reference.station_aliases(spark))
    got = _rows(long, ["datetime", "station_pk", "metric", "value"])
    t0, t1 = dt.datetime(2019, 1, 1, 0, 0), dt.datetime(2019, 1, 1, 1, 0)
    assert got == sorted([
        (t0, 1, "wind_direction", None),  # 361 out of range
        (t0, 1, "wind_speed", 3.5),
        (t0, 6, "wind_speed", None),  # negative speed
        (t1, 1, "wind_direction", 0.0),
        (t1, 1, "wind_speed", None),  # NoData
        (t1, 6, "wind_speed", 200.0),  # no upper bound for speed
    ], key=lambda x: (x[0], x[1], x[2]))
    wide = to_wide(P.staged_columns(long), ["station_1_wind_direction", "station_1_wind_speed", "station_6_wind_speed"])
    assert wide.columns == ["datetime", "station_1_wind_direction", "station_1_wind_speed", "station_6_wind_speed"]
    assert wide.count() == 2  # 'Minimum' row dropped (no date)


def test_stage_air_standard(spark, tmp_dir):
    _write(tmp_dir, "2019_NO2_CCT.xlsx", AIR_STANDARD)
    cells = read_grid(spark, tmp_dir)
    hdr = P.air_header(cells)
    assert {r.data_start for r in hdr.collect()} == {6}  # frame row 5 + consumed header row
    from stratus.functions import pollutant_from_filename

    long = P.stage_air(cells, reference.station_aliases(spark), pollutant_from_filename(F.col("file")))
    got = {(r.datetime, r.station_pk): r.value for r in long.collect()}
    assert got[(dt.datetime(2019, 12, 31, 23, 0), 2)] == 12.5
    assert got[(dt.datetime(2019, 12, 31, 23, 0), 8)] == -3.0  # no range rule for air
    assert got[(dt.datetime(2019, 2, 1, 0, 0), 2)] is None  # <Samp
    assert got[(dt.datetime(2019, 2, 1, 0, 0), 8)] == 1000.0  # 1e3
    for hour in (1, 2, 3, 4):
        assert got[(dt.datetime(2019, 2, 2, hour, 0), 2)] is None
        assert got[(dt.datetime(2019, 2, 2, hour, 0), 8)] is None
    assert all(k[0] != dt.datetime(2020, 1, 1) for k in got)  # 24:00 dropped
    assert {r.metric for r in long.collect()} == {"no2"}
    assert {k[1] for k in got} == {2, 8}  # unknown station skipped


def test_stage_air_shifted_fallback(spark, tmp_dir):
    _write(tmp_dir, "2020_NO2_CCT.xlsx", AIR_SHIFTED)
    cells = read_grid(spark, tmp_dir)
    hdr = P.air_header(cells)
    rows = hdr.collect()
    assert {r.param for r in rows} == {"Unknown"}
    assert {r.data_start for r in rows} == {3}  # best frame row 1, data from frame 2 (sheet 3)
    long = P.stage_air(cells, reference.station_aliases(spark), F.lit("no2"))
    assert _rows(long, ["station_pk", "value"]) == [(2, 7.0), (8, 8.0)]


def test_expand_archives_member_filter(spark, tmp_dir):
    members = {
        "2019/2019_NO2_CCT.xlsx": xlsx.workbook(AIR_STANDARD),
        "2019/2019_CO_CCT.xlsx": xlsx.workbook(AIR_STANDARD),  # CO never reaches staging through a ZIP
        "2019/readme.txt": b"hello",
    }
    with open(os.path.join(tmp_dir, "air_quality_2019.zip"), "wb") as fh:
        fh.write(xlsx.archive(members))
    m = expand_archives(spark, tmp_dir)
    assert [r.member for r in m.collect()] == ["2019_NO2_CCT.xlsx"]
    cells = archive_cells(m)
    assert cells.filter(F.col("text") == "Bellville South AQM Site").count() == 1


def test_serial_dates_become_iso(spark, tmp_dir):
    cells = dict(WIND)
    cells[(5, 0)] = dt.datetime(2019, 1, 1, 0, 0)
    _write(tmp_dir, "wind_2019.xlsx", cells)
    grid = read_grid(spark, tmp_dir)
    r = grid.filter((F.col("sheet_row") == 5) & (F.col("col") == 0)).first()
    assert (r.text, r.kind) == ("2019-01-01 00:00:00", "d")
    long = P.stage_wind(grid, reference.station_aliases(spark))
    assert long.filter(F.col("datetime") == dt.datetime(2019, 1, 1)).count() == 3


def test_wind_dates_one_format_per_file(spark, tmp_dir):
    """The first text timestamp decides the file's format; ambiguous dates read month-first."""
    cells = {k: v for k, v in WIND.items() if k[0] < 5}
    cells.update({(5, 0): "2/1/2019 0:00", (5, 1): 10, (6, 0): "13/1/2019 1:00", (6, 1): 20,
                  (7, 0): "2019-01-03 02:00", (7, 1): 30})
    _write(tmp_dir, "wind_2019.xlsx", cells)
    long = P.stage_wind(read_grid(spark, tmp_dir), reference.station_aliases(spark))
    got = {r.datetime: r.value for r in long.filter(F.col("metric") == "wind_direction").collect()}
    # read month-first as 1 February; '13/1' does not fit M/d/yyyy, nor does the ISO row -> dropped
    assert got == {dt.datetime(2019, 2, 1, 0, 0): 10.0}
