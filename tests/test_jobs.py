"""End to end: raw workbooks and archives -> staged -> normalised -> warehouse -> reports."""
import os

from pyspark.sql import functions as F

from stratus import jobs
from tests import xlsx
from tests.test_workbook import AIR_STANDARD, WIND


def test_end_to_end(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    with open(os.path.join(raw, "wind_2019.xlsx"), "wb") as fh:
        fh.write(xlsx.workbook(WIND))
    with open(os.path.join(raw, "air_quality_2019.zip"), "wb") as fh:
        fh.write(xlsx.archive({"2019_NO2_CCT.xlsx": xlsx.workbook(AIR_STANDARD), "notes.txt": b"x"}))
    staged, norm, wh = (os.path.join(tmp_dir, d) for d in ("staged", "normalised", "warehouse"))

    jobs.stage_wind_files(spark, raw, staged)
    jobs.stage_air_archives(spark, raw, staged)
    st = spark.read.parquet(staged)
    assert st.filter(F.col("source") == "wind").count() == 6
    assert st.filter(F.col("source") == "air_quality").count() == 12
    assert {r.pollutant for r in st.select("pollutant").distinct().collect()} == {"wind", "no2"}

    jobs.normalise_staged(spark, staged, norm)
    tall = spark.read.parquet(norm)
    assert tall.count() == 18
    assert tall.filter(F.col("station_code").isNull()).count() == 0

    stats = jobs.load_warehouse(spark, norm, wh)
    assert stats["dimension"]["total_stations"] == 11
    fact, dim = jobs.warehouse(spark, wh)
    assert fact.count() == 18 and dim.count() == 11
    ok = jobs.integrity_report(spark, wh).first()
    assert ok.integrity_ok

    jobs.load_warehouse(spark, norm, wh)  # reload: idempotent
    fact, _ = jobs.warehouse(spark, wh)
    assert fact.count() == 18
    assert fact.select("measurement_pk").distinct().count() == 18
    suite = jobs.quality_suite(spark, wh)
    assert suite["summary"].first().total_measurements == 18
    assert suite["value_ranges"].count() == 3


def test_command_line(spark, tmp_dir, capsys):
    from stratus.__main__ import main

    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    with open(os.path.join(raw, "wind_2019.xlsx"), "wb") as fh:
        fh.write(xlsx.workbook(WIND))
    staged, norm, wh = (os.path.join(tmp_dir, d) for d in ("staged", "normalised", "warehouse"))
    assert main(["stage-wind", raw, staged]) == 0
    assert main(["normalise", staged, norm]) == 0
    assert main(["load", norm, wh]) == 0
    assert main(["verify", wh]) == 0
    assert '"integrity_ok": true' in capsys.readouterr().out
