"""Layer IO (S3-S6, S8) and the continuous load (foreachBatch upsert)."""
import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from stratus.operators import load as L
from stratus.operators import quality as A
from stratus.schemas import TALL, TALL_COLUMNS
from stratus.sources.files import read_layer, with_source, write_tall
from stratus.streaming import load_batch, load_stream


def _tall_rows(hours, station=1, metric="no2", value=1.0):
    out = []
    for h in hours:
        out.append((dt.datetime(2020, 1, 1, h), station, "ATLAN001", "Atlantis AQM Site", "AQM", metric,
                    "ug/m3(S)", value, "VALID", "air_quality"))
    return out


def _write_file(path, rows):
    cols = list(zip(*rows)) if rows else [[] for _ in TALL_COLUMNS]
    table = pa.table({c: list(v) for c, v in zip(TALL_COLUMNS, cols)})
    table = table.cast(pa.schema([
        ("datetime", pa.timestamp("us")), ("station_pk", pa.int64()), ("station_code", pa.string()),
        ("station_name", pa.string()), ("location_type", pa.string()), ("metric", pa.string()),
        ("unit", pa.string()), ("value", pa.float64()), ("quality_flag", pa.string()), ("source", pa.string()),
    ]))
    pq.write_table(table, path)


def test_read_layer_and_with_source(spark, tmp_dir):
    _write_file(os.path.join(tmp_dir, "air_quality_no2_2020_normalised.parquet"), _tall_rows([0, 1]))
    _write_file(os.path.join(tmp_dir, "wind_2019_normalised.parquet"), _tall_rows([2], metric="wind_speed"))
    _write_file(os.path.join(tmp_dir, "other.parquet"), _tall_rows([3]))
    df = with_source(read_layer(spark, tmp_dir, "*_normalised.parquet", schema=TALL))
    got = sorted({(r.file, r.year, r.pollutant) for r in df.collect()})
    assert got == [("air_quality_no2_2020_normalised.parquet", "2020", "no2"),
                   ("wind_2019_normalised.parquet", "2019", None)]
    assert L.rows_per_file(df).count() == 2


def test_write_tall_partitions(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    _write_file(os.path.join(src, "a.parquet"), _tall_rows(range(5)))
    df = read_layer(spark, src, schema=TALL).withColumn("year", F.year("datetime").cast("string"))
    out = os.path.join(tmp_dir, "tall")
    write_tall(df, out)
    write_tall(df, out)  # dynamic overwrite: re-running replaces, never appends
    back = spark.read.parquet(out)
    assert back.count() == 5 and set(back.columns) >= {"source", "year"}


def test_stream_load_is_idempotent(spark, tmp_dir):
    src, root, ckpt = (os.path.join(tmp_dir, d) for d in ("src", "table", "ckpt"))
    os.makedirs(src)
    _write_file(os.path.join(src, "f1.parquet"), _tall_rows(range(0, 6)))
    q = load_stream(spark, src, root, ckpt, available_now=True)
    q.awaitTermination(120)
    table = lambda: spark.read.parquet(os.path.join(root, "fact"))
    assert table().count() == 6
    _write_file(os.path.join(src, "f2.parquet"), _tall_rows(range(3, 9), value=2.0))  # overlaps hours 3-5
    q = load_stream(spark, src, root, ckpt, available_now=True)
    q.awaitTermination(120)
    t = table()
    assert t.count() == 9
    assert A.duplicate_keys(t).first().dup_count == 0
    assert t.filter(F.col("value") == 2.0).count() == 6
    keys = [r.measurement_pk for r in t.collect()]
    assert len(set(keys)) == 9 and min(keys) == 1
    # replaying an already loaded batch is a no-op
    replay = spark.read.schema(TALL).parquet(os.path.join(src, "f2.parquet"))
    load_batch(replay, 0, root)
    assert table().count() == 9
