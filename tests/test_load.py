"""Load, upsert and keys (L1-L7, J5, J6; traps T7, T8) on the F5/F6 fixtures."""
import datetime as dt
import os

import pytest

from pyspark.sql import functions as F

from stratus.operators import load as L
from stratus.operators import quality as A
from stratus.sources import reference

def T(text):
    return F.lit(text).cast("timestamp_ntz")


T0, T1 = "2024-01-01 00:00:00", "2024-02-01 00:00:00"
FACT_SCHEMA = ("station_fk int, timestamp timestamp_ntz, metric string, value decimal(12,4), unit string, "
               "source string, quality_flag string")


def _fact(spark, rows):
    return spark.createDataFrame(rows, FACT_SCHEMA)


def _batch(spark):
    t = dt.datetime(2020, 1, 1)
    return _fact(spark, [
        (1, t, "no2", None, "ug/m3(S)", "air_quality", "NODATA"),
        (1, t, "no2", None, "ug/m3(S)", "air_quality", "NODATA"),  # in-batch duplicate
        (2, t, "o3", None, "ug/m3(S)", None, "NODATA"),  # NULL source
        (99, t, "so2", None, "ug/m3(S)", "air_quality", "NODATA"),  # orphan
    ])


def test_reload_is_idempotent_except_null_keys(spark):
    empty = _fact(spark, [])
    b = _batch(spark)
    once = L.upsert_fact(empty, b)
    twice = L.upsert_fact(once, b)
    assert once.count() == 4
    # the duplicate pair is replaced by itself; the NULL-source row piles up
    assert twice.count() == 5
    assert twice.filter(F.col("source").isNull()).count() == 2
    assert A.duplicate_keys(once).first().dup_count == 1  # T8: in-batch duplicate reported
    stats = L.fact_load_stats(once, b).first()
    assert (stats.deleted, stats.inserted, stats.total) == (3, 4, 5)


def test_orphans_and_integrity(spark):
    once = L.upsert_fact(_fact(spark, []), _batch(spark))
    dim = reference.station_dim(spark).withColumn("station_pk", F.col("station_pk").cast("int"))
    assert A.orphan_count(once, dim).first().orphan_count == 1
    v = A.integrity(once, dim).first()
    assert (v.orphan_measurements, v.duplicate_keys, v.null_sources, v.integrity_ok) == (1, 1, 1, False)


def test_assign_keys_dense_and_partition_independent(spark):
    df = spark.range(0, 5000).select((F.col("id") % 97).alias("a"), (F.col("id") % 13).alias("b"))
    order = [F.col("a"), F.col("b")]
    k4 = L.assign_keys(df, order, start=100, partitions=4)
    k1 = L.assign_keys(df, order, start=100, partitions=1)
    keys = sorted(r.measurement_pk for r in k4.collect())
    assert keys == list(range(101, 5101))
    as_set = lambda k: sorted((r.a, r.b, r.measurement_pk) for r in k.collect())
    assert as_set(k4) == as_set(k1)
    # keys follow the order
    rows = sorted(k4.collect(), key=lambda r: r.measurement_pk)
    assert [(r.a, r.b) for r in rows] == sorted((r.a, r.b) for r in rows)


def test_dimension_merge_and_upsert(spark):
    stations = reference.station_dim(spark)
    seeded = L.seed_dim(stations, T(T0))
    assert seeded.count() == 11 and seeded.filter(~F.col("is_active")).count() == 0
    batch = spark.createDataFrame(
        [(1, "ATLAN001", "Atlantis Renamed", "AQM", "renamed"), (12, "NEW00001", "New Site", "AQM", "new")],
        "station_pk int, station_code string, station_name string, location_type string, description string",
    )
    up = L.upsert_dim(seeded, batch, T(T1))
    got = {r.station_pk: r for r in up.collect()}
    assert got[1].station_name == "Atlantis Renamed" and got[1].updated_at == dt.datetime(2024, 2, 1)
    assert got[1].created_at == dt.datetime(2024, 1, 1)
    assert got[12].is_active and got[12].created_at == dt.datetime(2024, 2, 1)
    assert got[5].updated_at == dt.datetime(2024, 1, 1)
    s = L.dim_load_stats(up, batch).first()
    assert (s.stations_inserted, s.stations_updated, s.total_stations) == (1, 1, 2)
    merged = L.merge_dim(stations, batch.withColumn("station_pk", F.col("station_pk").cast("long")))
    m = {r.station_pk: r.station_name for r in merged.collect()}
    assert len(m) == 12 and m[1] == "Atlantis Renamed"


def test_replace_range(spark):
    d = lambda day: dt.datetime(2020, 1, day)
    cur = _fact(spark, [(1, d(1), "no2", None, None, "air_quality", "NODATA"),
                        (1, d(5), "no2", None, None, "air_quality", "NODATA"),
                        (1, d(9), "no2", None, None, "air_quality", "NODATA")])
    new = _fact(spark, [(2, d(4), "no2", None, None, "air_quality", "NODATA"),
                        (2, d(6), "no2", None, None, "air_quality", "NODATA")])
    out = L.replace_range(cur, new)
    assert sorted((r.station_fk, r.timestamp.day) for r in out.collect()) == [(1, 1), (1, 9), (2, 4), (2, 6)]


def test_publish_versions(spark, tmp_dir):
    root = os.path.join(tmp_dir, "fact")
    assert L.read_current(spark, root) is None
    v1 = L.publish(_batch(spark), root)
    first = L.read_current(spark, root)
    assert first.count() == 4
    v2 = L.publish(L.upsert_fact(first, _batch(spark)), root)
    assert v1 != v2 and L.current_version(spark, root) == v2
    assert L.read_current(spark, root).count() == 5
    assert spark.read.parquet(v1).count() == 4  # the old version is untouched


def test_upsert_partitions_touches_only_batch_partitions(spark, tmp_dir):
    table = os.path.join(tmp_dir, "fact_parts")
    d = lambda y: dt.datetime(y, 6, 1)
    rows = [(1, d(2019), "no2", None, None, "air_quality", "NODATA", "2019"),
            (1, d(2020), "no2", None, None, "air_quality", "NODATA", "2020"),
            (2, d(2020), "wind_speed", None, None, "wind", "NODATA", "2020")]
    schema = FACT_SCHEMA + ", year string"
    first = spark.createDataFrame(rows, schema)
    assert sorted(L.upsert_partitions(spark, table, first)) == [
        ("air_quality", "2019"), ("air_quality", "2020"), ("wind", "2020")]
    untouched = os.path.join(table, "source=air_quality", "year=2019")
    before = sorted(os.listdir(untouched))
    again = spark.createDataFrame([rows[1], (3, d(2020), "no2", None, None, "air_quality", "NODATA", "2020")], schema)
    assert L.upsert_partitions(spark, table, again) == [("air_quality", "2020")]
    assert sorted(os.listdir(untouched)) == before  # not rewritten
    back = spark.read.parquet(table)
    assert back.count() == 4
    assert A.duplicate_keys(back).first().dup_count == 0


def _tall(spark, rows):
    from stratus.schemas import TALL

    return spark.createDataFrame(rows, TALL)


def _tall_row(day, pk, source="air_quality", value=1.0, month=6):
    return (dt.datetime(2020, month, day), pk, f"S{pk}", f"Site {pk}", "AQM", "no2", "ug/m3(S)", value, "VALID", source)


def test_unreadable_table_raises_and_keeps_its_rows(spark, tmp_dir):
    table = os.path.join(tmp_dir, "t")
    schema = FACT_SCHEMA + ", year string"
    rows = [(k, dt.datetime(2020, 6, 1), "no2", None, None, "air_quality", "NODATA", "2020") for k in range(5)]
    L.upsert_partitions(spark, table, spark.createDataFrame(rows, schema))
    part = os.path.join(table, "source=air_quality", "year=2020")
    for f in os.listdir(part):
        if f.endswith(".parquet"):
            with open(os.path.join(part, f), "r+b") as h:
                h.seek(-8, 2)
                h.write(b"\0" * 8)
    before = sorted(os.listdir(part))
    with pytest.raises(Exception):
        L.upsert_partitions(spark, table, spark.createDataFrame(rows[:1], schema))
    assert sorted(os.listdir(part)) == before


def test_gate_stops_a_load_before_the_table_changes(spark, tmp_dir):
    table = os.path.join(tmp_dir, "t")
    schema = FACT_SCHEMA + ", year string"
    good = [(1, dt.datetime(2020, 6, 1), "no2", None, None, "air_quality", "NODATA", "2020")]
    dim = spark.createDataFrame([(1,)], "station_pk int")
    L.upsert_partitions(spark, table, spark.createDataFrame(good, schema), gate=L.integrity_gate(dim))
    for bad in ([(9, *good[0][1:])], good * 2, [(1, None, *good[0][2:])]):
        with pytest.raises(L.IntegrityError):
            L.upsert_partitions(spark, table, spark.createDataFrame(bad, schema), gate=L.integrity_gate(dim))
    assert [r.station_fk for r in spark.read.parquet(table).collect()] == [1]
    assert not [n for n in os.listdir(table) if n.startswith(L.SWAP)]


def test_interrupted_swap_is_finished_or_undone(spark, tmp_dir):
    table = os.path.join(tmp_dir, "t")
    schema = FACT_SCHEMA + ", year string"
    row = lambda pk: (pk, dt.datetime(2020, 6, 1), "no2", None, None, "air_quality", "NODATA", "2020")
    L.upsert_partitions(spark, table, spark.createDataFrame([row(1)], schema))
    part = os.path.join("source=air_quality", "year=2020")
    for name, ready in (("_swap-a", False), ("_swap-b", True)):
        fresh = os.path.join(table, name, "new")
        spark.createDataFrame([row(1), row(2)], schema).write.partitionBy("source", "year").parquet(fresh)
        if ready:  # the old folder is already away
            open(os.path.join(table, name, "_READY"), "w").close()
            os.makedirs(os.path.join(table, name, "old", "source=air_quality"))
            os.rename(os.path.join(table, part), os.path.join(table, name, "old", part))
        L.recover_partitions(spark, table, 2)
        assert spark.read.parquet(table).count() == (2 if ready else 1)
    assert os.listdir(table) and not [n for n in os.listdir(table) if n.startswith(L.SWAP)]


def test_stream_and_batch_loads_share_keys_and_replays_add_nothing(spark, tmp_dir):
    from stratus.streaming import upsert as U

    U.load_batch(_tall(spark, [_tall_row(d, 1) for d in range(1, 6)]), 0, tmp_dir)
    table = U.fact_path(tmp_dir)
    fact = lambda: spark.read.parquet(table)
    by_job = L.with_partitions(L.to_fact_rows(_tall(spark, [_tall_row(d, 2) for d in range(1, 5)])))
    keyed = L.assign_keys(by_job, [F.col("timestamp")], L.next_key_start(fact())).withColumn("created_at", F.current_timestamp().cast("timestamp_ntz"))
    L.upsert_partitions(spark, table, keyed, L.PARTITIONS)
    third = _tall(spark, [_tall_row(7, 3), _tall_row(8, 3, source=None)])
    U.load_batch(third, 1, tmp_dir)
    assert fact().count() == 11 and fact().select("measurement_pk").distinct().count() == 11
    # the attempt wrote its rows but not the end of its marker
    marker = U._read_marker(spark, tmp_dir)
    U._write_marker(spark, tmp_dir, batch_id=0, max_key=marker["max_key"] - 2, pending={"batch_id": 1, "start": marker["max_key"] - 2, "n": 2})
    U.load_batch(third, 1, tmp_dir)
    assert fact().count() == 11 and fact().agg(F.max("measurement_pk")).first()[0] == 11
    U.load_batch(third, 1, tmp_dir)
    assert fact().count() == 11


def test_a_load_rewrites_only_its_months(spark, tmp_dir):
    from stratus.streaming import upsert as U

    U.load_batch(_tall(spark, [_tall_row(1, 1, month=m) for m in (5, 6)]), 0, tmp_dir)
    june = os.path.join(U.fact_path(tmp_dir), "source=air_quality", "year=2020", "month=6")
    before = sorted(os.listdir(june))
    U.load_batch(_tall(spark, [_tall_row(2, 1, month=5)]), 1, tmp_dir)
    assert sorted(os.listdir(june)) == before and spark.read.parquet(U.fact_path(tmp_dir)).count() == 3


def test_dimension_upsert_with_repeated_keys_and_empty_attributes(spark):
    seeded = L.seed_dim(reference.station_dim(spark), T(T0))
    schema = "station_pk int, station_code string, station_name string, location_type string, description string"
    batch = spark.createDataFrame([(1, "A", "first", "AQM", None), (1, "B", "second", "AQM", None), (40, None, None, None, None)], schema).coalesce(1)
    got = {r.station_pk: r for r in L.upsert_dim(seeded, batch, T(T1)).collect()}
    assert len(got) == 12 and got[1].station_name == "second" and got[1]["__change"] == "updated"
    assert got[40]["__change"] == "inserted" and got[40].is_active and got[40].created_at == dt.datetime(2024, 2, 1)
