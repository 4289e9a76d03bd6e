"""Loads: key filter, keys without a checkpoint, one write of split rows, order checks."""
import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stratus.operators import clean as P
from stratus.operators import load as L
from stratus.operators import profile as E
from stratus.operators import tall as TL
from stratus.plans.checks import executed_scans, physical_plan
from stratus.registry import QUERIES, _deliveries
from stratus.sources import reference
from stratus.sources.drivertables import lineitem_fact
from tests.conftest import SF_SMALL

KEYS = "timestamp timestamp_ntz, station_fk int, metric string, source string, value double"


def test_key_filter_spares_the_untouched(spark):
    """Rows whose key is not in the batch are kept where they are read; every matching row is let through."""
    current = spark.range(20000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    batch = current.filter("k % 400 = 0").withColumn("v", F.lit(-1).cast("long")).unionByName(spark.createDataFrame([(None, 5)], "k long, v long"))
    flagged = L.may_be_replaced(current, batch, ["k"])
    hits = {r.k for r in flagged.filter("__hit").collect()}
    assert {k for k in range(0, 20000, 400)} <= hits and len(hits) < 60
    out = L.upsert_fact(current, batch, ["k"])
    assert out.count() == 20001 and out.filter("v = -1").count() == 50
    wide = batch.withColumn("k", F.col("k").cast("int"))  # another integer type of the key
    assert L.replaced_rows(current, wide, ["k"]).count() == 50
    assert L.key_filter(current, ["k"]).count() <= 2 ** (L.FILTER_BITS - 6)


def test_missing_key_parts_never_match(spark):
    rows = [(None, 1, "m", None, 1.0), (None, 1, "m", "s", 2.0)]
    df = spark.createDataFrame(rows, KEYS)
    assert L.may_be_replaced(df, df).filter("__hit").count() == 0
    assert L.upsert_fact(df, df).count() == 4 and L.fact_load_stats(df, df).first().deleted == 0
    empty = df.filter("false")
    assert L.upsert_fact(empty, df).count() == 2 and L.upsert_fact(df, empty).count() == 2
    assert tuple(L.fact_load_stats(empty, empty).first()) == (0, 0, 0)


def test_deliveries_replace_values_and_pile_up_unsourced_rows(spark):
    current, batch = _deliveries(spark, SF_SMALL)
    replaced = L.replaced_rows(current, batch)
    assert replaced.count() > 0 and replaced.filter("source IS NULL").count() == 0
    assert batch.filter("source IS NULL").count() > 0
    left = L.upsert_fact(current, batch)
    keys = ["timestamp", "station_fk", "metric", "source"]
    old = left.join(replaced.select(*keys, F.col("value").alias("old")).distinct(), keys).filter("value = old")
    new = batch.join(replaced.select(*keys, F.col("value").alias("old")).distinct(), keys).filter("value = old")
    assert old.count() == new.count()  # no replaced reading is left but what the delivery itself holds
    assert executed_scans(QUERIES["l4_fact_load_stats"](spark, SF_SMALL)) <= 2


def test_keys_survive_a_second_run(spark):
    """The ranges are literals: running the plan again, dealt otherwise, gives every row the same key."""
    f = lineitem_fact(spark, SF_SMALL)
    keyed = L.assign_keys(f, f.columns, start=7)
    assert "Checkpoint" not in physical_plan(keyed) and "Scan ExistingRDD" not in physical_plan(keyed)
    first = sorted(map(tuple, keyed.select("measurement_pk", "station_fk", "timestamp", "metric", F.col("value").cast("string")).collect()), key=str)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "11")
        again = sorted(map(tuple, keyed.select("measurement_pk", "station_fk", "timestamp", "metric", F.col("value").cast("string")).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert first == again and {r[0] for r in first} == set(range(8, 8 + len(first)))


def test_range_bounds_split_a_hot_value(spark):
    """A value that most rows share is cut by the columns after it; NULLs come last."""
    df = spark.range(4000).select(F.when(F.col("id") % 4 > 0, F.lit("hot")).alias("a"), F.col("id").alias("b"))
    bounds = L.range_bounds(df, ["a", "b"], 16)
    sizes = [r["count"] for r in df.withColumn("p", L.range_of(df, ["a", "b"], bounds)).groupBy("p").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2.5 * 4000 / 16
    keyed = L.assign_keys(df, ["a", "b"], partitions=16)
    assert keyed.filter("a IS NULL").agg(F.min("measurement_pk")).first()[0] == 3001
    assert L.assign_keys(df.filter("false"), ["a", "b"]).count() == 0


def test_split_rows_are_written_once(spark, tmp_dir):
    rows = [(1, 1, "no2", 5.0), (None, 1, "no2", 5.0), (1, None, "no2", 900.0), (1, 1, None, 1.0), (1, 1, "noise", 1e9)]
    df = spark.createDataFrame(rows, "datetime int, station_pk int, metric string, value double")
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    seen = P.write_split(df.mapInArrow(counted, df.schema), reference.metric_ranges(spark), tmp_dir)
    assert seen == {"rows": 5, "ok": 2, "rejected": 3} and reads.value == 5
    folders = {d for d in os.listdir(tmp_dir) if d.startswith("reason=")}
    assert len(folders) == 4 and "reason=ok" in folders
    back = spark.read.parquet(tmp_dir)
    assert {r.reason: r["count"] for r in back.groupBy("reason").count().collect()} == {
        "ok": 2, "missing_datetime": 1, "missing_station_pk;out_of_range": 1, "missing_metric": 1,
    }


def test_every_reason_occurs(spark):
    reasons = {r.reason for r in QUERIES["p16_rejection_counts"](spark, SF_SMALL).collect()}
    parts = {x for r in reasons for x in r.split(";")}
    assert {"ok", "missing_datetime", "missing_metric", "out_of_range"} <= parts


def test_sortedness_finds_disorder(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("a"), F.col("id").alias("b"))
    keys = ("a", "b")
    good = TL.sortedness(df.orderBy("a", "b"), keys).first()
    assert tuple(good) == (1000, 0, 0)
    apart = TL.sortedness(df.repartition(4, "b").sortWithinPartitions("a", "b"), keys).first()
    assert apart.inversions == 0 and apart.overlaps == 3
    assert TL.sortedness(df.coalesce(1), keys).first().inversions == 99
    assert tuple(TL.sortedness(df.filter("false"), keys).first()) == (0, 0, 0)


def test_equal_prints_do_not_make_equal_rows(spark, monkeypatch):
    """Duplicates are decided on values: with prints that always agree the count stays right."""
    rows = [("f", 1, "a"), ("f", 1, "a"), ("f", 2, None), ("f", None, "2"), ("g", 1, "a"), ("g", None, None), ("g", None, None)]
    df = spark.createDataFrame(rows, "file string, x int, y string")
    want = [("f", 4, 2, 1, 2), ("g", 3, 2, 1, 2)]
    read = lambda: [tuple(r)[:5] for r in E.file_overview(df).collect()]
    assert read() == want
    monkeypatch.setattr(E, "row_prints", lambda columns: (F.lit(1), F.lit(2)))
    assert read() == want


@pytest.mark.parametrize("name", ["a9_high_null_sparse", "a12_low_quality_sparse", "j2_duplicate_nations", "e14_missing_years", "b8_daily_correlation_nations"])
def test_checks_that_must_find_something(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() > 0


def test_all_issue_kinds_occur(spark):
    assert QUERIES["a14_dq_issues_sparse"](spark, SF_SMALL).count() == 4
    assert QUERIES["j1_missing_metadata_facts"](spark, SF_SMALL).first().missing_metadata >= 0


def test_ranges_compare_columns_not_structs(spark):
    """Rows are dealt to ranges by few plain comparisons, in the same order as a sort by the columns."""
    nan, inf = float("nan"), float("inf")
    rows = [(a, v, s) for a in (None, 1, 2) for v in (None, nan, inf, -inf, -0.0, 0.0, 1.5) for s in (None, "", "x", "y")] * 3
    df = spark.createDataFrame(rows, "a int, v double, s string")
    names = ["a", "v", "s"]
    bounds = L.range_bounds(df, names, 20)
    part = df.withColumn("p", L.range_of(df, names, bounds))
    assert "struct" not in physical_plan(part, "simple")
    place = F.row_number().over(Window.orderBy(*[F.asc_nulls_last(n) for n in names]))
    ordered = [r.p for r in part.withColumn("i", place).orderBy("i").collect()]
    assert ordered == sorted(ordered) and len(set(ordered)) > 10
    keyed = L.assign_keys(df, names, partitions=20).withColumn("i", place)
    same = keyed.groupBy(*names).agg(F.sum("i").alias("i"), F.sum("measurement_pk").alias("k"))
    assert same.filter("i <> k").count() == 0


def test_short_bounds():
    bounds = [(1, "a", 5), (1, "b", 1), (1, "b", 2), (2, "a", 1), (7, "c", 1), (None, "a", 1)]
    assert L.short_bounds(bounds) == [(1, "a"), (1, "b", 1), (1, "b", 2), (2,), (7,), (None,)]
    assert L.short_bounds([]) == [] and L.short_bounds([(3, 4)]) == [(3,)]
