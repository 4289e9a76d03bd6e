"""Quality thresholds and edge cases (T9, T16, F8) and report properties."""
import datetime as dt


from stratus.operators import quality as A
from stratus.sources.drivertables import lineitem_fact
from tests.conftest import SF_SMALL

SCHEMA = "timestamp timestamp_ntz, station_fk int, metric string, value double, source string, quality_flag string"


def _rows(metric, n_null, n_valid):
    t = dt.datetime(2020, 1, 1)
    rows = [(t, 1, metric, None, "air_quality", "NODATA")] * n_null
    rows += [(t, 1, metric, 1.0, "air_quality", "VALID")] * n_valid
    return rows


def test_thresholds_t9(spark):
    # 50.004 % missing: rounds to 50.0 (not > 50) but the raw share is > 50
    rows = _rows("no2", 12501, 12499)
    f = spark.createDataFrame(rows, SCHEMA)
    assert A.high_null_metrics(f).count() == 0
    low = A.low_quality_metrics(f).collect()
    assert [(r.metric, r.nodata_pct) for r in low] == [("no2", 50.0)]


def test_all_null_metric_t16(spark):
    f = spark.createDataFrame(_rows("o3", 3, 0), SCHEMA)
    r = A.value_ranges(f).first()
    assert (r.total, r.non_null, r["min"], r["max"], r["avg"], r.median) == (3, 0, None, None, None, None)


def test_empty_fact_rates_zero(spark):
    f = spark.createDataFrame([], SCHEMA)
    assert A.null_rates(f).first().null_pct == 0.0
    assert A.dq_issues(f).count() == 0


def test_counts_sum_to_total(spark):
    f = lineitem_fact(spark, SF_SMALL)
    total = f.count()
    assert sum(r["count"] for r in A.counts_by(f, "source").collect()) == total
    assert sum(r["count"] for r in A.share_of_total(f).collect()) == total
    assert abs(sum(r.percentage for r in A.share_of_total(f).collect()) - 100.0) < 0.02


def test_coverage_hours(spark):
    t = dt.datetime(2020, 1, 1, 5, 30)
    rows = [(t, 1, "no2", 1.0, "air_quality", "VALID"), (t.replace(minute=45), 1, "no2", 1.0, "air_quality", "VALID"),
            (t.replace(day=2), 1, "no2", 1.0, "air_quality", "VALID"), (None, 1, "no2", 1.0, "air_quality", "VALID")]
    r = A.coverage(spark.createDataFrame(rows, SCHEMA)).first()
    assert (r.days_covered, r.hours_covered) == (2, 2)
