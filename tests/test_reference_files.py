"""Reference tables from JSON files, their validation, and their effect on P11, P16 and A10."""
import json
import os

import pytest
from pyspark.sql import functions as F

from stratus.operators import clean as P
from stratus.operators import quality as A
from stratus.sources import reference

DOC = {
    "stations": [
        {"station_pk": 1, "station_code": "A", "station_name": "Alpha", "normalised_names": ["Alpha", "Alpha-1"], "location_type": "AQM", "extra": 1},
        {"station_pk": 2, "station_code": "B", "station_name": "Beta", "normalised_names": [], "description": "no alias"},
    ],
    "metrics": [
        {"metric_code": "no2", "metric_name": "Dioxide", "unit": "ppb", "valid_range": [0, 40]},
        {"metric_code": "wind_speed", "unit": "m/s", "valid_range": [0.5, None]},
        {"metric_code": "noise"},
    ],
    "quality_flags": [{"flag_code": "VALID", "description": "fine"}],
    "expected_ranges": [{"metric": "no2", "min": 5.0, "max": 30.0}],
}


def _write(path, *docs, lines=False):
    with open(os.path.join(path, "reference.json"), "w") as f:
        f.write("\n".join(json.dumps(d) for d in docs) if lines else json.dumps(docs[0], indent=2))
    return path


def _problems(spark, tmp_dir, doc):
    return sorted(map(tuple, reference.read_reference(spark, _write(tmp_dir, doc)).problems().collect()))


def test_tables_of_a_document(spark, tmp_dir):
    doc = json.loads(json.dumps(DOC))
    doc["metrics"][1]["valid_range"] = [0.5, 60]
    ref = reference.read_reference(spark, _write(tmp_dir, doc)).check()
    assert [tuple(r) for r in ref.aliases().orderBy("alias").collect()] == [("Alpha", 1, "A", "Alpha"), ("Alpha-1", 1, "A", "Alpha")]
    assert ref.range_rules() == {"no2": (0.0, 40.0), "wind_speed": (0.5, 60.0), "noise": (None, None)}
    assert ref.expected() == [("no2", 5.0, 30.0)] and ref.quality_flags.count() == 1
    fact = spark.createDataFrame([("no2", 50.0), ("no2", 20.0), ("no2", 4.0), ("wind_speed", 0.2), ("noise", -9.0)], "metric string, value double")
    kept = fact.select(P.apply_range_rules(F.col("metric"), F.col("value"), ref.range_rules()).alias("v")).filter("v IS NOT NULL")
    assert sorted(r.v for r in kept.collect()) == [-9.0, 4.0, 20.0]
    row = A.value_ranges(fact, ref.expected()).first()
    assert (row.metric, row.below_min, row.above_max, row.expected_max) == ("no2", 1, 1, 30.0)
    rows = fact.withColumns({"datetime": F.current_timestamp(), "station_pk": F.lit(1)})
    got = {r.reason: r.rows for r in P.rejection_counts(rows, reference.ranges_of(ref.metrics)).collect()}
    assert got == {"ok": 3, "out_of_range": 2}


def test_lists_of_several_documents_add_up(spark, tmp_dir):
    more = {"stations": [{"station_pk": 3, "station_code": "C", "station_name": "Gamma", "normalised_names": ["G"]}]}
    ref = reference.read_reference(spark, _write(tmp_dir, {"stations": DOC["stations"]}, more, lines=True), multiline=False).check()
    assert ref.stations.count() == 3 and ref.metrics.count() == 0 and ref.range_rules() == {} and ref.expected() == []


@pytest.mark.parametrize(
    ("part", "row", "found"),
    [
        ("stations", {"station_pk": 2, "station_code": "C", "station_name": "C", "normalised_names": ["C"]}, ("repeated station key", "2")),
        ("stations", {"station_pk": 9, "station_code": "C", "station_name": "C", "normalised_names": ["Alpha"]}, ("repeated alias", "Alpha")),
        ("metrics", {"metric_code": "no2"}, ("repeated metric", "no2")),
        ("metrics", {"metric_code": "x", "valid_range": [1.0]}, ("range is no pair", "x")),
        ("metrics", {"metric_code": "x", "valid_range": [2.0, 1.0]}, ("range runs backwards", "x")),
        ("expected_ranges", {"metric": "y", "min": 2.0, "max": 1.0}, ("range runs backwards", "y")),
        ("expected_ranges", {"metric": "no2", "min": 0.0, "max": 1.0}, ("repeated expected range", "no2")),
    ],
)
def test_problems(spark, tmp_dir, part, row, found):
    doc = json.loads(json.dumps(DOC))
    doc["metrics"][1]["valid_range"] = None
    assert _problems(spark, tmp_dir, doc) == []
    doc[part].append(row)
    assert _problems(spark, tmp_dir, doc) == [found]
    with pytest.raises(ValueError, match=found[0]):
        reference.read_reference(spark, tmp_dir).check()


def test_ranges_apart_and_broken_documents(spark, tmp_dir):
    doc = json.loads(json.dumps(DOC))
    doc["expected_ranges"][0] = {"metric": "no2", "min": 41.0, "max": 50.0}
    assert _problems(spark, tmp_dir, doc) == [("range is no pair", "wind_speed"), ("ranges do not overlap", "no2")]
    with open(os.path.join(tmp_dir, "reference.json"), "w") as f:
        f.write('{"stations": [')
    assert [r.kind for r in reference.read_reference(spark, tmp_dir).problems().collect()] == ["corrupt document"]
