"""Results must not depend on the number of partitions."""
import pytest

from stratus.registry import QUERIES
from tests import compare as C
from tests.conftest import SF_SMALL

NAMES = ["v3_quality", "a10_value_ranges_events", "b5_box_wind", "l5_assign_keys", "b1_metric_coverage",
         "p15_normalise", "j8_latest"]


@pytest.mark.parametrize("name", NAMES)
def test_partition_count_independent(spark, name):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = QUERIES[name](spark, SF_SMALL).toPandas()
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        eight = QUERIES[name](spark, SF_SMALL).toPandas()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert C.compare(one, eight) == []
