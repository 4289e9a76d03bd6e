"""How often reports read their fact, counted in the plans that ran."""
import pytest

from stratus.plans.checks import executed_scans
from stratus.registry import QUERIES
from tests.conftest import SF_SMALL


@pytest.mark.parametrize(
    ("name", "most"),
    [
        ("a10_value_ranges", 2),  # sketch, then the values inside its bands
        ("a10_value_ranges_events", 2),
        ("e6_describe_numeric", 2),
        ("b5_box_air", 4),  # fact and dimension twice
        ("b5_box_wind", 4),
        ("a11_coverage_levels", 1),
        ("a11_coverage_overall", 1),
        ("b1_metric_coverage", 1),
        ("b4_pollutant_stats", 2),  # fact and dimension
        ("a3_counts_by_station", 2),
        ("a7_integrity", 2),
        ("l4_fact_load_stats", 2),  # both deliveries
    ],
)
def test_number_of_scans(spark, name, most):
    assert executed_scans(QUERIES[name](spark, SF_SMALL)) <= most
