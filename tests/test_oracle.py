"""Every registered query against its DuckDB oracle (the driver's gate, at sf0.001)."""
import pytest

import __spark_entry__ as E
from tests import compare as C
from tests.conftest import SF_SMALL

QUERIES = E.queries()
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return C.duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    if name not in SQL:
        pytest.skip("no SQL equivalent")
    want = duck.execute(SQL[name]).df()
    assert C.compare(got, want) == []


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["station_name", "metric", "total_records", "valid_records", "null_values",
                          "earliest_record", "latest_record"]


def test_every_query_has_oracle():
    """Queries of the library have SQL each; those of the training-data package that SQL cannot express are named there."""
    from stratus.oracle import ORACLE_SQL
    from stratus.registry import QUERIES as OWN

    assert set(OWN) == set(ORACLE_SQL)
    assert set(SQL) <= set(QUERIES)
