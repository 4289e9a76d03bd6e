import pytest

from stratus.llm.oracle import ORACLE_SQL
from stratus.llm.queries import QUERIES
from tests import compare as C
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = C.duck(SF_SMALL).execute(ORACLE_SQL[name]).df()
    assert not C.compare(got, want)


def test_entry_registers_all(spark):
    import __spark_entry__ as entry

    for n in range(1, 11):
        assert any(q.startswith(f"op{n}_") for q in entry.queries())
    assert "pipeline" in entry.queries()


def test_native_plans_have_no_python(spark):
    for name in ("op2_sharding", "op4_url_filter", "op6_license_scan"):
        plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct"))
