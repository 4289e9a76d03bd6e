"""Plan checks: pruning, pushdown, broadcast dimensions, no Python in report plans."""
from stratus.operators import analytics as B
from stratus.operators import quality as A
from stratus.operators import views as V
from stratus.plans import physical_plan
from stratus.registry import QUERIES
from stratus.sources.drivertables import lineitem_dim, lineitem_fact
from tests.conftest import SF_SMALL


def test_scan_is_pruned(spark):
    plan = physical_plan(A.counts_by(lineitem_fact(spark, SF_SMALL), "source"))
    scan = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert scan and "l_extendedprice" not in scan[0] and "l_comment" not in scan[0]


def test_filter_pushed_to_scan(spark):
    f = lineitem_fact(spark, SF_SMALL)
    plan = physical_plan(A.recent(f, 30, A.latest_date(f)))
    assert "PushedFilters" in plan and "l_shipdate" in plan


def test_dimension_join_is_broadcast(spark):
    plan = physical_plan(V.v_quality(lineitem_fact(spark, SF_SMALL), lineitem_dim(spark, SF_SMALL)))
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    assert "SortMergeJoin" not in plan


def test_latest_does_not_shuffle_fact(spark):
    plan = physical_plan(B.latest(lineitem_fact(spark, SF_SMALL), lineitem_dim(spark, SF_SMALL)))
    assert "SortMergeJoin" not in plan


def test_no_python_udf_or_cross_join_in_reports(spark):
    for name, fn in QUERIES.items():
        plan = physical_plan(fn(spark, SF_SMALL))
        assert "BatchEvalPython" not in plan, name
        assert "ArrowEvalPython" not in plan, name
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name


def test_sql_views_match_functions(spark):
    from stratus.operators.views import register_views
    from tests import compare as C

    fact, dim = lineitem_fact(spark, SF_SMALL), lineitem_dim(spark, SF_SMALL)
    register_views(fact, dim)
    via_sql = spark.sql("SELECT * FROM v_data_quality_summary").toPandas()
    assert C.compare(via_sql, V.v_quality(fact, dim).toPandas()) == []
    assert spark.sql("SELECT COUNT(*) AS n FROM v_wind_data").first().n > 0
