"""Plan checks, one case per registered library query (sf0.001): no cartesian product, no row-at-a-time Python UDF."""

import pytest
from conftest import SF_SMALL

from dwkit.plans.catalog import QUERIES


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_cartesian_or_row_udf(spark, key):
    plan = QUERIES[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BatchEvalPython" not in plan
