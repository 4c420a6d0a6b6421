"""Plan checks of the training-data queries and the pipeline's stages: no cartesian product, no row-at-a-time
Python UDF; the operators that are to be native have no Python node at all."""

import pytest

import corpus_pipeline
from conftest import SF_SMALL
from dwkit.llm.queries import QUERIES

NATIVE = ("op3_", "op4_", "op5_")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_plan(spark, key):
    plan = _plan(QUERIES[key](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BatchEvalPython" not in plan
    if key.startswith(NATIVE):
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stage_plan(spark, stage):
    plan = _plan(stage(spark, spark.read.parquet(f"{SF_SMALL}/documents.parquet"), SF_SMALL))
    assert "CartesianProduct" not in plan and "BatchEvalPython" not in plan
