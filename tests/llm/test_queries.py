"""The registered queries: against SQL where there is one, else that they run; all on a driver's table."""

from __future__ import annotations

import pytest

from lexigrid.llm import queries as q
from tests.conftest import DATA, check_against_sql


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_against_sql(spark, name):
    check_against_sql(spark, q.queries()[name], q.oracle_sql()[name], "sf0.01")


@pytest.mark.parametrize("name", sorted(set(q.queries()) - set(q.oracle_sql())))
def test_runs(spark, name):
    assert q.queries()[name](spark, f"{DATA}/sf0.001").count() > 0


def test_pipeline_runs(spark):
    import corpus_pipeline

    assert corpus_pipeline.run(spark, f"{DATA}/sf0.001").count() > 0
