"""Every registered query against its SQL, or that it runs."""

from __future__ import annotations

import pytest

from lexigrid import catalog
from tests.conftest import DATA, check_against_sql


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_against_sql(spark, name):
    check_against_sql(spark, catalog.queries()[name], catalog.oracle_sql()[name], "sf0.01")


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_runs(spark, name):
    assert catalog.queries()[name](spark, f"{DATA}/sf0.001").count() > 0
