"""Queries of the training-data operators against the same question in SQL, over whole tables."""

import pytest

from playtally.llm import registry
from tests.llm.helpers import assert_matches


def test_names():
    assert [name.split("_")[0] for name in registry.queries()] == [*(f"op{n}" for n in range(1, 14)), "pipeline"]
    assert set(registry.oracle_sql()) < set(registry.queries())


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_matches_sql(spark, name):
    assert_matches(spark, registry.queries()[name], registry.oracle_sql()[name])
