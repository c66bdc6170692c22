"""Every query against its SQL at the smallest scale."""

import os
from math import prod

import pytest
from oracle import compare, connect

import __spark_entry__ as entry
from labelworks.plans.families import FAMILIES
from workload import modelling, registry

SF = "/root/testdata/sf0.001"
SQL = registry.SQL
# The slow ones only on request.
NAMES = sorted(SQL if os.environ.get("TEST_SLOW") else set(SQL) - registry.SLOW)


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    ok, note, _ = compare(spark, duck, entry.queries()[name], SQL[name], SF)
    assert ok, note


def test_every_query_has_sql():
    assert set(SQL) == set(registry.QUERIES) and set(SQL) <= set(entry.oracle_sql())


def test_every_family_is_searched_over_its_whole_space(monkeypatch, duck):
    asked = []

    def told(folds, split, family, space=None, draws=None, ledger=None):
        asked.append((family.name, space, draws))
        raise InterruptedError

    monkeypatch.setattr(modelling, "_folds", lambda spark, sf, k: (None, None))
    monkeypatch.setattr(modelling, "ledger", lambda spark: None)
    monkeypatch.setattr(modelling.M, "search", told)
    for name, family in FAMILIES.items():
        query = "family_search" if name == "logistic_regression" else f"family_search_{name}"
        with pytest.raises(InterruptedError):
            registry.QUERIES[query](None, SF)
        assert asked.pop() == (name, None, family.draws)
        assert duck.execute(SQL[query]).fetchall() == [(name, family.search, min(family.draws or 999, prod(map(len, family.space.values()))), True)]
    rows = duck.execute(SQL["select_and_tune"]).fetchall()
    assert {(r[0], r[1]) for r in rows} == {(n, f.search) for n, f in FAMILIES.items()}
