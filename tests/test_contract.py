"""Every registered query against its DuckDB statement."""

from __future__ import annotations

import math
from functools import cache

import pytest
from conftest import SF

import __spark_entry__ as contract
from tallymill.plans.lake import Lake

OWN = sorted(n for n in contract.oracle_sql() if not n.startswith("op"))  # the others are tested with their operators

KINDS = {"VARCHAR": "string", "BIGINT": "bigint", "DOUBLE": "double"}


def _value(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else repr(round(x, 6) + 0.0)
    return repr(x)


def _sorted(rows):
    return sorted(tuple(map(_value, r)) for r in rows)


@pytest.fixture(autouse=True, scope="module")
def shared_lake():
    """Let the queries share the tables they build; each alone would build its own."""
    contract.Lake = cache(Lake)
    yield
    contract.Lake = Lake


@pytest.mark.parametrize("name", OWN)
def test_query_matches_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF)
    columns = sorted(df.columns)
    expected = duck.sql(contract.oracle_sql()[name])
    assert sorted(expected.columns) == columns
    types = dict(zip(expected.columns, map(str, expected.types)))
    assert {c: KINDS.get(types[c]) for c in columns} == {f.name: f.dataType.simpleString() for f in df.schema.fields}
    place = [expected.columns.index(c) for c in columns]
    assert _sorted(df.select(*columns).collect()) == _sorted([r[i] for i in place] for r in expected.fetchall())


def test_every_query_has_a_statement():
    own = {n for n in contract.queries() if not n.startswith("op") and n != "pipeline"}
    assert own <= set(contract.oracle_sql())


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0
