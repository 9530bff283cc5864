"""Every query beside its DuckDB oracle, on the smallest tables."""

import pandas as pd
import pytest

from checks import all_checks, all_sql
from checks.verify import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(all_checks()))
def test_query(spark, db, name):
    got = all_checks()[name](spark, SF).toPandas()
    assert len(got.columns) == len(set(got.columns))
    if name in all_sql():
        why = compare(got, db.sql(all_sql()[name]).df())
        assert not why or why.startswith("  ["), why


def test_comparison_sees_differences():
    left = pd.DataFrame({"a": [1, 2], "b": ["x", None]})
    assert compare(left, left[::-1]) == ""
    assert "rows" in compare(left, left[:1])
    assert "differ" in compare(left, left.assign(a=[1, 3]))
    assert "columns" in compare(left, left.rename(columns={"a": "c"}))


def test_every_query_has_an_oracle():
    assert set(all_sql()) == set(all_checks())
