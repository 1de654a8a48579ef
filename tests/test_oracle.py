"""Every query of the library against SQL; those that SQL can't express run and give rows; their operators have tests of their own."""

import pytest
from conftest import SF

from crateflow.plans import catalog, data_problems, loads

QUERIES = catalog.QUERIES | loads.QUERIES | data_problems.QUERIES
ORACLE = catalog.ORACLE | loads.ORACLE | data_problems.ORACLE


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(name, same_as_sql):
    same_as_sql(QUERIES[name], ORACLE[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(name, spark):
    df = QUERIES[name](spark, SF)
    # On the smallest tables no release is for review.
    assert df.columns and (df.count() > 0 or name == "review_report")
