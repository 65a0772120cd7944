"""Every registered query has an SQL twin that test_sql_twins.py runs, or is run here."""

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
WITHOUT_TWIN = sorted(set(entry.queries()) - set(entry.oracle_sql()))


@pytest.mark.parametrize("name", WITHOUT_TWIN)
def test_query_runs(spark, name):
    assert entry.queries()[name](spark, FOLDER).count() > 0
