"""Every registered query with an SQL twin gives the same names, types and values."""

import pytest

import __spark_entry__ as entry
from check_sql import difference

FOLDER = "/root/testdata/sf0.001"
# Too few users have churned in the smallest folder for every fold to hold both classes.
SEARCHES = {"cv_metrics_lr", "cv_metrics_gbt", "select_best_model", "evaluate_winners", "planted_search", "chance_labels"}
LARGER = "/root/testdata/sf0.01"


def test_every_twin_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_as_sql(spark, name):
    folder = LARGER if name in SEARCHES else FOLDER
    assert difference(entry.queries()[name](spark, folder), folder, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
