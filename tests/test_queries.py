"""Every registered query: against its SQL where it has one, else for rows."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry_points
from delaykit.plans import CATALOG

SF = "/root/testdata/sf0.001"
CHECKED = [n for n, e in CATALOG.items() if e.sql]
# The slow model fits are left to tests/check_queries.py.
QUICK = [
    n for n, e in CATALOG.items()
    if not e.sql and not n.startswith(("train_", "retrain", "cv_mae_model", "score_", "pca_report", "model_"))
]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", CHECKED)
def test_matches_sql(spark, con, name):
    assert compare(CATALOG[name].run(spark, SF), con, CATALOG[name].sql) is None


@pytest.mark.parametrize("name", QUICK)
def test_gives_rows(spark, name):
    df = CATALOG[name].run(spark, SF)
    assert df.columns and df.count() >= (0 if name == "suggest_aggregations" else 1)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
    assert set(entry_points.oracle_sql()) < set(entry_points.queries())
