"""Every registered query with an oracle agrees with DuckDB (sf0.001); the
rest run and return rows. sf0.01 is the driver's gate (tests/oracle_compare.py)."""

import pytest

from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck
from wellscore.plans.queries import queries
from wellscore.plans.registry import REGISTRY

SLOW = {"train_all", "best_model", "evaluation_report", "feature_importance", "model_comparison", "metrics_summary", "run_log", "cv_r2",
        "model_rf", "model_gbt", "model_gbt_sub"}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(n for n, e in REGISTRY.items() if e.sql is not None))
def test_query_matches_oracle(spark, con, name):
    e = REGISTRY[name]
    r = compare(spark, con, name, e.build, e.sql, SF_SMALL)
    assert r["status"] in ("ok", "approx"), r


@pytest.mark.parametrize("name", sorted(n for n, e in REGISTRY.items() if e.sql is None and n not in SLOW))
def test_rows_only_queries_run(spark, name):
    assert queries()[name](spark, SF_SMALL).count() > 0


def test_entry_smoke(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
