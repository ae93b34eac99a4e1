"""Every registered query against its DuckDB oracle on the small tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from cabinlens.plans.catalog import ORACLE, QUERIES
from conftest import SF_SMALL


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6f}"
    return str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in ("orders", "customer", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    return con


def test_every_query_has_oracle_or_is_a_learner():
    rows_only = set(QUERIES) - set(ORACLE)
    allowed = {  # learners and search
        "logistic_baseline_scores", "forest_scores", "boosted_trees_scores", "network_scores",
        "feature_importance", "cv_accuracy", "voting_ensemble_scores", "random_search_trials", "feature_subset_trials",
        "adversarial_split_learned",
    }
    assert rows_only <= allowed, rows_only - allowed
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    got = _canon(df.columns, df.collect())
    res = con.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    want = _canon(cols, res.fetchall())
    assert sorted(df.columns) == sorted(cols)
    assert got == want


def test_entry_runs(spark):
    out = entry.entry(spark)
    assert out.count() > 0
    assert out.columns == ["feature", "value", "Satisfaction Rating", "count"]
