"""Rows-only learner queries: schema, determinism, and accuracy on the test
split above the majority share (labels come from the passengers fixture)."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cabinlens.sources import fixtures as FX

CASES = [
    ("logistic_baseline_scores", "prediction"),
    ("forest_scores", "prediction"),
    ("boosted_trees_scores", "prediction"),
    ("network_scores", "prediction"),
    ("voting_ensemble_scores", "vote"),
]


@pytest.mark.parametrize("name,col", CASES)
def test_learner_query(spark, sf, name, col):
    q = entry.queries()[name]
    truth = FX.passengers(spark, sf).select(
        "id", (F.col("`Satisfaction Rating`") == "Satisfied").cast("int").alias("y"))
    first = q(spark, sf)
    rows = sorted(first.collect())
    assert rows == sorted(q(spark, sf).collect())          # same seed, same result
    assert len(rows) == FX.raw_test(spark, sf).count()      # every test row scored once
    share = truth.where("id % 4 = 0").agg(F.avg("y")).first()[0]
    acc = first.join(truth, "id").agg(F.avg((F.col(col) == F.col("y")).cast("double"))).first()[0]
    assert acc > max(share, 1 - share)
