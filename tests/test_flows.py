"""End-to-end workflows on CSV files written from the small tables."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from cabinlens import schema as S
from cabinlens.plans import flows
from cabinlens.sources import fixtures as FX
from cabinlens.sources import io as IO


@pytest.fixture(scope="module")
def files(spark):
    d = tempfile.mkdtemp(prefix="cabinlens-flow-")
    paths = {k: os.path.join(d, k) for k in ("train", "test", "sample", "out")}
    IO.write_table(FX.raw_train(spark, "/root/testdata/sf0.001"), paths["train"])
    test = FX.raw_test(spark, "/root/testdata/sf0.001")
    IO.write_table(test, paths["test"])
    IO.write_table(test.select("id", F.lit("Satisfied").alias(S.RAW_TARGET)), paths["sample"])
    return paths


def test_train_and_submit(spark, files):
    res = flows.train_and_submit(spark, files["train"], files["test"], files["sample"], files["out"],
                                 algorithm="xgb", params={"n_estimators": 10, "max_depth": 4}, folds=3)
    assert 0.5 < res["cv_mean"] <= 1.0 and res["train_accuracy"] >= res["cv_mean"] - 0.2
    sub = spark.read.option("header", True).csv(os.path.join(files["out"], "submission"))
    assert sub.count() == 375 and sub.where(F.col(S.RAW_TARGET).isNull()).count() == 0
    imp = spark.read.option("header", True).option("sep", "\t").csv(os.path.join(files["out"], "feature-importance"))
    assert imp.count() == 80


def test_error_rows_are_out_of_fold(spark, files):
    out = files["out"] + "4"
    res = flows.train_and_submit(spark, files["train"], files["test"], files["sample"], out,
                                 params={"n_estimators": 3, "max_depth": 3}, folds=2)
    rows = res["report"].where("label = 'accuracy'").first()["support"]
    errors = spark.read.option("header", True).csv(os.path.join(out, "error_analysis"))
    assert errors.count() / rows == pytest.approx(1 - res["cv_mean"], abs=0.01)


def test_voting_network_blend(spark, files):
    small = {"n_estimators": 5, "max_depth": 3}
    vote = flows.voting_submit(spark, files["train"], files["test"], files["sample"], files["out"],
                               {"xgb": small, "rf": small, "lgbm": small})
    assert vote["train_accuracy"] > 0.5
    net = flows.network_submit(spark, files["train"], files["test"], files["sample"], files["out"],
                               hidden=(8,), max_iter=20)
    assert 0.0 <= net["holdout_accuracy"] <= 1.0
    tree = flows.train_and_submit(spark, files["train"], files["test"], files["sample"], files["out"] + "2",
                                  params=small, folds=2)["model"]
    sub = flows.blend_submit(spark, tree, net["model"], files["test"], files["train"], files["sample"], files["out"])
    assert sub.count() == 375


def test_profile_and_search(spark, files):
    tables = flows.profile_tables(spark, files["train"], files["test"], files["out"])
    assert tables["feature_statistics"].count() == 81
    trials = flows.feature_search(spark, files["train"], files["test"], files["out"], n=2, folds=2)
    assert trials.count() <= 2
    assert spark.read.parquet(os.path.join(files["out"], "trials")).count() == trials.count()


def test_repeated_cv_and_threshold_tuning(spark, files):
    res = flows.train_and_submit(spark, files["train"], files["test"], files["sample"], files["out"] + "3",
                                 params={"n_estimators": 5, "max_depth": 3}, folds=3, repeats=2,
                                 tune_threshold=[0.3, 0.4, 0.5, 0.6])
    assert res["cv"].count() == 6
    assert res["threshold"] in (0.3, 0.4, 0.5, 0.6)
    assert res["threshold_sweep"].count() == 4
