"""Nothing is dropped, capped or misread without a word."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabinlens import schema as S
from cabinlens.operators import encode, evaluate, profile, search
from cabinlens.operators import learn as J
from cabinlens.sources import io as IO


def test_csv_is_read_by_name(spark):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.DoubleType())])
    path = os.path.join(tempfile.mkdtemp(prefix="cabinlens-csv-"), "t")
    spark.createDataFrame([(1.5, "x", 7), (float("nan"), "y", 8)], "b double, other string, a int").coalesce(1).write.option("header", True).csv(path)
    got = IO.read_survey(spark, path, schema).orderBy("a").collect()
    assert [tuple(r) for r in got] == [(7, 1.5), (8, None)]
    with pytest.raises(ValueError, match="lacks"):
        IO.read_survey(spark, path, T.StructType([T.StructField("missing", T.IntegerType())]))


def test_parquet_is_cleaned(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="cabinlens-pq-"), "t")
    spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "b double, a int").write.parquet(path)
    assert IO.read_survey(spark, path, fmt="parquet").where("b IS NULL").count() == 1


def test_unmapped_value_raises(spark):
    df = spark.createDataFrame([("Satisfied",), (None,)], "v string")
    assert [r.v for r in encode.map_values(df, "v", {"Satisfied": 1}).collect()] == [1, None]
    with pytest.raises(Exception, match="no mapping for v = other"):
        encode.map_values(df.unionAll(spark.createDataFrame([("other",)], "v string")), "v", {"Satisfied": 1}).collect()


def test_confusion_counts_add_up(spark):
    df = spark.createDataFrame([(1, 1), (0, 2), (None, 1), (1, None), (0, 0)], "y int, prediction int")
    got = {(r.actual, r.predicted): r["count"] for r in evaluate.confusion_matrix(df).collect()}
    assert sum(got.values()) == 5 and got[(0, 2)] == 1 and got[(0, 1)] == 0 and got[(None, 1)] == 1


def test_report_counts_other_rows(spark):
    df = spark.createDataFrame([(1, 1), (1, None), (0, 0), (0, 2), (2, 1), (None, 0)], "y int, prediction int")
    got = {r.label: r for r in evaluate.classification_report(df).collect()}
    assert (got["1"].support, got["0"].support, got["accuracy"].support) == (2, 2, 6)
    assert (got["1"].precision, got["1"].recall, got["0"].precision, got["0"].recall) == (0.5, 0.5, 0.5, 0.5)
    assert got["accuracy"].f1_score == pytest.approx(2 / 6)


def test_other_objective_raises(spark):
    J.boosted_trees({"objective": "binary:logistic", "eval_metric": "error"})
    for params in ({"objective": "reg:squarederror"}, {"eval_metric": "auc"}):
        with pytest.raises(J.UnsupportedParameter):
            J.boosted_trees(params)


def test_constant_density(spark):
    one, two = spark.createDataFrame([(3.0,), (3.0,)], "x double"), spark.createDataFrame([(1.0,), (2.0,)], "x double")
    assert [(r.side, r.x, r.density) for r in profile.density_table(one, one, "x").collect()] == [("train", 3.0, None), ("test", 3.0, None)]
    assert profile.density_table(one, two, "x").where("side = 'train'").count() == 1


def test_depth_is_not_cut():
    with pytest.raises(J.UnsupportedParameter):
        J.forest({"max_depth": 50})
    assert J.boosted_trees({"max_depth": 30}).getMaxDepth() == 30


def test_best_trial_ties(spark):
    rows = [("b", 0.5), ("a", 0.5), ("c", 0.4)]
    for order in (rows, rows[::-1]):
        assert evaluate.best_trial(spark.createDataFrame(order, "params string, accuracy double").coalesce(1), "params").first().params == "a"


def test_unknown_features_raise(spark):
    wide = spark.createDataFrame([(1, 0, 0, 1.0)], f"{S.ID} int, {S.TARGET} int, fold int, x double")
    with pytest.raises(ValueError, match="lacks the features"):
        search.feature_subset_search(lambda: None, wide, ["no_such_feature"], 3)


def test_saved_learner_loads(spark):
    from pyspark.ml.feature import VectorAssembler

    df = spark.range(40).select(F.col("id").cast("double").alias("x"), (F.col("id") % 2).cast("int").alias(S.TARGET))
    xy = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    model = J.forest({"n_estimators": 2, "max_depth": 2}).fit(xy)
    path = os.path.join(tempfile.mkdtemp(prefix="cabinlens-model-"), "m")
    IO.save_model(model, path)
    assert [r.prediction for r in IO.load_model(path).transform(xy).collect()] == [r.prediction for r in model.transform(xy).collect()]
