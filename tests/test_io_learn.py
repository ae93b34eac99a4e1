"""Sources/sinks and learners (rows-only operators)."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from cabinlens import schema as S
from cabinlens.operators import learn as J
from cabinlens.operators import split as H
from cabinlens.plans import q_learn
from cabinlens.sources import fixtures as FX
from cabinlens.sources import io as IO


def test_csv_roundtrip_with_nan(spark, sf):
    d = tempfile.mkdtemp(prefix="cabinlens-io-")
    raw = FX.passengers(spark, sf).withColumn(
        "Arrival Delay in Minutes",
        F.when(F.col("id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("Arrival Delay in Minutes")))
    IO.write_table(raw, os.path.join(d, "train"))
    back = IO.read_survey(spark, os.path.join(d, "train"), IO.survey_schema())
    assert back.count() == raw.count()
    assert back.where(F.col("`Arrival Delay in Minutes`").isNull()).count() >= raw.where("id % 7 = 0").count()
    assert IO.normalize_columns(back).columns[10] == "Convenience_of_Departure/Arrival_Time_"


def test_trials_append(spark):
    d = tempfile.mkdtemp(prefix="cabinlens-trials-")
    t = spark.createDataFrame([("s", 0, "{}", 0.8, -0.8)], IO.TRIAL_SCHEMA)
    IO.append_trials(t, d)
    IO.append_trials(t, d)
    assert spark.read.parquet(d).count() == 2


def test_boosted_trees_deterministic_and_better_than_majority(spark, sf):
    xy_train, xy_test, names = q_learn.tree_xy(spark, sf)
    assert len(names) == 80
    model = J.boosted_trees({"n_estimators": 10, "max_depth": 4}).fit(xy_train)
    a = J.score(model, xy_train).orderBy("id").collect()
    b = J.score(J.boosted_trees({"n_estimators": 10, "max_depth": 4}).fit(xy_train), xy_train).orderBy("id").collect()
    assert a == b
    acc = sum(1 for r, t in zip(a, xy_train.orderBy("id").collect()) if r["prediction"] == t[S.TARGET]) / len(a)
    majority = max(xy_train.groupBy(S.TARGET).count().collect(), key=lambda r: r["count"])["count"] / len(a)
    assert acc > majority


def test_save_and_load_model(spark, sf):
    from pyspark.ml import Pipeline

    xy_train, _, _ = q_learn.tree_xy(spark, sf)
    model = Pipeline(stages=[J.forest({"n_estimators": 5, "max_depth": 3})]).fit(xy_train)
    d = tempfile.mkdtemp(prefix="cabinlens-model-")
    IO.save_model(model, d)
    again = IO.load_model(d)
    assert J.score(again, xy_train).collect() == J.score(model, xy_train).collect()


def test_unknown_parameter_is_rejected():
    import pytest

    with pytest.raises(J.UnsupportedParameter):
        J.forest({"min_samples_split": 7})
    J.forest({"min_samples_split": 7}, ignore=["min_samples_split"])


def test_adversarial_split_with_learner(spark, sf):
    from cabinlens.plans.catalog import test_frame as holdout_frame, train_frame

    tr = train_frame(spark, sf).drop("Gender", "Customer_Type", "Type_of_Travel", "Class")
    te = holdout_frame(spark, sf).drop("Gender", "Customer_Type", "Type_of_Travel", "Class")
    training, validation, auc = H.adversarial_split(tr, te, 0.2)
    n = tr.count()
    assert validation.count() == int(n * 0.2) and training.count() == n - int(n * 0.2)
    assert 0.0 <= auc <= 1.0


def test_class_weight_raises_recall(spark):
    """The parameters of a saved tuning run are accepted, and the weight counts."""
    rows = [(float(i % 10) / 10, float((i * 7) % 10) / 10, int((i % 10) + (i * 13) % 7 > 11)) for i in range(600)]
    from pyspark.ml.feature import VectorAssembler

    data = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(spark.createDataFrame(rows, f"a double, b double, `{S.TARGET}` int"))
    ignored = ["colsample_bylevel", "colsample_bytree", "grow_policy", "min_child_weight", "reg_alpha", "reg_lambda", "booster"]

    def recall(make, weight):
        pred = J.fit(make({"scale_pos_weight": weight}), data).transform(data)
        return pred.where(F.col(S.TARGET) == 1).agg(F.avg("prediction")).first()[0]

    makers = [lambda p: J.boosted_trees({"n_estimators": 3, "max_depth": 1, **p}), lambda p: J.forest({"n_estimators": 3, "max_depth": 1, **p}),
              lambda p: J.logistic(maxIter=10, **p)]
    for make in makers:
        assert recall(make, 30.0) > recall(make, 0.05)
    assert J.weighted(J.logistic(), 1) .__class__.__name__ == "LogisticRegression"
    with pytest.raises(J.UnsupportedParameter):
        J.boosted_trees({"scale_pos_weight": 0})
    J.boosted_trees({"booster": "gbtree", "objective": "binary:logistic", "eval_metric": "error", "scale_pos_weight": 1.06,
                     "min_child_weight": 3.0, "reg_alpha": 0.1}, ignore=ignored)


def test_voting_is_one_chain(spark, sf):
    from cabinlens.operators.select import split_xy
    from cabinlens.operators import split as H
    from cabinlens.plans import flows
    from cabinlens.plans.catalog import train_frame

    xy, _ = split_xy(train_frame(spark, sf).select("id", S.TARGET, *S.SURVEY))
    ensemble = flows.voters({"xgb": {"n_estimators": 4}, "rf": {"n_estimators": 4}, "lgbm": {"n_estimators": 4}})
    assert ensemble.members[0].getMaxDepth() != ensemble.members[2].getMaxDepth()
    out = J.fit(ensemble, xy).transform(xy)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    rows = out.select("m0", "m1", "m2", "prediction").collect()
    for r in rows:
        for_one = sum(w for w, m in zip(S.VOTE_WEIGHTS, r[:3]) if m == 1)
        assert r["prediction"] == float(for_one > sum(S.VOTE_WEIGHTS) - for_one)
    assert any(r["m0"] != r["m2"] for r in rows)
    cv = J.cv_score(ensemble, H.stratified_kfold(xy, S.TARGET, k=2), k=2)
    assert cv.count() == 2 and 0 <= cv.agg(F.min("accuracy")).first()[0] <= 1


def test_search_keeps_one_cache_and_resumes(spark, tmp_path, monkeypatch):
    from cabinlens.operators import search as L

    data = spark.range(60).select("id", (F.col("id") % 2).cast("int").alias(S.TARGET), (F.col("id") % 3).cast("int").alias("fold"))
    seen = []

    def accuracies(estimator, cached, *args, **kw):
        seen.append(cached.storageLevel.useMemory)
        if len(seen) == 3:
            raise RuntimeError("lost driver")
        return [(0, 0.5), (1, estimator / 100)]

    monkeypatch.setattr(L, "fold_accuracies", accuracies)
    space, path = {"max_depth": ("choice", [3, 4, 5, 6])}, str(tmp_path / "trials")

    def search():
        return L.random_search(lambda p: p["max_depth"], data, space, n=5, seed=3, name="s", path=path, trials_at_once=1)

    with pytest.raises(RuntimeError):
        search()
    assert 2 <= spark.read.parquet(path).count() < 5
    trials = search()
    assert len(seen) == 6 and all(seen) and not data.storageLevel.useMemory
    assert trials.count() == 5 and spark.read.parquet(path).count() == 5
    assert sorted(r.asDict()["trial"] for r in trials.collect()) == list(range(5))
    assert L.best_parameters(trials).collect()[0].asDict()["name"] == "max_depth"
    assert search().collect() == trials.collect() and len(seen) == 6


def test_best_features_are_a_table(spark):
    from cabinlens.operators import search as L

    trials = spark.createDataFrame([("f", 0, '{"features": ["a", "b"]}', 0.6, -0.6), ("f", 1, '{"features": ["c", "a"]}', 0.7, -0.7),
                                    ("f", 2, '{"features": []}', None, None)], "search string, trial int, params string, accuracy double, loss double")
    assert [tuple(r) for r in L.best_features(trials).orderBy("position").collect()] == [(0, "c"), (1, "a")]
    assert L.best_features(trials.limit(0)).count() == 0


def test_threshold_sweep_of_odd_scores(spark):
    """Ties with the cut, NULL and NaN scores, folds of different sizes."""
    from cabinlens.operators.evaluate import threshold_search

    rows = [(0, 0.3, 1), (0, 0.5, 1), (0, 0.5, 0), (0, None, 0), (1, float("nan"), 1), (1, 0.7, 0), (1, 0.2, 0), (2, 0.5, 1)]
    df = spark.createDataFrame(rows, "fold int, p double, y int")
    for strict in (False, True):
        got = {r["threshold"]: r["accuracy"] for r in threshold_search(df, [0.0, 0.3, 0.5, 0.5, 0.9], strict=strict).collect()}
        for t in (0.0, 0.3, 0.5, 0.9):
            def one(p):
                return p is not None and (p != p or (p > t if strict else p >= t))
            folds = [[one(p) == (y == 1) for f, p, y in rows if f == k] for k in range(3)]
            assert got[t] == pytest.approx(sum(sum(x) / len(x) for x in folds) / 3)
