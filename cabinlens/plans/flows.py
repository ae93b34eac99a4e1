"""End-to-end workflows: the reference's scripts as compositions of operators.

Each flow reads the survey CSV files (A1), runs Spark jobs only, and writes
its tables (A3) into ``out_dir``; it returns the main results as small Python
values or DataFrames.  Nothing is collected except metrics and fitted models.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql import functions as F

from cabinlens import schema as S
from cabinlens.operators import evaluate as K
from cabinlens.operators import learn as J
from cabinlens.operators import profile as P
from cabinlens.operators import search as L
from cabinlens.operators import split as H
from cabinlens.operators.select import keep_features, split_xy
from cabinlens.plans import analysis as AN
from cabinlens.plans import features as FE
from cabinlens.sources import io as IO


def load(spark: SparkSession, train_path: str, test_path: str, strategy: str = "none") -> tuple[DataFrame, DataFrame]:
    """Read both files with explicit schemas and prepare them."""
    train_raw = IO.read_survey(spark, train_path, IO.survey_schema(True))
    test_raw = IO.read_survey(spark, test_path, IO.survey_schema(False))
    return FE.prepare(train_raw, test_raw, strategy)


def _estimator(algorithm: str, params: Mapping | None, ignore=()):
    if algorithm == "rf":
        return J.forest(params, ignore=ignore)
    if algorithm in ("xgb", "lgbm", "gbt"):
        return J.boosted_trees(params, ignore=ignore)
    raise ValueError(f"unknown algorithm {algorithm}")


def _write_submission(spark: SparkSession, sample_path: str, preds: DataFrame, out: str) -> DataFrame:
    schema = T.StructType([T.StructField(S.ID, T.LongType()), T.StructField(S.RAW_TARGET, T.StringType())])
    sample = IO.read_survey(spark, sample_path, schema)
    sub = IO.submission(sample, preds)
    IO.write_table(sub, out)
    return sub


def train_and_submit(spark: SparkSession, train_path: str, test_path: str, sample_path: str, out_dir: str,
                     algorithm: str = "xgb", params: Mapping | None = None, ignore=(), threshold: float = 0.5,
                     folds: int = 5, seed: int = 4322, repeats: int = 0,
                     tune_threshold: Sequence[float] | None = None) -> dict:
    """Tree-model path: features, fit, CV accuracy (stratified folds, or
    ``repeats`` x shuffled folds), train accuracy, importances, out-of-fold
    error rows, optional threshold sweep over out-of-fold scores, submission."""
    train, test = load(spark, train_path, test_path)
    tr = FE.features_tree(train)
    te = FE.features_tree(test, fit_on=train)
    xy, names = split_xy(tr)
    xy_test, _ = split_xy(te.select(*[c for c in tr.columns if c != S.TARGET]))
    with_folds = H.stratified_kfold(xy, S.TARGET, k=folds, seed=seed)
    estimator = _estimator(algorithm, params, ignore)
    model = J.fit(estimator, xy)
    sweep = None
    oof = J.out_of_fold(estimator, with_folds, k=folds, keep=(S.ID,))
    if tune_threshold:
        sweep = K.threshold_search(oof, tune_threshold, y=S.TARGET, p="p")
        threshold = K.best_trial(sweep, "threshold", "accuracy").first()["threshold"]
    if repeats:
        shuffled = H.kfold(xy, k=folds, repeats=repeats, seed=42)
        parts = [J.cv_score(estimator, shuffled.withColumnRenamed(f"fold_{r}", "fold"), k=folds, threshold=threshold)
                 .withColumn("repeat", F.lit(r)) for r in range(repeats)]
        cv = parts[0]
        for part in parts[1:]:
            cv = cv.unionByName(part)
    else:
        cv = J.cv_score(estimator, with_folds, k=folds, threshold=threshold)
    scored_train = J.score(model, xy, keep=(S.ID, S.TARGET), threshold=threshold)
    train_acc = K.accuracy(scored_train, S.TARGET).first()["accuracy"]
    IO.write_table(J.feature_importance(model, names, spark), os.path.join(out_dir, "feature-importance"), sep="\t")
    wrong = K.wrong_predictions(K.apply_threshold(oof, "p", threshold), S.TARGET)
    IO.write_table(tr.join(wrong.select(S.ID, "true_labels", "predicted_labels"), S.ID),
                   os.path.join(out_dir, "error_analysis"))
    report = K.classification_report(scored_train, S.TARGET)
    preds = J.score(model, xy_test, threshold=threshold)
    _write_submission(spark, sample_path, preds, os.path.join(out_dir, "submission"))
    return {"model": model, "cv": cv, "cv_mean": cv.agg(F.avg("accuracy")).first()[0],
            "train_accuracy": train_acc, "report": report, "threshold": threshold, "threshold_sweep": sweep}


#: Members of the vote: the second boosted model is shallower, so that the two differ.
VOTERS = {"xgb": {"max_depth": 5}, "rf": {}, "lgbm": {"max_depth": 4}}


def voters(params: Mapping[str, Mapping] | None = None) -> J.Voting:
    own = {x: {**VOTERS[x], **(params or {}).get(x, {})} for x in VOTERS}
    return J.Voting([J.boosted_trees(own["xgb"]), J.forest(own["rf"]), J.boosted_trees(own["lgbm"], seed=7)], S.VOTE_WEIGHTS)


def voting_submit(spark: SparkSession, train_path: str, test_path: str, sample_path: str, out_dir: str,
                  params: Mapping[str, Mapping] | None = None, folds: int = 5, seed: int = 42) -> dict:
    """Full feature set, best features, three tree models, weighted hard vote: CV
    and train accuracy of the ensemble, submission."""
    train, test = load(spark, train_path, test_path)
    tr = keep_features(FE.features_full(train), S.BEST_FEATURES)
    te = keep_features(FE.features_full(test, fit_on=train), S.BEST_FEATURES)
    xy, _ = split_xy(tr)
    xy_test, _ = split_xy(te)
    ensemble = voters(params)
    cv = J.cv_score(ensemble, H.stratified_kfold(xy, S.TARGET, k=folds, seed=seed), k=folds)
    model = J.fit(ensemble, xy)
    acc = K.accuracy(model.transform(xy), S.TARGET).first()["accuracy"]
    votes = model.transform(xy_test).select(S.ID, F.col("prediction").cast("int").alias("prediction"))
    _write_submission(spark, sample_path, votes, os.path.join(out_dir, "submission_voting"))
    return {"train_accuracy": acc, "models": model.models, "cv": cv, "cv_mean": cv.agg(F.avg("accuracy")).first()[0]}


def network_submit(spark: SparkSession, train_path: str, test_path: str, sample_path: str, out_dir: str,
                   hidden=(256, 128, 64), max_iter: int = 200, seed: int = 42) -> dict:
    """Scaled network features with sorted columns, a hold-out split, MLP, submission."""
    train, test = load(spark, train_path, test_path)
    tr = FE.features_nn(train)
    te = FE.features_nn(test, fit_on=train)
    xy, names = split_xy(tr, sort=True)
    xy_test, _ = split_xy(te, sort=True)
    fit_part, hold = H.train_test_split(xy, 0.15, seed)
    model = J.fit(J.mlp(len(names), hidden, max_iter=max_iter, seed=seed), fit_part)
    hold_acc = K.accuracy(J.score(model, hold, keep=(S.ID, S.TARGET), threshold=0.5, strict=True),
                          S.TARGET).first()["accuracy"]
    _write_submission(spark, sample_path, J.score(model, xy_test, threshold=0.5, strict=True),
                      os.path.join(out_dir, "submission_nn"))
    return {"holdout_accuracy": hold_acc, "model": model}


def blend_submit(spark: SparkSession, tree_model, network_model, test_path: str, train_path: str,
                 sample_path: str, out_dir: str, alpha: float = 0.5) -> DataFrame:
    """Average the tree and network probabilities, label by ``> 0.5``."""
    train, test = load(spark, train_path, test_path)
    tree_xy, _ = split_xy(FE.features_tree(test, fit_on=train))
    nn_xy, _ = split_xy(FE.features_nn(test, fit_on=train), sort=True)
    a = J.score(tree_model, tree_xy).select(S.ID, F.col("p").alias("p_tree"))
    b = J.score(network_model, nn_xy).select(S.ID, F.col("p").alias("p_nn"))
    blended = K.blend(a.join(b, S.ID), "p_tree", "p_nn", alpha, name="prediction")
    return _write_submission(spark, sample_path, blended, os.path.join(out_dir, "avg_submission"))


def _transformed(df: DataFrame) -> DataFrame:
    """The numeric columns after log(1 + x) and square root."""
    return df.select(*[F.log1p(x).alias(f"log_{x}") for x in S.NUMERIC], *[F.sqrt(x).alias(f"sqrt_{x}") for x in S.NUMERIC])


def _densities(train: DataFrame, test: DataFrame, features: Sequence[str]) -> DataFrame:
    """Both sides' densities of each feature, one after the other."""
    parts = [P.density_table(train, test, x).withColumn("feature", F.lit(x)) for x in features]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def profile_tables(spark: SparkSession, train_path: str, test_path: str, out_dir: str) -> dict[str, DataFrame]:
    """The exploratory and train/test comparison tables, written as CSV."""
    raw = IO.read_survey(spark, train_path, IO.survey_schema(True))
    train, test = load(spark, train_path, test_path)
    tr = FE.features_tree(train).drop(S.TARGET)
    te = FE.features_tree(test, fit_on=train)
    numeric = [f.name for f in raw.schema.fields if f.dataType.typeName() in ("integer", "long", "double")]
    counts, stats = P.survey_report(raw, S.RAW_SURVEY_COLUMNS)
    tables = {
        "info": P.table_info(raw),
        "describe": P.describe(raw, numeric),
        "class_distribution": P.value_counts(raw, S.RAW_TARGET),
        "group_counts": AN.label_counts(AN.group_features(raw)),
        "interaction_counts": AN.label_counts(AN.interaction_features(raw), S.INTERACTION_FEATURES),
        "survey_counts": counts,
        "survey_stats": stats,
        "feature_statistics": P.compare_moments(tr, te, tr.columns),
        "stability_indices": P.stability_index(tr, te, tr.columns),
        "correlation": P.correlation_matrix(tr, tr.columns),
        "numeric_statistics": P.numeric_profile(train, S.NUMERIC),
        "numeric_statistics_transformed": P.numeric_profile(_transformed(train), [f"{f}_{x}" for x in S.NUMERIC for f in ("log", "sqrt")]),
        "densities": _densities(train, test, S.NUMERIC),
    }
    for name, df in tables.items():
        IO.write_table(df, os.path.join(out_dir, name))
    return tables


def feature_search(spark: SparkSession, train_path: str, test_path: str, out_dir: str, n: int = 250,
                   seed: int = 393, folds: int = 5) -> DataFrame:
    """Random feature-subset search on the full feature set; finished trials are
    appended (a search started again goes on), and the best list is written."""
    train, _ = load(spark, train_path, test_path)
    wide = FE.features_full(train)
    wide = wide.withColumns({f"{x}^3": F.col(f"`{x}`") ** 3 for x in S.POLY_COLUMNS})
    wide = H.stratified_kfold(wide, S.TARGET, k=folds, seed=seed)
    trials = L.feature_subset_search(lambda: J.boosted_trees(), wide, FE.on_off_features(), n, seed, k=folds, path=os.path.join(out_dir, "trials"))
    IO.write_table(L.best_features(trials), os.path.join(out_dir, "best_features"))
    return trials
