"""Queries for learners, scoring, importances, cross-validation and search.

Learner outputs depend on MLlib's solvers, so these have no oracle SQL
(rows-only check); tests check schema, determinism and accuracy bounds.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cabinlens import schema as S
from cabinlens.operators import encode as E
from cabinlens.operators import learn as J
from cabinlens.operators import missing as M
from cabinlens.operators import search as L
from cabinlens.operators import split as H
from cabinlens.operators.select import split_xy
from cabinlens.plans import features as FE
from cabinlens.plans.catalog import finish, register, test_frame, train_frame
from cabinlens.plans.oracle import base
from cabinlens.sources import fixtures as FX
from cabinlens.sources.io import normalize_columns

BOOSTED_DEFAULTS = {"n_estimators": 20, "max_depth": 5, "learning_rate": 0.1}
FOREST_DEFAULTS = {"n_estimators": 20, "max_depth": 8, "max_features": "sqrt", "min_samples_leaf": 1}


def tree_xy(spark, sf, sort: bool = False):
    """(train xy, test xy, feature names) on the tree feature set."""
    train = train_frame(spark, sf)
    tr = FE.features_tree(train)
    te = FE.features_tree(test_frame(spark, sf), fit_on=train)
    xy_train, names = split_xy(tr, sort=sort)
    xy_test, _ = split_xy(te.select(*[c for c in tr.columns if c != S.TARGET]), sort=sort, label=S.TARGET)
    return xy_train, xy_test, names


def notebook_xy(spark, sf):
    """Label-coded baseline columns of the notebook (mode-filled arrival)."""
    train = normalize_columns(FX.raw_train(spark, sf))
    test = normalize_columns(FX.raw_test(spark, sf))
    fill = M.FillMode.fit(train, ["Arrival_Delay_in_Minutes"])
    train, test = fill.transform(train), fill.transform(test)
    for col, mapping in S.NOTEBOOK_CODES.items():
        train, test = E.map_values(train, col, mapping), E.map_values(test, col, mapping)
    train = E.encode_rating(train)
    xy_train, names = split_xy(train)
    xy_test, _ = split_xy(test)
    return xy_train, xy_test, names


@register("logistic_baseline_scores")
def logistic_baseline_scores(spark, sf):
    xy_train, xy_test, _ = notebook_xy(spark, sf)
    model = J.fit(J.logistic(n_rows=xy_train.count()), xy_train)
    return finish(J.score(model, xy_test))


@register("forest_scores")
def forest_scores(spark, sf):
    xy_train, xy_test, _ = tree_xy(spark, sf)
    model = J.fit(J.forest(FOREST_DEFAULTS), xy_train)
    return finish(J.score(model, xy_test))


@register("boosted_trees_scores")
def boosted_trees_scores(spark, sf):
    xy_train, xy_test, _ = tree_xy(spark, sf)
    model = J.fit(J.boosted_trees(BOOSTED_DEFAULTS), xy_train)
    return finish(J.score(model, xy_test, threshold=0.5))


@register("network_scores")
def network_scores(spark, sf):
    train = train_frame(spark, sf)
    tr = FE.features_nn(train)
    te = FE.features_nn(test_frame(spark, sf), fit_on=train)
    xy_train, names = split_xy(tr, sort=True)
    xy_test, _ = split_xy(te, sort=True)
    model = J.fit(J.mlp(len(names), hidden=(32, 16), max_iter=60), xy_train)
    return finish(J.score(model, xy_test, threshold=0.5, strict=True))


@register("feature_importance")
def feature_importance(spark, sf):
    xy_train, _, names = tree_xy(spark, sf)
    model = J.fit(J.boosted_trees(BOOSTED_DEFAULTS), xy_train)
    return finish(J.feature_importance(model, names, spark))


def _with_folds(xy, k=5, seed=42):
    return H.stratified_kfold(xy, S.TARGET, k=k, seed=seed)


@register("cv_accuracy")
def cv_accuracy(spark, sf):
    xy_train, _, _ = tree_xy(spark, sf)
    return finish(J.cv_score(J.boosted_trees(BOOSTED_DEFAULTS), _with_folds(xy_train), k=5))


@register("voting_ensemble_scores")
def voting_ensemble_scores(spark, sf):
    """Full feature set, best features, three tree models, weighted hard vote."""
    from cabinlens.operators.select import keep_features

    train = train_frame(spark, sf)
    tr = keep_features(FE.features_full(train), S.BEST_FEATURES)
    te = keep_features(FE.features_full(test_frame(spark, sf), fit_on=train), S.BEST_FEATURES)
    xy_train, _ = split_xy(tr)
    xy_test, _ = split_xy(te)
    model = J.fit(J.Voting([
        J.boosted_trees(BOOSTED_DEFAULTS), J.forest(FOREST_DEFAULTS), J.boosted_trees({**BOOSTED_DEFAULTS, "max_depth": 4}, seed=7),
    ], S.VOTE_WEIGHTS), xy_train)
    return model.transform(xy_test).select("id", "m0", "m1", "m2", F.col("prediction").cast("int").alias("vote"))


@register("random_search_trials")
def random_search_trials(spark, sf):
    xy_train, _, _ = tree_xy(spark, sf)
    space = {**L.FOREST_SPACE, "n_estimators": ("choice", [10, 20]), "max_depth": ("choice", [4, 6, 8])}
    return finish(L.random_search(lambda p: J.forest(p), _with_folds(xy_train, k=3), space, n=3, seed=393, k=3,
                                  name="forest"))


@register("feature_subset_trials")
def feature_subset_trials(spark, sf):
    wide = FE.features_full(train_frame(spark, sf))
    for x, d in (("Age", 3), ("Flight_Distance", 3), ("Departure_Delay_in_Minutes", 3), ("Arrival_Delay_in_Minutes", 3)):
        wide = wide.withColumn(f"{x}^{d}", F.col(f"`{x}`") ** d)
    wide = _with_folds(wide, k=3)
    return finish(L.feature_subset_search(lambda: J.boosted_trees({"n_estimators": 10, "max_depth": 4}), wide,
                                          FE.on_off_features(), n=3, seed=393, k=3))


@register("adversarial_split_learned")
def adversarial_split_learned(spark, sf):
    """Train rows most like test become validation (classifier on the stacked rows)."""
    drop = ["Gender", "Customer_Type", "Type_of_Travel", "Class"]
    train = train_frame(spark, sf).drop(*drop)
    test = test_frame(spark, sf).drop(*drop)
    training, validation, auc = H.adversarial_split(train, test, 0.2)
    return (
        training.select("id", F.lit("training").alias("part"))
        .unionByName(validation.select("id", F.lit("validation").alias("part")))
        .withColumn("adversarial_auc", F.lit(float(auc)))
    )


# ---------------------------------------------------------------------------
# What holds for any solver's result, stated in SQL: numbers of rows, ranges,
# labels as their cut of the score, and that a saved model scores as the fitted one.

_MODELS = ("boosted", "forest", "logistic", "network")


@register(
    "model_round_trip",
    base() + "SELECT model, (SELECT COUNT(*) FROM test) AS n_rows, true AS p_in_range, true AS label_is_cut, true AS loaded_scores_equal,"
    f" true AS beats_majority FROM (VALUES {', '.join(f'({chr(39)}{m}{chr(39)})' for m in _MODELS)}) AS m(model)",
)
def model_round_trip(spark, sf):
    """Fit, save, load and score each learner."""
    import uuid
    from functools import reduce

    from cabinlens.session import scratch_path
    from cabinlens.sources.io import load_model, save_model

    xy_train, xy_test, names = tree_xy(spark, sf)
    tr = FE.features_nn(train_frame(spark, sf))
    te = FE.features_nn(test_frame(spark, sf), fit_on=train_frame(spark, sf))
    nn_train, nn_names = split_xy(tr, sort=True)
    nn_test, _ = split_xy(te, sort=True)
    plans = {
        "boosted": (J.boosted_trees(BOOSTED_DEFAULTS), xy_train, xy_test), "forest": (J.forest(FOREST_DEFAULTS), xy_train, xy_test),
        "logistic": (J.logistic(maxIter=20), nn_train, nn_test), "network": (J.mlp(len(nn_names), hidden=(16,), max_iter=60), nn_train, nn_test),
    }
    out = []
    for name in _MODELS:
        estimator, train, test = plans[name]
        model = J.fit(estimator, train)
        path = scratch_path(spark, f"model-{name}-{uuid.uuid4().hex}")
        save_model(model, path)
        loaded = load_model(path)
        both = J.positive_probability(model.transform(test)).select("id", "features", F.col("p").alias("p0"))
        both = J.score(loaded, both, keep=("id", "p0"), threshold=0.5)
        # train accuracy against always answering the larger class
        right = J.score(model, train, keep=(S.TARGET,), threshold=0.5).agg(
            F.avg((F.col("prediction") == F.col(S.TARGET)).cast("double")).alias("a"), F.avg(S.TARGET).alias("share")).first()
        out.append(both.agg(
            F.lit(name).alias("model"), F.count("*").alias("n_rows"), F.min(F.col("p").between(0, 1)).alias("p_in_range"),
            F.min((F.col("p") >= 0.5).cast("int") == F.col("prediction")).alias("label_is_cut"),
            F.min(F.abs(F.col("p") - F.col("p0")) < 1e-12).alias("loaded_scores_equal"),
            F.lit(bool(right["a"] >= max(right["share"], 1 - right["share"]))).alias("beats_majority")))
    return reduce(lambda a, b: a.unionAll(b), out)


@register(
    "search_round_trip",
    base() + "SELECT search, 2 AS n_trials, true AS accuracy_in_range, true AS loss_is_negative, true AS best_is_max, true AS resumed_equal"
    " FROM (VALUES ('forest'), ('features')) AS s(search)",
)
def search_round_trip(spark, sf):
    """Search, store, resume and read the best trial."""
    import uuid
    from functools import reduce

    from cabinlens.operators.evaluate import best_trial
    from cabinlens.session import scratch_path

    xy_train, _, _ = tree_xy(spark, sf)
    folds = _with_folds(xy_train, k=2)
    wide = _with_folds(train_frame(spark, sf).select("id", S.TARGET, *S.SURVEY), k=2)
    path = scratch_path(spark, f"trials-{uuid.uuid4().hex}")
    space = {"n_estimators": ("choice", [5]), "max_depth": ("choice", [3, 4])}

    def forest_search():
        return L.random_search(J.forest, folds, space, n=2, seed=393, k=2, name="forest", path=path)

    def feature_trials():
        made = [{"features": list(S.SURVEY[:5])}, {"features": list(S.SURVEY)}]
        cached = wide.persist()
        try:
            return L._run(spark, "features", made, lambda t: L._mean(J.fold_accuracies(
                J.forest({"n_estimators": 5}), split_xy(cached.select("id", S.TARGET, "fold", *t["features"]), keep=("id", "fold"))[0], k=2)), path, 2)
        finally:
            cached.unpersist()

    out = []
    for run in (forest_search, feature_trials):
        first = run().collect()
        again = run()  # taken from the table
        best = best_trial(again, "params").first()
        out.append(again.groupBy("search").agg(
            F.count("*").cast("int").alias("n_trials"), F.min(F.col("accuracy").between(0, 1)).alias("accuracy_in_range"),
            F.min(F.col("loss") == -F.col("accuracy")).alias("loss_is_negative"), (F.max("accuracy") == F.lit(best["accuracy"])).alias("best_is_max"),
            F.lit(again.collect() == first and spark.read.parquet(path).where(F.col("search") == first[0]["search"]).count() == 2).alias("resumed_equal")))
    return reduce(lambda a, b: a.unionAll(b), out)
