"""Properties: folds, dummies, scaling, report consistency, partition invariance, plan shape."""

import pytest
from pyspark.sql import functions as F

from cabinlens import schema as S
from cabinlens.operators import derive as D
from cabinlens.operators import encode as E
from cabinlens.operators import evaluate as K
from cabinlens.operators import split as H
from cabinlens.plans import features as FE
from cabinlens.plans.catalog import train_frame
from cabinlens.sources import fixtures as FX


def test_stratified_fold_sizes(spark, sf):
    folds = H.stratified_kfold(train_frame(spark, sf), S.TARGET, k=5, seed=3)
    sizes = folds.groupBy(S.TARGET, "fold").count().collect()
    by_class = {}
    for r in sizes:
        by_class.setdefault(r[S.TARGET], []).append(r["count"])
    for counts in by_class.values():
        assert len(counts) == 5 and max(counts) - min(counts) <= 1


def test_folds_stable_under_repartition(spark, sf):
    df = train_frame(spark, sf)
    a = {r["id"]: r["fold"] for r in H.stratified_kfold(df, S.TARGET, 5, 11).collect()}
    b = {r["id"]: r["fold"] for r in H.stratified_kfold(df.repartition(3), S.TARGET, 5, 11).collect()}
    assert a == b
    k1 = {r["id"]: r["fold_0"] for r in H.kfold(df, 5).collect()}
    k2 = {r["id"]: r["fold_0"] for r in H.kfold(df.repartition(7), 5).collect()}
    assert k1 == k2


def test_survey_dummies_at_most_one(spark, sf):
    out = E.survey_dummies(train_frame(spark, sf))
    for x in S.SURVEY:
        total = sum(F.col(f"`{x}_{v}`") for v in range(1, 6))
        assert out.where(total > 1).count() == 0


def test_scaled_mean_zero_std_one(spark, sf):
    out = D.standard_scale(train_frame(spark, sf), S.NUMERIC)
    row = out.agg(*[F.avg(x).alias(f"m{i}") for i, x in enumerate(S.NUMERIC)],
                  *[F.stddev_pop(x).alias(f"s{i}") for i, x in enumerate(S.NUMERIC)]).first()
    for i in range(len(S.NUMERIC)):
        assert abs(row[f"m{i}"]) < 1e-9 and abs(row[f"s{i}"] - 1) < 1e-9


def test_report_agrees_with_confusion(spark, sf):
    scored = K.apply_threshold(FX.scored(spark, sf), "p_a", 0.5)
    cm = {(r["actual"], r["predicted"]): r["count"] for r in K.confusion_matrix(scored).collect()}
    rep = {r["label"]: r for r in K.classification_report(scored).collect()}
    tp, fp, fn = cm[(1, 1)], cm[(0, 1)], cm[(1, 0)]
    assert rep["1"]["precision"] == pytest.approx(tp / (tp + fp))
    assert rep["1"]["recall"] == pytest.approx(tp / (tp + fn))
    assert rep["1"]["support"] == tp + fn


def test_top_fraction_exact(spark, sf):
    from cabinlens.operators.select import top_fraction

    df = FX.scored(spark, sf).select("id", "p_b")
    top, rest = top_fraction(df, "p_b", 0.2)
    n = df.count()
    assert top.count() == int(n * 0.2) and rest.count() == n - int(n * 0.2)
    assert top.agg(F.min("p_b")).first()[0] >= rest.agg(F.max("p_b")).first()[0]


def test_full_features_plan_has_no_cartesian_or_global_window(spark, sf):
    plan = FE.features_full(train_frame(spark, sf))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "SinglePartition" not in plan


def test_scan_prunes_columns(spark, sf):
    df = FX.passengers(spark, sf).select("id", "Age")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan


def test_quantiles_and_modes_match_builtin(spark, sf):
    from cabinlens.functions import stats

    df = train_frame(spark, sf)
    cols = ["id", "Age", "Arrival_Delay_in_Minutes", "Online_Boarding"]
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    found = stats.quantiles(df, cols, probs)
    row = df.agg(*[F.expr(f"percentile(CAST({x} AS DOUBLE), array({', '.join(map(str, probs))}))").alias(x) for x in cols],
                 *[F.expr(f"mode({x}, true)").alias(f"m_{x}") for x in [*cols, "Class"]]).first()
    for x in cols:
        assert found[x] == pytest.approx(row[x], abs=1e-9)
    assert stats.modes(df, [*cols, "Class"]) == {x: row[f"m_{x}"] for x in [*cols, "Class"]}


def test_value_table_keeps_types(spark):
    """Longs beyond 2**53, NaN, -0.0, text, booleans, NULL and empty tables."""
    from cabinlens.functions.value_table import ValueTable
    from cabinlens.operators import profile as P

    big = 9007199254740993
    rows = [(big, 0.0, "b", True), (big, -0.0, "b", None), (big - 1, float("nan"), None, True), (None, float("nan"), "a", False), (5, float("nan"), "a", None)]
    df = spark.createDataFrame(rows, "x long, y double, s string, t boolean")
    values = ValueTable.of(df, df.columns)
    found = values.modes()
    assert found["x"] == big and found["s"] == "a" and found["t"] is True and found["y"] != found["y"]
    assert {r["column"]: r["distinct"] for r in P.distinct_counts(df, df.columns).collect()} == {"x": 4, "y": 2, "s": 3, "t": 3}
    codes = [sorted(tuple(r) for r in t.collect()) for t in values.codes()]
    assert codes[0] == [(5, 1), (big - 1, 2), (big, 3)] and codes[2] == [("a", 1), ("b", 2)]
    none = ValueTable.of(df.limit(0), df.columns)
    assert none.modes() == {x: None for x in df.columns} and none.quantiles([0.5])["x"] == [None]
    assert P.distinct_counts(df.limit(0), ["x"]).first()["distinct"] == 0


def test_moments_of_a_value_table_match_builtin(spark, sf):
    from cabinlens.functions.value_table import ValueTable

    df = train_frame(spark, sf).withColumn("constant", F.lit(0.1)).withColumn("none", F.lit(None).cast("double"))
    cols = ["id", "Age", "Flight_Distance", "Arrival_Delay_in_Minutes", "constant", "none"]
    got = {cols[r["k"]]: r for r in ValueTable.of(df, cols).moments().collect()}
    assert "none" not in got and got["constant"]["std"] == pytest.approx(0, abs=1e-12) and got["constant"]["g1"] is None
    for x in cols[:4]:
        want = df.agg(F.avg(x), F.stddev_samp(x), F.min(x), F.max(x), F.skewness(x), F.kurtosis(x), F.count(x)).first()
        assert [got[x][y] for y in ("mean", "std", "min", "max", "g1", "g2", "count")] == pytest.approx(list(want), rel=1e-9)


def test_more_than_ten_thousand_categories(spark):
    """Codes and frequencies of any number of categories, unseen and NULL values."""
    from cabinlens.operators import encode as E2

    df = spark.range(24000).select("id", F.when(F.col("id") > 0, F.concat(F.lit("c"), F.col("id") % 12000)).alias("x"), (F.col("id") % 7).alias("y"))
    fitted = E2.CategoryCodes.fit(df, ["x", "y"])
    more = df.unionAll(spark.createDataFrame([(-1, "unseen", 99)], "id long, x string, y long"))
    got = {r["id"]: r for r in fitted.transform(more).collect()}
    place = {v: i for i, v in enumerate(sorted(f"c{i}" for i in range(12000)), 1)}
    assert got[0]["x"] == 0 and got[-1]["x"] == 0 and got[-1]["y"] == 0 and len(got) == 24001
    assert all(got[i]["x"] == place[f"c{i % 12000}"] and got[i]["y"] == i % 7 + 1 for i in range(1, 24000))
    freq = E2.FrequencyEncoder.fit(df, ["x", "y"]).transform(more)
    assert freq.columns == ["id", "x", "y", "x_freq", "y_freq"]
    rows = {r["id"]: r for r in freq.collect()}
    assert rows[0]["x_freq"] is None and rows[-1]["x_freq"] is None and rows[5]["x_freq"] == pytest.approx(2 / 23999)
    assert rows[12000]["x_freq"] == pytest.approx(1 / 23999) and rows[3]["y_freq"] == pytest.approx(3429 / 24000)
