"""Hand-made edge frames (FIXTURES F4) with hand-computed expectations."""

import math

import pytest

from cabinlens import schema as S
from cabinlens.functions.exprs import cut
from cabinlens.operators import derive as D
from cabinlens.operators import encode as E
from cabinlens.operators import evaluate as K
from cabinlens.operators import missing as M
from cabinlens.operators import profile as P
from pyspark.sql import functions as F


def test_edge_bins(spark):
    df = spark.createDataFrame([(x,) for x in (0, 18, 19, 35, 60, 100, 101, None)], "Age int")
    got = [r[0] for r in df.select(cut(F.col("Age"), *S.AGE_BINS)).collect()]
    assert got == [None, "Child", "Young_Adult", "Young_Adult", "Adult", "Senior", None, None]
    dist = spark.createDataFrame([(x,) for x in (0, 500, 5000, 5001)], "d int")
    got = [r[0] for r in dist.select(cut(F.col("d"), *S.DISTANCE_BINS)).collect()]
    assert got == [None, "Short-Haul", "Long-Haul", None]
    diff = spark.createDataFrame([(x,) for x in (-5.0, -4.9, 5.0, 5.1, None)], "d double")
    got = [r[0] for r in diff.select(cut(F.col("d"), *S.DELAY_DIFF_BINS)).collect()]
    assert got == ["Made_Up_Time", "No_Delay_Change", "No_Delay_Change", "Lost_Time", None]
    delay = spark.createDataFrame([(0,), (15,), (1439,), (1440,)], "d int")
    got = [r[0] for r in delay.select(cut(F.col("d"), *S.DELAY_GROUP_BINS, right=False)).collect()]
    assert got == ["<15min", "15-60min", "12-24hrs", None]


def test_edge_mode(spark):
    df = spark.createDataFrame([(1, None, 0), (3, None, 0), (3, None, 0), (1, None, 0), (2, None, 0)],
                               "a int, b int, z int")
    assert M.mode_values(df, ["a", "b", "z"]) == {"a": 1, "b": None, "z": 0}
    filled = M.FillMode.fit(df, ["a"]).transform(spark.createDataFrame([(None,), (7,)], "a int"))
    assert [r[0] for r in filled.collect()] == [1, 7]


def test_edge_group(spark):
    groups = {"g": ["x", "y", "z"]}
    df = spark.createDataFrame(
        [(1, 0, 3, 5), (2, 0, 0, 4), (3, 0, 0, 0), (4, 0, None, None), (5, 2, 0, None)],
        "id int, x int, y int, z int",
    )
    out = {r["id"]: (r["x"], r["y"], r["z"]) for r in M.impute_group_mean(df, groups).collect()}
    assert out[1] == (4.0, 3.0, 5.0)
    # x takes (0 + 4) / 2 = 2, then y sees the filled x: (2 + 4) / 2 = 3
    assert out[2] == (2.0, 3.0, 4.0)
    assert out[3] == (0.0, 0.0, 0.0)           # an all-zero group stays 0
    assert out[4][0] == 0.0                     # NULL peers -> mode of x in the frame (0)
    assert out[5] == (2.0, 2.0, None)
    intent = {r["id"]: (r["x"], r["y"], r["z"]) for r in
              M.impute_group_mean(df, groups, ignore_zero_peers=True).collect()}
    assert intent[2] == (4.0, 4.0, 4.0)


def test_edge_dummies(spark):
    train = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", 5.0)], "cat string, s double")
    test = spark.createDataFrame([("a", 2.5), ("b", 1.0)], "cat string, s double")
    model = E.OneHot.fit(train, ["cat"], drop_first=True)
    out = model.transform(test).collect()
    assert [(r["cat_b"], r["cat_c"]) for r in out] == [(0, 0), (1, 0)]
    sd = E.survey_dummies(test, ["s"]).columns
    assert sd == ["cat", "s_1", "s_2", "s_3", "s_4", "s_5"]
    extra = E.survey_dummies(test, ["s"], extra_values=True)
    assert "s_2.5" in extra.columns and extra.where("`s_2.5` = 1").count() == 1
    two = spark.createDataFrame([("x",), (None,)], "g string")
    assert E.onehot(two, ["g"]).columns == ["g_nan"]


def test_edge_hist(spark):
    train = spark.createDataFrame([(1.0,), (1.0,), (2.0,), (3.0,)], "v double")
    test = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (4.0,)], "v double")
    got = P.stability_index(train, test, ["v"]).first()["stability_index"]
    # shared values 1 and 2: (0.5-0.25)^2 + (0.25-0.25)^2, divided by 4 train rows
    assert got == pytest.approx(0.0625 / 4)
    outer = P.stability_index(train, test, ["v"], outer=True).first()["stability_index"]
    assert outer == pytest.approx((0.0625 + 0.0625 + 0.25) / 4)


def test_edge_scores(spark):
    df = spark.createDataFrame([(1, 1, 0.5), (2, 0, 0.9), (3, 1, 0.2), (4, 0, 0.5)], "id int, y int, p double")
    ge = {r["id"]: r["prediction"] for r in K.apply_threshold(df, "p", 0.5).collect()}
    gt = {r["id"]: r["prediction"] for r in K.apply_threshold(df, "p", 0.5, strict=True).collect()}
    assert ge == {1: 1, 2: 1, 3: 0, 4: 1} and gt == {1: 0, 2: 1, 3: 0, 4: 0}
    none_pos = K.apply_threshold(df, "p", 0.95)
    rep = {r["label"]: r for r in K.classification_report(none_pos, "y", "prediction").collect()}
    assert rep["1"]["precision"] == 0.0 and rep["1"]["recall"] == 0.0 and rep["1"]["f1_score"] == 0.0
    single = spark.createDataFrame([(1, 1, 0.7), (2, 1, 0.3)], "id int, y int, p double")
    assert math.isnan(K.roc_auc(single, "y", "p"))
    ties = spark.createDataFrame([(1, 1, 0.5), (2, 0, 0.5), (3, 1, 0.9), (4, 0, 0.1)], "id int, y int, p double")
    assert K.roc_auc(ties, "y", "p") == pytest.approx(0.875)


def test_qcut_labels():
    assert D.interval_labels([31.0, 425.0, 1000.5, 2000.25, 4983.0]) == [
        "(30.999, 425.0]", "(425.0, 1000.5]", "(1000.5, 2000.25]", "(2000.25, 4983.0]"]


def test_expand_selection():
    cols = D.expand_selection({"Age_Selection": "cubed", "Delay_Selection": "total", "Cleanliness": True,
                               "Leg_Room": False})
    assert cols == ["Cleanliness", "Age", "Age^2", "Age^3", "Total_Delay_Minutes"]
