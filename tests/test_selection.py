"""Order statistics by histogram refinement, top fraction and stratified folds."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from cabinlens.functions import selection
from cabinlens.operators import split as H
from cabinlens.operators.select import top_fraction


def ordered(rows):
    """Rows (score, id) by descending score, NaN first, nulls last, then id."""
    def place(r):
        s = r[0]
        kind = 4 if s is None else 0 if math.isnan(s) else 1 if s == math.inf else 3 if s == -math.inf else 2
        return (kind, -s if kind == 2 else 0.0, r[1])

    return sorted(rows, key=place)


def scores(rng, n):
    kinds = [lambda: rng.random(), lambda: rng.choice([0.5, 0.25]), lambda: rng.gauss(0, 1e300), lambda: rng.random() * 1e-300,
             lambda: None, lambda: math.nan, lambda: math.inf, lambda: -math.inf, lambda: -0.0, lambda: 0.0]
    return [rng.choice(kinds)() for _ in range(n)]


@pytest.mark.parametrize("small,bins", [(4096, 4096), (1, 4), (3, 64)])
@pytest.mark.parametrize("tie", ["long", "string", "double"])
def test_top_fraction_is_the_sorted_prefix(spark, monkeypatch, small, bins, tie):
    monkeypatch.setattr(selection, "SMALL", small)
    monkeypatch.setattr(selection, "BINS", bins)
    rng = random.Random(small)
    ids = [rng.randrange(-(1 << 62), 1 << 62) for _ in range(400)]
    ids = {"long": ids, "string": [f"é{i % 97}-{i}" for i in ids], "double": [float(i) / 7 for i in ids]}[tie]
    rows = list(zip(scores(rng, 400), ids))
    df = spark.createDataFrame(rows, f"p double, key {tie}")
    want = ordered(rows)
    for frac in (0.0, 0.01, 0.2, 0.5, 0.93, 1.0):
        top, rest = top_fraction(df, "p", frac, tie="key")
        k = int(len(rows) * frac)
        assert sorted(r["key"] for r in top.collect()) == sorted(i for _, i in want[:k])
        assert sorted(r["key"] for r in rest.collect()) == sorted(i for _, i in want[k:])


def test_one_score_for_all_rows(spark, monkeypatch):
    monkeypatch.setattr(selection, "SMALL", 10)
    df = spark.range(5000).select((F.col("id") * 7919 % 5000 - 2500).alias("id"), F.lit(0.25).alias("p"))
    top, rest = top_fraction(df, "p", 0.3)
    assert (top.count(), top.agg(F.max("id")).first()[0], rest.count()) == (1500, -1001, 3500)


def test_top_fraction_plan_has_no_sort(spark):
    df = spark.range(1000).select("id", (F.col("id") / 1000).alias("p"))
    for part in top_fraction(df, "p", 0.2):
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "Sort" not in plan and "Exchange" not in plan and "RDD" not in plan


def test_repeated_keys_stay_together(spark):
    df = spark.createDataFrame([(1, 0.9), (2, 0.5), (2, 0.5), (3, 0.1)], "id long, p double")
    top, rest = top_fraction(df, "p", 0.5)
    assert [r.id for r in top.collect()] == [1] and sorted(r.id for r in rest.collect()) == [2, 2, 3]


def test_folds_of_many_classes(spark):
    """More than 10,000 classes, null among them; folds are ranks in hash order."""
    rows = [(i, None if i % 13 == 0 else f"c{i % 10700}") for i in range(24000)]
    df = spark.createDataFrame(rows, "id long, label string")
    got = {r["id"]: r["fold"] for r in H.stratified_kfold(df, "label", k=3, seed=5).collect()}
    by_class: dict = {}
    for i, y in rows:
        by_class.setdefault(y, []).append((int(hashlib.md5(f"{i}-5".encode()).hexdigest()[:8], 16), i))
    want = {i: place % 3 for own in by_class.values() for place, (_, i) in enumerate(sorted(own))}
    assert got == want


def test_folds_over_several_buckets(spark):
    df = spark.range(3000).select("id", (F.col("id") % 2).alias("y"))
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 20))
    got = selection.bucket_ranks(df, F.col("y"), place, 1 << 20, F.col("id"), "r", rows_a_bucket=100)
    assert got.columns == ["id", "y", "r"]
    rows = got.withColumn("p", place).collect()
    for y in (0, 1):
        own = sorted((r["p"], r["id"], r["r"]) for r in rows if r["y"] == y)
        assert [r for _, _, r in own] == list(range(1500))
