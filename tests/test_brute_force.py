"""Distributed evaluators against direct numpy computations on random frames."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cabinlens.functions.ordered import with_global_rank, with_prefix_sums
from cabinlens.operators import evaluate as K
from pyspark.sql import functions as F

scores = st.lists(st.tuples(st.integers(0, 1), st.integers(0, 20), st.integers(0, 2)), min_size=4, max_size=60)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _frame(spark, rows):
    return spark.createDataFrame([(i, y, s / 20.0, f) for i, (y, s, f) in enumerate(rows)],
                                 "id long, y int, p double, fold int")


@SETTINGS
@given(rows=scores)
def test_roc_auc_matches_pair_count(spark, rows):
    y = np.array([r[0] for r in rows])
    p = np.array([r[1] / 20.0 for r in rows])
    pos, neg = p[y == 1], p[y == 0]
    got = K.roc_auc(_frame(spark, rows), "y", "p")
    if len(pos) == 0 or len(neg) == 0:
        assert np.isnan(got)
        return
    want = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert got == pytest.approx(want)


@SETTINGS
@given(rows=scores, strict=st.booleans())
def test_threshold_search_matches_direct(spark, rows, strict):
    cands = [0.1, 0.25, 0.5, 0.5001, 0.75, 0.95]
    got = {r["threshold"]: r["accuracy"]
           for r in K.threshold_search(_frame(spark, rows), cands, strict=strict).collect()}
    y = np.array([r[0] for r in rows])
    p = np.array([r[1] / 20.0 for r in rows])
    f = np.array([r[2] for r in rows])
    for t in cands:
        accs = []
        for fold in sorted(set(f.tolist())):
            m = f == fold
            pred = (p[m] > t) if strict else (p[m] >= t)
            accs.append((pred.astype(int) == y[m]).mean())
        assert got[t] == pytest.approx(np.mean(accs))


@SETTINGS
@given(values=st.lists(st.integers(0, 5), min_size=1, max_size=80))
def test_rank_and_prefix_sums_are_exact(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, v int")
    ranked = {r["id"]: r["rank"] for r in with_global_rank(df, [F.col("v").desc(), F.col("id")], "rank",
                                                             num_partitions=3).collect()}
    order = sorted(range(len(values)), key=lambda i: (-values[i], i))
    assert ranked == {i: pos for pos, i in enumerate(order)}
    pref = {r["id"]: r["v_before"] for r in with_prefix_sums(df, [F.col("id")], ["v"], num_partitions=3).collect()}
    assert pref == {i: float(sum(values[:i])) for i in range(len(values))}
