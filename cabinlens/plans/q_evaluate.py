"""Queries for scoring, thresholds, ensembles, evaluation, splits and folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from cabinlens import schema as S
from cabinlens.operators import evaluate as K
from cabinlens.operators import select as SEL
from cabinlens.operators import split as H
from cabinlens.plans.catalog import finish, register, test_frame, train_frame
from cabinlens.plans.oracle import base, r6
from cabinlens.sources import fixtures as FX
from cabinlens.sources.io import submission

HASH_SQL = "CAST('0x' || substr(md5(concat(id, '-', {seed})), 1, 8) AS BIGINT)"


def _scored(spark, sf):
    return FX.scored(spark, sf)


def _pred(spark, sf, p="p_a", t=0.5, strict=False):
    return K.apply_threshold(_scored(spark, sf), p, t, strict)


# -- K1 / K2 / K3 / K4 / K5 -------------------------------------------------
@register(
    "accuracy",
    base() + "SELECT " + r6("AVG(CASE WHEN y = CAST(p_a >= 0.5 AS INTEGER) THEN 1.0 ELSE 0.0 END)")
    + " AS accuracy FROM scored",
)
def accuracy(spark, sf):
    return finish(K.accuracy(_pred(spark, sf)))


@register(
    "confusion_matrix",
    base("pr AS (SELECT y, CAST(p_b >= 0.5 AS INTEGER) AS pred FROM scored)")
    + "SELECT a.actual, b.predicted, (SELECT count(*) FROM pr WHERE y = a.actual AND pred = b.predicted) AS count"
    " FROM (VALUES (0), (1)) a(actual), (VALUES (0), (1)) b(predicted)",
)
def confusion_matrix(spark, sf):
    return K.confusion_matrix(_pred(spark, sf, "p_b"))


def _report_sql() -> str:
    cte = (
        "pr AS (SELECT y, CAST(p_c >= 0.5 AS INTEGER) AS pred FROM scored), "
        "m AS (SELECT CAST(SUM(CASE WHEN y = 1 AND pred = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp,"
        " CAST(SUM(CASE WHEN y = 0 AND pred = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS fp,"
        " CAST(SUM(CASE WHEN y = 1 AND pred = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS fn,"
        " CAST(SUM(CASE WHEN y = 0 AND pred = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS tn FROM pr), "
        "k AS (SELECT CASE WHEN tn + fn = 0 THEN 0 ELSE tn / (tn + fn) END AS p0,"
        " CASE WHEN tn + fp = 0 THEN 0 ELSE tn / (tn + fp) END AS r0,"
        " CASE WHEN 2 * tn + fn + fp = 0 THEN 0 ELSE 2 * tn / (2 * tn + fn + fp) END AS f0, tn + fp AS s0,"
        " CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS p1,"
        " CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS r1,"
        " CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1, tp + fn AS s1,"
        " (tp + tn) / (tp + tn + fp + fn) AS acc FROM m)"
    )
    rows = [
        ("'0'", "p0", "r0", "f0", "s0"),
        ("'1'", "p1", "r1", "f1", "s1"),
        ("'accuracy'", "NULL", "NULL", "acc", "s0 + s1"),
        ("'macro avg'", "(p0 + p1) / 2", "(r0 + r1) / 2", "(f0 + f1) / 2", "s0 + s1"),
        ("'weighted avg'", "(p0 * s0 + p1 * s1) / (s0 + s1)", "(r0 * s0 + r1 * s1) / (s0 + s1)",
         "(f0 * s0 + f1 * s1) / (s0 + s1)", "s0 + s1"),
    ]
    body = "\nUNION ALL\n".join(
        f"SELECT {lab} AS label, {r6(p)} AS precision, {r6(r)} AS recall, {r6(f)} AS f1_score,"
        f" CAST({s} AS BIGINT) AS support FROM k"
        for lab, p, r, f, s in rows
    )
    return base(cte) + body


@register("classification_report", _report_sql())
def classification_report(spark, sf):
    return finish(K.classification_report(_pred(spark, sf, "p_c")))


@register(
    "wrong_predictions",
    base()
    + "SELECT train.*, scored.y AS true_labels, CAST(scored.p_a >= 0.5 AS INTEGER) AS predicted_labels"
    " FROM train JOIN scored USING (id) WHERE scored.y <> CAST(scored.p_a >= 0.5 AS INTEGER)",
)
def wrong_predictions(spark, sf):
    preds = _pred(spark, sf).select("id", "y", "prediction")
    wrong = K.wrong_predictions(preds).select("id", "true_labels", "predicted_labels")
    return finish(train_frame(spark, sf).join(wrong, "id"))


@register(
    "threshold_inclusive_strict",
    base()
    + "SELECT id, CAST(p_a >= 0.5 AS INTEGER) AS pred_ge, CAST(p_a > 0.5 AS INTEGER) AS pred_gt,"
    " CAST(p_b >= 0.9 AS INTEGER) AS pred_ge_09 FROM scored",
)
def threshold_inclusive_strict(spark, sf):
    df = K.apply_threshold(_scored(spark, sf), "p_a", 0.5, False, "pred_ge")
    df = K.apply_threshold(df, "p_a", 0.5, True, "pred_gt")
    df = K.apply_threshold(df, "p_b", 0.9, False, "pred_ge_09")
    return df.select("id", "pred_ge", "pred_gt", "pred_ge_09")


# -- K6 ---------------------------------------------------------------------
def _auc_sql(col: str) -> str:
    return (
        f"SELECT '{col}' AS score, {r6('(SUM(CASE WHEN y = 1 THEN rk ELSE 0 END) - P * (P + 1) / 2) / (P * N)')} AS auc"
        f" FROM (SELECT y, RANK() OVER (ORDER BY {col}) + (COUNT(*) OVER (PARTITION BY {col}) - 1) / 2.0 AS rk,"
        f" SUM(CASE WHEN y = 1 THEN 1 ELSE 0 END) OVER () AS P, SUM(CASE WHEN y = 1 THEN 0 ELSE 1 END) OVER () AS N"
        f" FROM scored) GROUP BY P, N"
    )


@register("roc_auc", base() + "\nUNION ALL\n".join(_auc_sql(x) for x in ("p_a", "p_b", "p_c")))
def roc_auc(spark, sf):
    return finish(K.roc_auc_table(_scored(spark, sf), "y", ["p_a", "p_b", "p_c"]))


# -- K8 / L3 ----------------------------------------------------------------
CANDIDATES = [round(0.30 + 0.01 * i, 2) for i in range(41)]
_CANDS_SQL = "(VALUES " + ", ".join(f"({t!r}::DOUBLE)" for t in CANDIDATES) + ") t(threshold)"
_FOLD_SQL = f"CAST({HASH_SQL.format(seed=42)} % 5 AS INTEGER)"
_SWEEP_SQL = (
    f"f AS (SELECT y, p_a, {_FOLD_SQL} AS fold FROM scored), "
    f"sweep AS (SELECT threshold, AVG(acc) AS accuracy FROM (SELECT t.threshold, f.fold,"
    f" AVG(CASE WHEN CAST(f.p_a >= t.threshold AS INTEGER) = f.y THEN 1.0 ELSE 0.0 END) AS acc"
    f" FROM f CROSS JOIN {_CANDS_SQL} GROUP BY 1, 2) GROUP BY 1)"
)


def _oof(spark, sf):
    return H.kfold(_scored(spark, sf), k=5, seed=42).withColumnRenamed("fold_0", "fold")


@register("threshold_sweep", base(_SWEEP_SQL) + f"SELECT threshold, {r6('accuracy')} AS accuracy FROM sweep")
def threshold_sweep(spark, sf):
    return finish(K.threshold_search(_oof(spark, sf), CANDIDATES, y="y", p="p_a"))


@register(
    "best_threshold",
    base(_SWEEP_SQL)
    + f"SELECT threshold, {r6('accuracy')} AS accuracy FROM sweep ORDER BY accuracy DESC, threshold ASC LIMIT 1",
)
def best_threshold(spark, sf):
    sweep = K.threshold_search(_oof(spark, sf), CANDIDATES, y="y", p="p_a")
    return finish(K.best_trial(sweep, "threshold", "accuracy"))


# -- J5 / J6 ----------------------------------------------------------------
@register(
    "hard_vote",
    base(
        "v AS (SELECT id, CAST(p_a >= 0.5 AS INTEGER) AS a, CAST(p_b >= 0.5 AS INTEGER) AS b,"
        " CAST(p_c >= 0.5 AS INTEGER) AS c FROM scored)"
    )
    + "SELECT id, a, b, c, CAST(a * 1.0 + b * 1.0 + c * 1.5 > (1 - a) * 1.0 + (1 - b) * 1.0 + (1 - c) * 1.5"
    " AS INTEGER) AS vote FROM v",
)
def hard_vote(spark, sf):
    df = _scored(spark, sf)
    for p, name in (("p_a", "a"), ("p_b", "b"), ("p_c", "c")):
        df = K.apply_threshold(df, p, 0.5, False, name)
    return K.hard_vote(df, ["a", "b", "c"], S.VOTE_WEIGHTS).select("id", "a", "b", "c", "vote")


@register(
    "blend_scores",
    base()
    + f"SELECT id, {r6('0.5 * p_a + 0.5 * p_c')} AS blend_p, CAST(0.5 * p_a + 0.5 * p_c > 0.5 AS INTEGER) AS blend"
    " FROM scored",
)
def blend_scores(spark, sf):
    return finish(K.blend(_scored(spark, sf), "p_a", "p_c", 0.5).select("id", "blend_p", "blend"))


# -- A4 ---------------------------------------------------------------------
@register(
    "submission_labels",
    base()
    + "SELECT raw_test.id, CASE CAST(scored.p_a >= 0.5 AS INTEGER) WHEN 0 THEN 'Neutral / Dissatisfied'"
    " WHEN 1 THEN 'Satisfied' END AS \"Satisfaction Rating\" FROM raw_test LEFT JOIN scored USING (id)",
)
def submission_labels(spark, sf):
    sample = FX.raw_test(spark, sf).select("id", F.lit("Satisfied").alias(S.RAW_TARGET))
    preds = _pred(spark, sf)
    return submission(sample, preds)


# -- E5 / E6 / E7 / F1 / F4 / F5 --------------------------------------------
@register("sort_by_score", base() + "SELECT id, p_a FROM scored ORDER BY p_a DESC, id")
def sort_by_score(spark, sf):
    return SEL.sort_desc(_scored(spark, sf).select("id", "p_a"), "p_a")


_TOP_SQL = (
    "ranked AS (SELECT id, p_b, ROW_NUMBER() OVER (ORDER BY p_b DESC, id) - 1 AS rk FROM scored"
    " WHERE id % 4 <> 0), "
    "cut AS (SELECT CAST(FLOOR(COUNT(*) * 0.2) AS BIGINT) AS k FROM ranked)"
)


@register("top_fraction", base(_TOP_SQL) + "SELECT id, p_b FROM ranked WHERE rk < (SELECT k FROM cut)")
def top_fraction(spark, sf):
    train_scores = _scored(spark, sf).join(train_frame(spark, sf).select("id"), "id").select("id", "p_b")
    top, _ = SEL.top_fraction(train_scores, "p_b", 0.2)
    return top


@register("head_preview", base() + "SELECT * FROM train ORDER BY id LIMIT 5")
def head_preview(spark, sf):
    return finish(SEL.head(train_frame(spark, sf), 5))


@register(
    "attach_predictions",
    base() + "SELECT test.*, CAST(scored.p_a >= 0.5 AS INTEGER) AS prediction FROM test LEFT JOIN scored USING (id)",
)
def attach_predictions(spark, sf):
    return finish(SEL.attach(test_frame(spark, sf), _pred(spark, sf), ["prediction"]))


@register(
    "stack_train_test",
    base()
    + "SELECT * EXCLUDE (Satisfaction_Rating), 0 AS is_test FROM train UNION ALL SELECT *, 1 AS is_test FROM test",
)
def stack_train_test(spark, sf):
    train = train_frame(spark, sf).drop(S.TARGET).withColumn("is_test", F.lit(0))
    test = test_frame(spark, sf).withColumn("is_test", F.lit(1))
    return finish(SEL.union_rows(train, test))


@register(
    "minus_top_fraction",
    base(_TOP_SQL) + "SELECT id FROM train WHERE id NOT IN (SELECT id FROM ranked WHERE rk < (SELECT k FROM cut))",
)
def minus_top_fraction(spark, sf):
    train_scores = _scored(spark, sf).join(train_frame(spark, sf).select("id"), "id").select("id", "p_b")
    top, _ = SEL.top_fraction(train_scores, "p_b", 0.2)
    return SEL.minus_rows(train_frame(spark, sf).select("id"), top)


# -- H1 / H2 / H3 / H4 / H5 -------------------------------------------------
def _unit(seed: int) -> str:
    return f"({HASH_SQL.format(seed=seed)} / 4294967296.0)"


@register(
    "nested_holdout_split",
    base()
    + f"SELECT id, CASE WHEN {_unit(42)} < 0.15 THEN 'test' WHEN {_unit(43)} < 0.1765 THEN 'val' ELSE 'train' END"
    " AS part FROM train",
)
def nested_holdout_split(spark, sf):
    return H.split_column(train_frame(spark, sf), [("test", 0.15), ("val", 0.1765)], seed=42).select("id", "part")


@register(
    "repeated_kfold",
    base()
    + "SELECT id, "
    + ", ".join(f"CAST({HASH_SQL.format(seed=42 + r)} % 5 AS INTEGER) AS fold_{r}" for r in range(3))
    + " FROM train",
)
def repeated_kfold(spark, sf):
    return H.kfold(train_frame(spark, sf), k=5, repeats=3, seed=42).select("id", "fold_0", "fold_1", "fold_2")


@register(
    "stratified_folds",
    base()
    + f"SELECT id, Satisfaction_Rating, CAST((ROW_NUMBER() OVER (PARTITION BY Satisfaction_Rating"
    f" ORDER BY {HASH_SQL.format(seed=7)}, id) - 1) % 5 AS INTEGER) AS fold FROM train",
)
def stratified_folds(spark, sf):
    out = H.stratified_kfold(train_frame(spark, sf).select("id", S.TARGET), S.TARGET, k=5, seed=7)
    return out.select("id", S.TARGET, "fold")


@register(
    "adversarial_validation_split",
    base(_TOP_SQL)
    + "SELECT id, CASE WHEN id IN (SELECT id FROM ranked WHERE rk < (SELECT k FROM cut)) THEN 'validation'"
    " ELSE 'training' END AS part FROM train",
)
def adversarial_validation_split(spark, sf):
    scored_train = train_frame(spark, sf).join(_scored(spark, sf).select("id", "p_b"), "id")
    training, validation, _ = H.adversarial_split(scored_train, test_frame(spark, sf), 0.2, score_col="p_b")
    return (
        training.select("id", F.lit("training").alias("part"))
        .unionByName(validation.select("id", F.lit("validation").alias("part")))
    )


@register(
    "pseudo_labels",
    base()
    + "SELECT id, Satisfaction_Rating, 'train' AS source FROM train UNION ALL"
    " SELECT test.id, CAST(scored.p_c > 0.5 AS INTEGER), 'test' FROM test JOIN scored USING (id)"
    " WHERE scored.p_c > 0.9",
)
def pseudo_labels(spark, sf):
    train = train_frame(spark, sf).select("id", S.TARGET, F.lit("train").alias("source"))
    scored_test = (
        test_frame(spark, sf).select("id").join(_scored(spark, sf).select("id", "p_c"), "id")
        .withColumn("source", F.lit("test"))
    )
    return H.pseudo_label(train, scored_test, "p_c", 0.9).select("id", S.TARGET, "source")

