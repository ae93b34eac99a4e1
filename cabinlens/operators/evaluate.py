"""Thresholds, votes, blends and evaluation reports over scored tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabinlens.functions.exprs import c, safe_div
from cabinlens.functions.ordered import with_prefix_sums
from cabinlens.operators.select import filter_mask


# -- K5 ---------------------------------------------------------------------
def threshold_expr(p: str, t: float, strict: bool = False):
    return ((c(p) > F.lit(t)) if strict else (c(p) >= F.lit(t))).cast("int")


def apply_threshold(df: DataFrame, p: str, t: float = 0.5, strict: bool = False, name: str = "prediction") -> DataFrame:
    """``p >= t`` (trees) or ``p > t`` (network, blend) as 0/1."""
    return df.withColumn(name, threshold_expr(p, t, strict))


# -- J5 / J6 ----------------------------------------------------------------
def hard_vote(df: DataFrame, preds: Sequence[str], weights: Sequence[float], name: str = "vote") -> DataFrame:
    """Weighted label vote; a tie goes to the lower class."""
    w1 = sum((F.when(c(p) == 1, F.lit(float(w))).otherwise(F.lit(0.0)) for p, w in zip(preds, weights)), F.lit(0.0))
    w0 = sum((F.when(c(p) == 0, F.lit(float(w))).otherwise(F.lit(0.0)) for p, w in zip(preds, weights)), F.lit(0.0))
    return df.withColumn(name, (w1 > w0).cast("int"))


def blend(df: DataFrame, a: str, b: str, alpha: float = 0.5, cut: float = 0.5, name: str = "blend") -> DataFrame:
    """``alpha * a + (1 - alpha) * b``, labelled by ``> cut``."""
    p = F.lit(alpha) * c(a) + F.lit(1.0 - alpha) * c(b)
    return df.withColumn(f"{name}_p", p).withColumn(name, (F.col(f"{name}_p") > F.lit(cut)).cast("int"))


# -- K1 / K2 / K3 / K4 ------------------------------------------------------
def accuracy(df: DataFrame, y: str = "y", pred: str = "prediction") -> DataFrame:
    return df.agg(F.avg((c(y) == c(pred)).cast("double")).alias("accuracy"))


def confusion_matrix(df: DataFrame, y: str = "y", pred: str = "prediction", labels: Sequence[int] = (0, 1)) -> DataFrame:
    """Rows true, columns predicted, zeros kept: long ``(actual, predicted, count)``."""
    counts = df.groupBy(c(y).cast("int").alias("actual"), c(pred).cast("int").alias("predicted")).count()
    grid = df.sparkSession.createDataFrame([(a, b) for a in labels for b in labels], "actual int, predicted int")
    # pairs outside of the grid (other labels, NULLs) get rows of their own, so
    # that the counts add up to the input
    return grid.select("actual", "predicted", F.lit(0).cast("long").alias("count")).unionAll(counts).groupBy(
        "actual", "predicted").agg(F.sum("count").alias("count"))


def classification_report(df: DataFrame, y: str = "y", pred: str = "prediction") -> DataFrame:
    """precision, recall, f1, support per class, accuracy, macro and weighted
    means (0 on zero division), computed from counts in one pass.  Rows with a
    NULL or another label count in the support and as mistakes."""
    # null-safe: a NULL or another label on one side still counts on the other
    def count(cond, name):
        return F.sum(F.coalesce(cond, F.lit(False)).cast("long")).alias(name)

    row = df.agg(
        count((c(y) == 1) & (c(pred) == 1), "tp"), count((c(y) == 0) & (c(pred) == 0), "tn"),
        count((c(pred) == 1) & ~c(y).eqNullSafe(1), "fp1"), count((c(y) == 1) & ~c(pred).eqNullSafe(1), "fn1"),
        count((c(pred) == 0) & ~c(y).eqNullSafe(0), "fp0"), count((c(y) == 0) & ~c(pred).eqNullSafe(0), "fn0"),
        F.count(F.lit(1)).alias("n"),
    )
    tp, tn, fp1, fn1, fp0, fn0, n = (F.coalesce(F.col(x), F.lit(0)).cast("double") for x in ("tp", "tn", "fp1", "fn1", "fp0", "fn0", "n"))

    def cls(tp_, fp_, fn_):
        prec = safe_div(tp_, tp_ + fp_)
        rec = safe_div(tp_, tp_ + fn_)
        f1 = safe_div(2 * tp_, 2 * tp_ + fp_ + fn_)
        return prec, rec, f1, tp_ + fn_

    p1, r1, f1_1, s1 = cls(tp, fp1, fn1)
    p0, r0, f1_0, s0 = cls(tn, fp0, fn0)
    acc = safe_div(tp + tn, n)
    stats = row.select(
        p0.alias("p0"), r0.alias("r0"), f1_0.alias("f0"), s0.alias("s0"),
        p1.alias("p1"), r1.alias("r1"), f1_1.alias("f1"), s1.alias("s1"), acc.alias("acc"), n.alias("n"),
    )
    g = F.col
    wavg = lambda a, b: safe_div(a * g("s0") + b * g("s1"), g("s0") + g("s1"))
    def entry(label, prec, rec, f1, support):
        return F.struct(F.lit(label).alias("label"), prec.cast("double").alias("precision"),
                        rec.cast("double").alias("recall"), f1.cast("double").alias("f1_score"),
                        support.alias("support"))

    none = F.lit(None).cast("double")
    entries = F.array(
        entry("0", g("p0"), g("r0"), g("f0"), g("s0")),
        entry("1", g("p1"), g("r1"), g("f1"), g("s1")),
        entry("accuracy", none, none, g("acc"), g("n")),
        entry("macro avg", (g("p0") + g("p1")) / 2, (g("r0") + g("r1")) / 2, (g("f0") + g("f1")) / 2,
              g("n")),
        entry("weighted avg", wavg(g("p0"), g("p1")), wavg(g("r0"), g("r1")), wavg(g("f0"), g("f1")),
              g("n")),
    )
    return stats.select(F.explode(entries).alias("e")).select(
        "e.label", "e.precision", "e.recall", "e.f1_score", F.col("e.support").cast("long").alias("support")
    )


def wrong_predictions(df: DataFrame, y: str = "y", pred: str = "prediction") -> DataFrame:
    """Mistaken rows with ``true_labels`` and ``predicted_labels``."""
    return filter_mask(df, c(y) != c(pred)).withColumn("true_labels", c(y)).withColumn("predicted_labels", c(pred))


# -- K6 ---------------------------------------------------------------------
def roc_auc(df: DataFrame, y: str = "y", score: str = "p") -> float:
    """Area under the ROC curve, tied scores counted half.

    Rows collapse to one per distinct score (map-side combined), then each
    score's positives are credited with the negatives ranked below it via an
    exact prefix sum over the range-partitioned distinct scores.
    """
    per_score = df.groupBy(c(score).alias("s")).agg(
        F.sum((c(y) == 1).cast("double")).alias("pos"), F.sum((c(y) != 1).cast("double")).alias("neg")
    )
    ranked = with_prefix_sums(per_score, [F.col("s").asc()], ["neg"])
    row = ranked.agg(
        F.sum(F.col("pos") * (F.col("neg_before") + 0.5 * F.col("neg"))).alias("num"),
        F.sum("pos").alias("P"),
        F.sum("neg").alias("N"),
    ).first()
    if not row["P"] or not row["N"]:
        return float("nan")
    return float(row["num"] / (row["P"] * row["N"]))


def roc_auc_table(df: DataFrame, y: str, scores: Sequence[str]) -> DataFrame:
    rows = [(s, roc_auc(df, y, s)) for s in scores]
    return df.sparkSession.createDataFrame(rows, "score string, auc double")


# -- K8 ---------------------------------------------------------------------
def threshold_search(df: DataFrame, candidates: Sequence[float], y: str = "y", p: str = "p",
                     fold: str = "fold", strict: bool = False) -> DataFrame:
    """Mean over folds of the accuracy at each candidate threshold.

    Fold models do not depend on the threshold, so out-of-fold scores are made
    once and every cut is evaluated from them.  Rows collapse to class counts per
    fold and score; the cuts are merged into the sorted scores, and the prefix
    sums at a cut are the rows of each class that it labels 0.  A row's cost does
    not depend on the number of cuts.  NULL scores are labelled 0, NaN 1.
    """
    spark = df.sparkSession
    counts = df.groupBy(c(fold).cast("int").alias("fold"), c(p).cast("double").alias("s")).agg(
        F.sum((c(y) == 1).cast("long")).alias("pos"), F.sum((c(y) != 1).cast("long")).alias("neg"))
    counts = counts.select("fold", "s", F.lit(1).alias("kind"), "pos", "neg")
    folds = [(r["fold"], r["pos"] or 0, r["neg"] or 0) for r in counts.groupBy("fold").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).collect()]  # one row a fold
    folds.sort(key=lambda r: (r[0] is not None, r[0] or 0))
    # an inclusive cut (p >= t) lies before the scores that equal it, a strict one behind
    place, cuts, totals, lower = 2 if strict else 0, sorted({float(t) for t in candidates}), [], (0, 0)
    for f, pos, neg in folds:
        totals.append((f, pos, pos + neg, *lower))
        lower = (lower[0] + pos, lower[1] + neg)
    marks = spark.createDataFrame([(f, t, place, 0, 0) for f, _, _ in folds for t in cuts], "fold int, s double, kind int, pos long, neg long")
    both = with_prefix_sums(counts.unionAll(marks), [F.col(x).asc() for x in ("fold", "s", "kind")], ["pos", "neg"])
    total = spark.createDataFrame(totals, "f int, P long, n long, pos_lower long, neg_lower long")
    at = both.where(F.col("kind") == place).join(F.broadcast(total), F.col("fold").eqNullSafe(F.col("f")))
    right = F.col("P") - (F.col("pos_before") - F.col("pos_lower")) + F.col("neg_before") - F.col("neg_lower")
    return at.groupBy(F.col("s").alias("threshold")).agg(F.avg(right / F.col("n")).alias("accuracy"))


# -- L3 ---------------------------------------------------------------------
def best_trial(trials: DataFrame, params: str, score: str = "accuracy") -> DataFrame:
    """The trial of highest score (lowest loss); ties to the smallest params."""
    return trials.agg(
        F.min_by(c(params), F.struct((-c(score)).alias("s"), c(params).alias("p"))).alias(params),
        F.max(c(score)).alias(score),
    )
