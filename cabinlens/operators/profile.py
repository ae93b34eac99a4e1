"""Column profiles, train/test drift tables and the data behind the plots.

Per-column statistics are computed in one wide aggregation (one pass, partial
aggregation on the map side) and reshaped afterwards; per-value statistics
unpivot first and aggregate by ``(feature, value)``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabinlens.functions.exprs import c, q, sql_literal


def _long(row_df: DataFrame, names: Sequence[str], fields: dict[str, str]) -> DataFrame:
    """Reshape one wide row ``<field>__<i>`` into one row per column name
    (one ``inline`` generator, built as SQL text)."""
    structs = ", ".join(
        "named_struct('column', " + sql_literal(x) + ", "
        + ", ".join(f"'{f}', CAST({q(f'{f}__{i}')} AS {t})" for f, t in fields.items()) + ")"
        for i, x in enumerate(names)
    )
    return row_df.selectExpr(f"inline(array({structs}))")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


# -- G1 ---------------------------------------------------------------------
def table_info(df: DataFrame) -> DataFrame:
    """``(position, column, type, non_null)``."""
    cols = df.columns
    counts = df.agg(*[F.expr(f"count({q(x)})").alias(f"non_null__{i}") for i, x in enumerate(cols)])
    out = _long(counts, cols, {"non_null": "long"})
    types = df.sparkSession.createDataFrame(
        [(i, x, t) for i, (x, t) in enumerate(df.dtypes)], "position int, column string, type string"
    )
    return types.join(out, "column").select("position", "column", "type", "non_null")


# -- G2 / G5 ----------------------------------------------------------------
def _named(df: DataFrame, cols: Sequence[str], key: str = "k", name: str = "column") -> DataFrame:
    """``df`` with one row for each of ``cols``, by their number (bounded by the columns)."""
    names = df.sparkSession.createDataFrame([(i, x) for i, x in enumerate(cols)], f"`__k` int, `{name}` string")
    return F.broadcast(names).join(df, F.col("__k") == F.col(key), "left").drop("__k", key)


def _stats(df: DataFrame, cols: Sequence[str], approx: bool) -> DataFrame:
    """(column, count, moments, quartiles) from one pass over ``df``."""
    from cabinlens.functions.stats import quantiles
    from cabinlens.functions.value_table import ValueTable

    values = ValueTable.of(df, cols)
    points = quantiles(df, cols, QUARTILES, approx=True) if approx else values.quantiles(QUARTILES)
    rows = [(x, *points[x]) for x in cols]
    table = df.sparkSession.createDataFrame(rows, "column string, q25 double, q50 double, q75 double")
    return _named(values.moments(), cols).join(F.broadcast(table), "column").withColumn("count", F.coalesce("count", F.lit(0)))


QUARTILES = [0.25, 0.5, 0.75]


def describe(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """count, mean, sample std, min, 25/50/75 % (linear), max per numeric column."""
    cols = list(cols or numeric_columns(df))
    return _stats(df, cols, approx).select("column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def numeric_profile(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """mean, median, sample std, min, max, quartiles, IQR and the bias-corrected
    skewness and excess kurtosis (the sample estimators G1 and G2)."""
    out = _stats(df, list(cols), approx)
    n = F.col("count").cast("double")
    skew = F.when(n > 2, F.col("g1") * F.sqrt(n * (n - 1)) / (n - 2))
    kurt = F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.col("g2") + 6))
    return out.select(
        "column", "mean", F.col("q50").alias("median"), "std", "min", "max", "q25", "q75",
        (F.col("q75") - F.col("q25")).alias("iqr"), skew.alias("skewness"), kurt.alias("kurtosis"),
    )


# -- G3 ---------------------------------------------------------------------
def value_counts(df: DataFrame, col: str, normalize: bool = False) -> DataFrame:
    """Frequency (or share) of each non-NULL value."""
    counts = df.where(c(col).isNotNull()).groupBy(c(col).alias("value")).agg(F.count("*").alias("count"))
    if not normalize:
        return counts
    total = df.where(c(col).isNotNull()).count()
    return counts.select("value", (F.col("count") / F.lit(float(total) or 1.0)).alias("share"))


# -- G4 ---------------------------------------------------------------------
def _unpivot(df: DataFrame, cols: Sequence[str], value_type: str = "double", extra: Sequence[str] = ()) -> DataFrame:
    """Long form ``(feature, value)``: one ``stack`` generator per row, no join."""
    pairs = ", ".join(f"{sql_literal(x)}, CAST({q(x)} AS {value_type})" for x in cols)
    return df.selectExpr(*[q(x) for x in extra], f"stack({len(cols)}, {pairs}) AS (feature, value)")


def survey_report(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(counts per column and answer, and mean/median/mode per column), all from
    one value table."""
    from cabinlens.functions.value_table import ValueTable

    cols = list(cols)
    values = ValueTable.of(df, cols)
    counts = _named(values.numbers(), cols).where("value IS NOT NULL").select("column", F.col("value").cast("int").alias("value"), F.col("n").alias("count"))
    middle, most = values.quantiles([0.5]), values.modes()
    rows = [(x, middle[x][0], None if most[x] is None else int(most[x])) for x in cols]
    points = df.sparkSession.createDataFrame(rows, "column string, median double, mode int")
    means = _named(values.moments(), cols).select("column", F.round("mean", 2).alias("mean"))
    return counts, means.join(F.broadcast(points), "column")


# -- G6 ---------------------------------------------------------------------
def compare_moments(train: DataFrame, test: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per feature, for both sides: mean, sample std, biased skewness and excess
    kurtosis.  A NULL in the column makes that side's skew/kurtosis NULL."""
    from cabinlens.functions.value_table import ValueTable

    cols = list(cols or numeric_columns(train))

    def side(df: DataFrame, tag: str) -> DataFrame:
        values = ValueTable.of(df, cols)
        # NaN counts as a number, NULL does not
        nulls = values.table.where("l IS NULL AND d IS NULL AND s IS NULL").select(F.col("k").alias("nk"))
        m = values.moments().join(F.broadcast(nulls), F.col("k") == F.col("nk"), "left")
        whole = F.col("nk").isNull()
        m = m.select("k", F.col("mean").alias(f"{tag}_mean"), F.col("std").alias(f"{tag}_std"),
                     F.when(whole, F.col("g1")).alias(f"{tag}_skew"), F.when(whole, F.col("g2")).alias(f"{tag}_kurt"))
        return _named(m, cols)

    return side(train, "train").join(F.broadcast(side(test, "test")), "column")


# -- G7 / F3 ----------------------------------------------------------------
def value_shares(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(feature, value, share)`` among non-NULL values of each feature."""
    from cabinlens.functions.value_table import ValueTable

    counts = ValueTable.of(df, list(cols)).numbers()
    totals = counts.groupBy(F.col("k").alias("tk")).agg(F.sum("n").alias("total"))  # one row per feature
    shares = counts.join(F.broadcast(totals), F.col("k") == F.col("tk"))
    return _named(shares.select("k", "value", (F.col("n") / F.col("total")).alias("share")), list(cols), name="feature").where("share IS NOT NULL")


def inner_on_value(a: DataFrame, b: DataFrame, suffixes=("_a", "_b")) -> DataFrame:
    """Align two share tables on ``(feature, value)``; one-sided values drop out."""
    return a.withColumnRenamed("share", f"share{suffixes[0]}").join(
        b.withColumnRenamed("share", f"share{suffixes[1]}"), ["feature", "value"], "inner"
    )


def stability_index(train: DataFrame, test: DataFrame, cols: Sequence[str] | None = None,
                    outer: bool = False) -> DataFrame:
    """Per feature: sum over shared values of (p_train - p_test)^2, divided by
    the train row count.  ``outer=True`` also counts one-sided values.

    Each side is scanned once into its value table; the tables' counts meet in
    one ``groupBy(feature, value)``.
    """
    from cabinlens.functions.value_table import ValueTable

    cols = list(cols or numeric_columns(train))
    own, other = ValueTable.of(train, cols), ValueTable.of(test, cols)
    n_train = own.table.where("k = 0").agg(F.sum("n")).first()[0] or 0
    zero = F.lit(0).cast("long")
    both = own.numbers().select("k", "value", F.col("n").alias("a"), zero.alias("b")).unionAll(
        other.numbers().select("k", "value", zero, "n"))
    counts = both.groupBy("k", "value").agg(F.sum("a").alias("na"), F.sum("b").alias("nb"))
    totals = counts.groupBy(F.col("k").alias("tk")).agg(F.sum("na").alias("ta"), F.sum("nb").alias("tb"))  # one row per feature
    shares = counts.join(F.broadcast(totals), F.col("k") == F.col("tk")).select(
        "k", "na", "nb", F.try_divide(F.col("na"), F.col("ta")).alias("pa"), F.try_divide(F.col("nb"), F.col("tb")).alias("pb"))
    if not outer:
        shares = shares.where((F.col("na") > 0) & (F.col("nb") > 0))
    sq = (F.coalesce(F.col("pa"), F.lit(0.0)) - F.coalesce(F.col("pb"), F.lit(0.0))) ** 2
    found = shares.groupBy("k").agg(F.sum(sq).alias("ss"))
    return _named(found, cols, name="feature").select(
        "feature", F.try_divide(F.coalesce(F.col("ss"), F.lit(0.0)), F.lit(float(n_train))).alias("stability_index"))


# -- G8 ---------------------------------------------------------------------
def correlation_matrix(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of all pairs, pairwise-complete, long ``(a, b, r)``.

    One pass for column means, then each task folds its rows into the
    co-moment matrices of the mean-shifted data (numpy over Arrow batches) and
    emits p^2 partial rows; a final ``groupBy(a, b)`` adds them up.
    """
    cols = list(cols or numeric_columns(df))
    p = len(cols)
    means_row = df.agg(*[F.avg(c(x).cast("double")).alias(f"m{i}") for i, x in enumerate(cols)]).first()
    shift = np.array([means_row[f"m{i}"] or 0.0 for i in range(p)], dtype="float64")
    narrow = df.selectExpr(*[f"CAST({q(x)} AS DOUBLE) AS x{i}" for i, x in enumerate(cols)])
    names = [f"x{i}" for i in range(p)]

    def partial(batches):
        n = np.zeros((p, p))
        sa = np.zeros((p, p))
        saa = np.zeros((p, p))
        sab = np.zeros((p, p))
        seen = False
        for pdf in batches:
            x = pdf[names].to_numpy(dtype="float64", na_value=np.nan) - shift
            m = (~np.isnan(x)).astype("float64")
            x0 = np.nan_to_num(x, nan=0.0)
            n += m.T @ m
            sa += x0.T @ m           # sum of a over rows where b is present
            saa += (x0 * x0).T @ m
            sab += x0.T @ x0
            seen = True
        if not seen:
            return
        ia, ib = np.meshgrid(np.arange(p), np.arange(p), indexing="ij")
        yield pd.DataFrame({
            "a": ia.ravel().astype("int32"), "b": ib.ravel().astype("int32"),
            "n": n.ravel(), "sa": sa.ravel(), "sb": sa.T.ravel(),
            "saa": saa.ravel(), "sbb": saa.T.ravel(), "sab": sab.ravel(),
        })

    schema = "a int, b int, n double, sa double, sb double, saa double, sbb double, sab double"
    parts = narrow.mapInPandas(partial, schema)
    sums = parts.groupBy("a", "b").agg(*[F.sum(k).alias(k) for k in ("n", "sa", "sb", "saa", "sbb", "sab")])
    n = F.col("n")
    cov = F.col("sab") - F.col("sa") * F.col("sb") / n
    va = F.col("saa") - F.col("sa") * F.col("sa") / n
    vb = F.col("sbb") - F.col("sb") * F.col("sb") / n
    r = F.when((n > 1) & (va > 0) & (vb > 0), cov / F.sqrt(va * vb))
    lookup = df.sparkSession.createDataFrame([(i, x) for i, x in enumerate(cols)], "i int, name string")
    named = sums.select("a", "b", r.alias("r"))
    # name lookups have one row per feature (p rows): bounded broadcasts
    la = F.broadcast(lookup.withColumnRenamed("i", "a").withColumnRenamed("name", "feature_a"))
    lb = F.broadcast(lookup.withColumnRenamed("i", "b").withColumnRenamed("name", "feature_b"))
    return named.join(la, "a").join(lb, "b").select("feature_a", "feature_b", "r")


# -- G9 ---------------------------------------------------------------------
def crosstab_by_target(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Counts per ``(feature, value, target)``: the data behind the count plots."""
    long = _unpivot(df, features, "string", extra=[target]).where(F.col("value").isNotNull())
    return long.groupBy("feature", "value", c(target).alias(target)).agg(F.count("*").alias("count"))


# -- G10 --------------------------------------------------------------------
def density_table(train: DataFrame, test: DataFrame, feature: str, gridsize: int = 200,
                  cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density on a grid for both sides (Scott's bandwidth
    n^(-1/5) * sample std, grid from min - 3 bw to max + 3 bw).  A side without
    spread (constant, one row, none) is one row, its value with a NULL density.

    Values are pre-aggregated to ``(value, count)``; each task adds its values'
    kernels into the grid with numpy and emits ``gridsize`` partial rows, so
    no row is paired with the grid in Spark.
    """
    frames = []
    for side, df in (("train", train), ("test", test)):
        col = c(feature).cast("double")
        st = df.agg(F.count(col).alias("n"), F.stddev_samp(col).alias("sd"),
                    F.min(col).alias("lo"), F.max(col).alias("hi")).first()
        n = st["n"]
        if not n or not st["sd"]:  # no spread, no bandwidth: the value with a NULL density
            frames.append(df.sparkSession.createDataFrame([(side, 0, st["lo"], None)], "side string, i int, x double, density double"))
            continue
        bw = n ** (-1.0 / 5.0) * st["sd"]
        grid = np.linspace(st["lo"] - cut * bw, st["hi"] + cut * bw, gridsize)
        values = df.where(col.isNotNull()).groupBy(col.alias("v")).agg(F.count("*").cast("double").alias("w"))

        def kernel_sums(batches, grid=grid, bw=bw):
            acc = np.zeros(len(grid))
            for pdf in batches:
                v = pdf["v"].to_numpy()
                w = pdf["w"].to_numpy()
                for start in range(0, len(v), 4096):
                    z = (grid[None, :] - v[start:start + 4096, None]) / bw
                    acc += (w[start:start + 4096, None] * np.exp(-0.5 * z * z)).sum(axis=0)
            yield pd.DataFrame({"i": np.arange(len(grid), dtype="int32"), "s": acc})

        sums = values.mapInPandas(kernel_sums, "i int, s double").groupBy("i").agg(F.sum("s").alias("s"))
        norm = 1.0 / (n * bw * math.sqrt(2 * math.pi))
        pts = df.sparkSession.createDataFrame([(i, float(g)) for i, g in enumerate(grid)], "i int, x double")
        frames.append(
            pts.join(sums, "i").select(F.lit(side).alias("side"), "i", "x", (F.col("s") * F.lit(norm)).alias("density"))
        )
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# -- G11 / G12 --------------------------------------------------------------
def distinct_count(df: DataFrame, col: str, approx: bool = False) -> int:
    """Distinct values, NULL counted as one value."""
    if not approx:
        return distinct_counts(df, [col]).first()["distinct"]
    row = df.agg(F.approx_count_distinct(c(col)).alias("d"), F.max(c(col).isNull().cast("int")).alias("z")).first()
    return int(row["d"]) + int(row["z"] or 0)


def distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, distinct), NULL being one value; 0 for a table without rows."""
    from cabinlens.functions.value_table import ValueTable

    found = ValueTable.of(df, cols).distinct()
    return _named(found, cols).select("column", F.coalesce("distinct", F.lit(0)).alias("distinct"))


def modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Most frequent non-NULL value per column (lowest on ties), as double."""
    from cabinlens.functions.stats import modes as mode_of

    found = mode_of(df, cols)
    rows = [(x, None if found[x] is None else float(found[x])) for x in cols]
    return df.sparkSession.createDataFrame(rows, "column string, mode double")
