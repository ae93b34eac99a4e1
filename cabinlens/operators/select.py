"""Projection, filter, order, limit, and row/column binding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabinlens import schema as S
from cabinlens.functions.exprs import c
from cabinlens.functions.selection import row_at


# -- E1 / E2 ----------------------------------------------------------------
def keep_features(df: DataFrame, names: Sequence[str], always: Sequence[str] = (S.TARGET, S.ID)) -> DataFrame:
    """Keep listed features (missing names ignored) plus ``id`` and the target, in frame order."""
    wanted = set(names) | set(always)
    return df.select(*[c(x) for x in df.columns if x in wanted])


def drop_features(df: DataFrame, names: Sequence[str]) -> DataFrame:
    present = [x for x in names if x in df.columns]
    return df.drop(*present)


# -- E3 ---------------------------------------------------------------------
def feature_columns(df: DataFrame, sort: bool = False, exclude: Sequence[str] = (S.ID, S.TARGET)) -> list[str]:
    cols = [x for x in df.columns if x not in exclude]
    return sorted(cols) if sort else cols


def split_xy(df: DataFrame, sort: bool = False, label: str = S.TARGET, vector: bool = True,
             keep: Sequence[str] = (S.ID,)) -> tuple[DataFrame, list[str]]:
    """Features (as one ``features`` vector, or columns) and the label.

    Returns the frame ``(keep..., [label], features)`` and the feature order.
    """
    cols = feature_columns(df, sort=sort, exclude=(*keep, label))
    extra = [label] if label in df.columns else []
    if not vector:
        return df.select(*[c(x) for x in (*keep, *extra, *cols)]), cols
    safe = [f"f{i}" for i in range(len(cols))]
    renamed = df.select(*[c(x) for x in (*keep, *extra)], *[c(x).cast("double").alias(s) for x, s in zip(cols, safe)])
    assembled = VectorAssembler(inputCols=safe, outputCol="features", handleInvalid="keep").transform(renamed)
    return assembled.select(*[c(x) for x in (*keep, *extra)], "features"), cols


def with_features(df: DataFrame, cols: Sequence[str], name: str = "features") -> DataFrame:
    """All columns of ``df`` and the vector of ``cols`` beside them."""
    safe = [f"__f{i}" for i in range(len(cols))]
    wide = df.withColumns({s: c(x).cast("double") for s, x in zip(safe, cols)})
    return VectorAssembler(inputCols=safe, outputCol=name, handleInvalid="keep").transform(wide).drop(*safe)


# -- E4 ---------------------------------------------------------------------
def filter_mask(df: DataFrame, cond: Column) -> DataFrame:
    return df.where(cond)


# -- E5 ---------------------------------------------------------------------
def sort_desc(df: DataFrame, col: str, tie: str = S.ID) -> DataFrame:
    """Global descending order (range-partitioned sort), ties by ``tie``."""
    return df.orderBy(c(col).desc(), c(tie).asc())


# -- E6 ---------------------------------------------------------------------
def top_fraction(df: DataFrame, score: str, frac: float, tie: str = S.ID) -> tuple[DataFrame, DataFrame]:
    """The first ``int(n * frac)`` rows by descending score (ties by ``tie``),
    and the rest: two filters on the key of the row at the cut.  Rows that
    repeat that very key (a repeated ``tie``) all belong to the rest."""
    k = int(df.count() * frac)
    cut = row_at(df, k, score, tie) if k else None
    if cut is None:
        return (df, df.where(F.lit(False))) if k else (df.where(F.lit(False)), df)
    return df.where(cut.before()), df.where(~cut.before())


# -- E7 ---------------------------------------------------------------------
def head(df: DataFrame, n: int = 5, order: str = S.ID) -> DataFrame:
    """Preview: the first ``n`` rows by ``order`` (a top-k, not a full sort)."""
    return df.orderBy(c(order)).limit(n)


# -- F1 / F4 / F5 -----------------------------------------------------------
def attach(df: DataFrame, other: DataFrame, cols: Sequence[str], key: str = S.ID) -> DataFrame:
    """Bind columns of ``other`` to ``df`` by key (never by position)."""
    return df.join(other.select(c(key), *[c(x) for x in cols]), key, "left")


def union_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b, allowMissingColumns=True)


def minus_rows(a: DataFrame, b: DataFrame, key: str = S.ID) -> DataFrame:
    return a.join(b.select(key), key, "left_anti")
