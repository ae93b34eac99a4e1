"""Missing data and survey non-responses (0 = no answer)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabinlens import schema as S
from cabinlens.functions.exprs import c, q, sql_literal


# -- B1 ---------------------------------------------------------------------
def fill_from(df: DataFrame, target: str = "Arrival_Delay_in_Minutes",
              source: str = "Departure_Delay_in_Minutes") -> DataFrame:
    """NULL in ``target`` takes the value of ``source`` in the same row."""
    dtype = dict(df.dtypes)[target]
    return df.withColumn(target, F.coalesce(c(target), c(source).cast(dtype)))


# -- B2 / G12 ---------------------------------------------------------------
def mode_values(df: DataFrame, cols: Sequence[str]) -> dict[str, object]:
    """Most frequent non-NULL value per column, the lowest on ties (one pass)."""
    from cabinlens.functions.stats import modes

    return modes(df, cols)


@dataclass
class FillMode:
    """NULL takes the mode fitted on the train frame."""

    values: dict[str, object]

    @classmethod
    def fit(cls, train: DataFrame, cols: Sequence[str]) -> "FillMode":
        return cls(mode_values(train, cols))

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {x: F.coalesce(c(x), F.lit(v).cast(dict(df.dtypes)[x])) for x, v in self.values.items()}
        )


# -- B3 ---------------------------------------------------------------------
def null_counts(df: DataFrame) -> DataFrame:
    """``(column, nulls, total_nulls)``: one aggregation pass, then unpivot."""
    cols = df.columns
    counts = df.agg(*[F.expr(f"count(1) - count({q(x)})").alias(f"n{i}") for i, x in enumerate(cols)])
    total = " + ".join(f"n{i}" for i in range(len(cols)))
    pairs = ", ".join(f"{sql_literal(x)}, n{i}" for i, x in enumerate(cols))
    return counts.selectExpr(f"stack({len(cols)}, {pairs}) AS (column, nulls)", f"CAST({total} AS BIGINT) AS total_nulls")


# -- B4 ---------------------------------------------------------------------
@dataclass
class ImputeStat:
    """Replace the missing marker by a train statistic that **includes** it."""

    values: dict[str, float]
    missing: float = 0

    @classmethod
    def fit(cls, train: DataFrame, cols: Sequence[str], strategy: str = "mode", missing: float = 0) -> "ImputeStat":
        from cabinlens.functions.stats import modes, quantiles

        if strategy == "mean":
            row = train.agg(*[F.avg(c(x)).alias(f"s{i}") for i, x in enumerate(cols)]).first()
            values = {x: row[f"s{i}"] for i, x in enumerate(cols)}
        elif strategy == "median":
            values = {x: v[0] for x, v in quantiles(train, cols, [0.5]).items()}
        elif strategy == "mode":
            values = modes(train, cols)
        else:
            raise ValueError(f"Unknown strategy: {strategy}")
        return cls({x: float(v) for x, v in values.items()}, missing)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                x: F.when(c(x) == F.lit(self.missing), F.lit(v)).otherwise(c(x).cast("double"))
                for x, v in self.values.items()
            }
        )


# -- B5 ---------------------------------------------------------------------
def impute_group_mean(df: DataFrame, groups: dict[str, Sequence[str]] | None = None,
                      ignore_zero_peers: bool = False) -> DataFrame:
    """A 0 takes the mean of the other columns of its group in the same row.

    Columns are filled in listed order, so later columns see earlier fills.
    Peers that are 0 count as 0 (``ignore_zero_peers`` skips them instead);
    a row whose peers are all NULL takes the column mode of the frame.
    Row-wise expressions plus one aggregation for the modes: no shuffle.
    """
    groups = groups or S.GROUPS
    cols = [x for feats in groups.values() for x in feats]
    modes = mode_values(df, cols)
    out = df.withColumns({x: F.expr(f"CAST({q(x)} AS DOUBLE)") for x in cols})
    for feats in groups.values():
        for x in feats:
            peers = [p for p in feats if p != x]
            usable = [f"CASE WHEN {q(p)} <> 0 THEN {q(p)} END" if ignore_zero_peers else q(p) for p in peers]
            total = " + ".join(f"COALESCE({u}, 0D)" for u in usable) or "0D"
            count = " + ".join(f"CASE WHEN {u} IS NULL THEN 0 ELSE 1 END" for u in usable) or "0"
            fallback = f"CAST({sql_literal(modes[x])} AS DOUBLE)"
            fill = f"COALESCE(CASE WHEN ({count}) > 0 THEN ({total}) / ({count}) END, {fallback})"
            out = out.withColumn(x, F.expr(f"CASE WHEN {q(x)} = 0 THEN {fill} ELSE {q(x)} END"))
    return out


# -- B7 ---------------------------------------------------------------------
def handle_nonresponse(train: DataFrame, test: DataFrame, strategy: str = "none",
                       cols: Sequence[str] | None = None, k: int = 5) -> tuple[DataFrame, DataFrame]:
    """Dispatch: ``knn`` / ``group`` / ``mode``; anything else leaves both frames."""
    cols = list(cols or S.SURVEY)
    if strategy == "knn":
        from cabinlens.operators.knn import KnnImputer

        model = KnnImputer.fit(train, cols, k=k)
        return model.transform(train), model.transform(test)
    if strategy == "group":
        return impute_group_mean(train), impute_group_mean(test)
    if strategy == "mode":
        model = ImputeStat.fit(train, cols, "mode")
        return model.transform(train), model.transform(test)
    return train, test
