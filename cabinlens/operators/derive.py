"""Numeric and string derivations: projections plus small fitted statistics."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabinlens import schema as S
from cabinlens.functions.exprs import c, cut as cut_expr


# -- D1 ---------------------------------------------------------------------
@dataclass
class StandardScale:
    """(x - mean) / population std; a zero std divides by 1."""

    stats: dict[str, tuple[float, float]]

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str]) -> "StandardScale":
        aggs = []
        for i, x in enumerate(cols):
            aggs += [F.avg(c(x)).alias(f"m{i}"), F.stddev_pop(c(x)).alias(f"s{i}")]
        row = df.agg(*aggs).first()
        stats = {}
        for i, x in enumerate(cols):
            sd = row[f"s{i}"]
            stats[x] = (row[f"m{i}"], 1.0 if (sd is None or sd == 0) else sd)
        return cls(stats)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({x: (c(x) - F.lit(m)) / F.lit(s) for x, (m, s) in self.stats.items()})


def standard_scale(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    return StandardScale.fit(fit_on if fit_on is not None else df, cols).transform(df)


# -- D2 / D3 ----------------------------------------------------------------
def log1p(df: DataFrame, cols: Sequence[str], suffix: str = "") -> DataFrame:
    return df.withColumns({f"{x}{suffix}": F.log1p(c(x)) for x in cols})


def sqrt(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    return df.withColumn(name or f"{col}_sqrt", F.sqrt(c(col)))


# -- D4 ---------------------------------------------------------------------
def polynomial(df: DataFrame, cols: Sequence[str], degree: int = 2) -> DataFrame:
    """``x`` becomes double and ``x^2`` (.. ``x^degree``) is added; no cross terms."""
    exprs = {}
    for x in cols:
        base = c(x).cast("double")
        exprs[x] = base
        power = base
        for d in range(2, degree + 1):
            power = power * base
            exprs[f"{x}^{d}"] = power
    return df.withColumns(exprs)


# -- D5 ---------------------------------------------------------------------
def cut(df: DataFrame, col: str, edges: Sequence[float], labels: Sequence[str], name: str | None = None,
        right: bool = True, include_lowest: bool = False) -> DataFrame:
    return df.withColumn(name or col, cut_expr(col, edges, labels, right, include_lowest))


# -- D6 ---------------------------------------------------------------------
def _round_frac(x: float, precision: int) -> float:
    if not np.isfinite(x) or x == 0:
        return x
    frac, whole = math.modf(x)
    digits = (-int(math.floor(math.log10(abs(frac)))) - 1 + precision) if whole == 0 else precision
    return float(np.around(x, digits))


def interval_labels(edges: Sequence[float], precision: int = 3) -> list[str]:
    """Right-closed interval labels with the lowest edge lowered by 10^-precision."""
    for p in range(precision, 20):
        if len({_round_frac(b, p) for b in edges}) == len(edges):
            precision = p
            break
    shown = [_round_frac(b, precision) for b in edges]
    shown[0] = shown[0] - 10 ** (-precision)
    return [f"({repr(float(a))}, {repr(float(b))}]" for a, b in zip(shown[:-1], shown[1:])]


@dataclass
class QuantileBins:
    """Equal-frequency bins with exact (linear) quantile edges."""

    edges: dict[str, list[float]]

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str], q: int = 4) -> "QuantileBins":
        from cabinlens.functions.stats import quantiles

        probs = [i / q for i in range(q + 1)]
        found = quantiles(df, cols, probs)
        edges = {}
        for x in cols:
            e = [float(v) for v in found[x]]
            if len(set(e)) != len(e):
                raise ValueError(f"bin edges of {x} are not unique: {e}")
            edges[x] = e
        return cls(edges)

    def labels(self, col: str) -> list[str]:
        return interval_labels(self.edges[col])

    def expr(self, col: str):
        return cut_expr(col, self.edges[col], self.labels(col), right=True, include_lowest=True)

    def transform(self, df: DataFrame, suffix: str = "_qbin") -> DataFrame:
        return df.withColumns({f"{x}{suffix}": self.expr(x) for x in self.edges})


# -- D7 / D8 / D9 / D10 -----------------------------------------------------
def multiply(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """``<a>_x_<b>`` for each pair, in one projection."""
    return df.withColumns({f"{a}_x_{b}": c(a) * c(b) for a, b in pairs})


def row_sum(df: DataFrame, sums: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """Row sums (name, columns) where NULL counts as 0."""
    return df.withColumns({name: reduce(add, [F.coalesce(c(x), F.lit(0)) for x in cols]) for name, cols in sums})


def difference(df: DataFrame, gaps: Sequence[tuple[str, str, str]]) -> DataFrame:
    """``name`` = a - b for each (name, a, b)."""
    return df.withColumns({name: c(a) - c(b) for name, a, b in gaps})


def total(df: DataFrame, name: str, a: str, b: str) -> DataFrame:
    return df.withColumn(name, c(a) + c(b))


def delay_flag(df: DataFrame, name: str = "Experienced_Delay", arrival: str = "Arrival_Delay_in_Minutes",
               departure: str = "Departure_Delay_in_Minutes") -> DataFrame:
    """1 when either delay is above 0; NULL counts as not delayed."""
    flag = F.coalesce(c(arrival) > 0, F.lit(False)) | F.coalesce(c(departure) > 0, F.lit(False))
    return df.withColumn(name, flag.cast("int"))


# -- D11 --------------------------------------------------------------------
def as_text(df: DataFrame, col: str):
    """String form of a value: numbers as text, NULL as 'nan' (strings stay NULL)."""
    if dict(df.dtypes)[col] == "string":
        return c(col)
    return F.coalesce(c(col).cast("string"), F.lit("nan"))


def concat_features(df: DataFrame, name: str, parts: Sequence, sep: str = "_") -> DataFrame:
    """Join parts with ``sep``; parts are column names or Columns.  A NULL string
    part makes the result NULL (string concatenation semantics)."""
    cols = [as_text(df, p) if isinstance(p, str) else p for p in parts]
    out = cols[0]
    for x in cols[1:]:
        out = F.concat(out, F.lit(sep), x)
    return df.withColumn(name, out)


# -- D12 --------------------------------------------------------------------
def expand_selection(config: Mapping[str, object]) -> list[str]:
    """Turn a search configuration into the list of selected columns.

    Multi-way choices are expanded first-seen order; on/off keys are kept when
    true.  Order follows the configuration (choices expand in place).
    """
    out: list[str] = []
    for key, value in config.items():
        if key in S.SELECTION_CHOICES:
            continue
        if value:
            out.append(key)
    for key, choices in S.SELECTION_CHOICES.items():
        if key in config:
            for col in choices[str(config[key])]:
                if col not in out:
                    out.append(col)
    return out
