"""Exact quantiles and modes of several columns, for any cardinality: both are
read from one :class:`~cabinlens.functions.value_table.ValueTable`, so the frame
is scanned once and no task holds a column's distinct values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabinlens.functions.exprs import q
from cabinlens.functions.value_table import ValueTable


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], approx: bool = False) -> dict[str, list]:
    """Exact (linear) quantiles per column; ``approx`` uses ``percentile_approx``."""
    cols = list(cols)
    if not approx:
        return ValueTable.of(df, cols).quantiles(probs) if cols else {}
    arr = "array(" + ", ".join(f"{float(p)!r}D" for p in probs) + ")"
    row = df.agg(*[F.expr(f"percentile_approx(CAST({q(x)} AS DOUBLE), {arr}, 10000)").alias(f"q{i}")
                   for i, x in enumerate(cols)]).first()
    return {x: list(row[f"q{i}"] or [None] * len(probs)) for i, x in enumerate(cols)}


def modes(df: DataFrame, cols: Sequence[str]) -> dict[str, object]:
    """Most frequent non-NULL value per column in its own type, the lowest on ties."""
    return ValueTable.of(df, cols).modes() if cols else {}
