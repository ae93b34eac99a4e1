"""Column-expression helpers (all JVM-side built-ins, no UDFs)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def c(name: str) -> Column:
    """Column by exact name; names may hold spaces, ``/``, ``-``, ``^``."""
    return F.col("`" + name.replace("`", "``") + "`")


def q(name: str) -> str:
    """Back-quoted identifier for SQL expression text."""
    return "`" + name.replace("`", "``") + "`"


def sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, int):
        return repr(v)
    if isinstance(v, float):
        return f"{v!r}D" if v == v and abs(v) != float("inf") else f"CAST('{v!r}' AS DOUBLE)"
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def round6(col: Column) -> Column:
    return F.round(col, 6)


def portable_hash(key: Column, seed: int | str) -> Column:
    """First 32 bits of md5("<key>-<seed>") as a non-negative bigint.

    Identical in DuckDB: ``CAST('0x'||substr(md5(concat(id,'-',seed)),1,8) AS BIGINT)``.
    Stable under repartitioning and re-execution (unlike ``rand``/``randomSplit``).
    """
    text = F.concat(key.cast("string"), F.lit("-"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def unit_hash(key: Column, seed: int | str) -> Column:
    """``portable_hash`` scaled into [0, 1)."""
    return portable_hash(key, seed) / F.lit(float(2**32))


def _edge(v: float) -> Column:
    return F.lit(float(v))


def _edge_text(v: float) -> str:
    v = float(v)
    if v == float("inf"):
        return "CAST('Infinity' AS DOUBLE)"
    if v == float("-inf"):
        return "CAST('-Infinity' AS DOUBLE)"
    return f"{v!r}D"


def cut_text(col: str, edges: Sequence[float], labels: Sequence[str], right: bool = True,
             include_lowest: bool = False) -> str:
    """SQL text of ``cut`` over the SQL expression ``col``."""
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per interval")
    whens = []
    for i, label in enumerate(labels):
        lo, hi = _edge_text(edges[i]), _edge_text(edges[i + 1])
        if right:
            lop = ">=" if (include_lowest and i == 0) else ">"
            cond = f"{col} {lop} {lo} AND {col} <= {hi}"
        else:
            hop = "<=" if (include_lowest and i == len(labels) - 1) else "<"
            cond = f"{col} >= {lo} AND {col} {hop} {hi}"
        whens.append(f"WHEN {cond} THEN {sql_literal(label)}")
    return "CASE " + " ".join(whens) + " END"


def cut(col: Column | str, edges: Sequence[float], labels: Sequence[str], right: bool = True,
        include_lowest: bool = False) -> Column:
    """Interval labels like ``pandas.cut``: ``(a,b]`` (``right``) or ``[a,b)``.

    Values outside all intervals (and NULL) give NULL; edges may be infinite.
    A CASE chain over literals, so it stays inside whole-stage codegen.
    ``col`` is a column name (built as SQL text) or a Column.
    """
    if isinstance(col, str):
        return F.expr(cut_text(q(col), edges, labels, right, include_lowest))
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per interval")
    expr = None
    for i, label in enumerate(labels):
        lo, hi = _edge(edges[i]), _edge(edges[i + 1])
        if right:
            low_ok = (col >= lo) if (include_lowest and i == 0) else (col > lo)
            cond = low_ok & (col <= hi)
        else:
            high_ok = (col <= hi) if (include_lowest and i == len(labels) - 1) else (col < hi)
            cond = (col >= lo) & high_ok
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def safe_div(num: Column, den: Column, zero: float | None = 0.0) -> Column:
    """Division that yields ``zero`` (or NULL) instead of failing under ANSI mode."""
    out = F.when(den == 0, F.lit(zero)).otherwise(num / den)
    return out
