"""DuckDB SQL for the correctness gate.

Each string starts from the ``passengers`` / ``scored`` fixture text and
states the operator's semantics directly in SQL, independently of the Spark
code.  Helpers below only assemble text.
"""

from __future__ import annotations

from collections.abc import Sequence

from cabinlens import schema as S
from cabinlens.sources.fixtures import PASSENGERS_SQL, SCORED_SQL


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def r6(expr: str) -> str:
    # "+ 0.0" turns a rounded -0.0 into 0.0
    return f"(ROUND(CAST({expr} AS DOUBLE), 6) + 0.0)"


NORMALIZED = ",\n  ".join(f"{q(x)} AS {q(S.normalize_name(x))}" for x in S.RAW_COLUMNS)

def base(*ctes: str) -> str:
    """``WITH passengers AS (...), norm, prep, train, test`` plus extra CTEs."""
    parts = [
        f"passengers AS (\n{PASSENGERS_SQL}\n)",
        f"norm AS (SELECT\n  {NORMALIZED}\nFROM passengers)",
        "prep AS (SELECT * REPLACE (COALESCE(Arrival_Delay_in_Minutes, CAST(Departure_Delay_in_Minutes AS DOUBLE))"
        " AS Arrival_Delay_in_Minutes, CASE Satisfaction_Rating WHEN 'Neutral / Dissatisfied' THEN 0"
        " WHEN 'Satisfied' THEN 1 END AS Satisfaction_Rating) FROM norm)",
        "train AS (SELECT * FROM prep WHERE id % 4 <> 0)",
        "test AS (SELECT * EXCLUDE (Satisfaction_Rating) FROM prep WHERE id % 4 = 0)",
        "raw_train AS (SELECT * FROM passengers WHERE id % 4 <> 0)",
        "raw_test AS (SELECT * EXCLUDE (\"Satisfaction Rating\") FROM passengers WHERE id % 4 = 0)",
        f"scored AS (\n{SCORED_SQL}\n)",
        *ctes,
    ]
    return "WITH " + ",\n".join(parts) + "\n"


def cut_sql(col: str, edges: Sequence[float], labels: Sequence[str], right: bool = True,
            include_lowest: bool = False) -> str:
    def lit(v):
        v = float(v)
        if v == float("inf"):
            return "'inf'::DOUBLE"
        if v == float("-inf"):
            return "'-inf'::DOUBLE"
        return repr(v)

    whens = []
    for i, label in enumerate(labels):
        lo, hi = lit(edges[i]), lit(edges[i + 1])
        if right:
            lop = ">=" if (include_lowest and i == 0) else ">"
            cond = f"{col} {lop} {lo} AND {col} <= {hi}"
        else:
            hop = "<=" if (include_lowest and i == len(labels) - 1) else "<"
            cond = f"{col} >= {lo} AND {col} {hop} {hi}"
        whens.append(f"WHEN {cond} THEN '{label}'")
    return "CASE " + " ".join(whens) + " END"


def unpivot_union(source: str, cols: Sequence[str], value_expr: str = "CAST({c} AS DOUBLE)",
                  extra: Sequence[str] = ()) -> str:
    ex = "".join(f"{e}, " for e in extra)
    return "\nUNION ALL\n".join(
        f"SELECT {ex}'{x}' AS feature, {value_expr.format(c=q(x))} AS value FROM {source}" for x in cols
    )
