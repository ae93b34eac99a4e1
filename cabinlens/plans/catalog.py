"""Registry of queries: one Spark query per operator, with its DuckDB oracle.

Every query reads the driver tables (``orders`` through the ``passengers``
fixture) in full; nothing is capped or sampled.  Double results are rounded
to 6 decimals on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabinlens import schema as S
from cabinlens.sources import fixtures as FX

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return wrap


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def finish(df: DataFrame) -> DataFrame:
    """Round every double column to 6 decimals (the oracle does the same);
    adding 0.0 turns -0.0 into 0.0.  Built as SQL text: one planner call."""
    exprs = [
        f"ROUND({_q(f.name)}, 6) + 0.0 AS {_q(f.name)}"
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else _q(f.name)
        for f in df.schema.fields
    ]
    return df.selectExpr(*exprs)


# shared inputs ---------------------------------------------------------------
def train_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cabinlens.plans.features import prepare_frame

    return prepare_frame(FX.raw_train(spark, sf_dir))


def test_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cabinlens.plans.features import prepare_frame

    return prepare_frame(FX.raw_test(spark, sf_dir), labelled=False)


def all_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cabinlens.plans.features import prepare_frame

    return prepare_frame(FX.passengers(spark, sf_dir))


# query modules register themselves on import
from cabinlens.plans import q_prepare as _q_prepare  # noqa: E402,F401
from cabinlens.plans import q_profile as _q_profile  # noqa: E402,F401
from cabinlens.plans import q_evaluate as _q_evaluate  # noqa: E402,F401
from cabinlens.plans import q_learn as _q_learn  # noqa: E402,F401
