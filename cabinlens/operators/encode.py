"""Categorical encodings.

Encodings that make a column per category (one-hot, dummies) bring the category
list to the driver behind a size check (``collect_bounded``); it becomes literals
in one wide ``select``.  Encodings that make one number per value (codes,
frequencies) keep their fitted table as a DataFrame of any size and look values
up by a hash join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabinlens import schema as S
from cabinlens.functions.exprs import c, q, sql_literal
from cabinlens.functions.guards import MAX_CATEGORIES, collect_bounded, join_small
from cabinlens.functions.value_table import ValueTable


_INTS = ("int", "bigint", "smallint", "tinyint")


def _typed(v, dtype: str):
    if v is None:
        return None
    if dtype in _INTS:
        return int(v)
    if dtype in ("double", "float"):
        return float(v)
    if dtype == "boolean":
        return v == "true"
    return v


def _tagged(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(k, v)``: column index and value as text, one generator per row."""
    pairs = ", ".join(f"{i}, CAST({q(x)} AS STRING)" for i, x in enumerate(cols))
    return df.selectExpr(f"stack({len(cols)}, {pairs}) AS (k, v)")


def distinct_values(df: DataFrame, cols: Sequence[str], keep_null: bool = False) -> dict[str, list]:
    """Sorted distinct values of several columns in one job (NULL last when kept).

    The distinct set is combined map-side and read back only up to a bound.
    """
    if not cols:
        return {}
    rows = collect_bounded(_tagged(df, cols).distinct(), MAX_CATEGORIES * len(cols), "category lists")
    types = dict(df.dtypes)
    out: dict[str, list] = {}
    for i, x in enumerate(cols):
        vals = [_typed(r["v"], types[x]) for r in rows if r["k"] == i]
        present = sorted(v for v in vals if v is not None)
        if len(present) > MAX_CATEGORIES:
            raise ValueError(f"{x} has more than {MAX_CATEGORIES} categories")
        if keep_null and any(v is None for v in vals):
            present.append(None)
        out[x] = present
    return out


def _sorted_distinct(df: DataFrame, col: str, keep_null: bool = False) -> list:
    return distinct_values(df, [col], keep_null)[col]


def _label(v) -> str:
    if v is None:
        return "nan"
    if isinstance(v, float) and v.is_integer():
        return repr(v)
    return str(v)


def _is(col: Column, v) -> Column:
    return col.isNull() if v is None else (col == F.lit(v))


# -- C1 ---------------------------------------------------------------------
def map_values(df: DataFrame, col: str, mapping: Mapping) -> DataFrame:
    """Fixed value map; unmatched values stay (cast when the
    type changes; a value that cannot be cast raises)."""
    if not mapping:
        return df
    src_type = dict(df.dtypes)[col]
    sample = next(iter(mapping.values()))
    same_type = isinstance(sample, str) == (src_type == "string")
    expr = None
    for k, v in mapping.items():
        expr = F.when(c(col) == F.lit(k), F.lit(v)) if expr is None else expr.when(c(col) == F.lit(k), F.lit(v))
    if same_type:
        expr = expr.otherwise(c(col))
    else:
        target = "string" if isinstance(sample, str) else ("double" if isinstance(sample, float) else "int")
        # a value that is neither mapped nor of the target type is an error, not a NULL
        cast = F.expr(f"try_cast(`{col}` AS {target})")
        told = F.raise_error(F.concat(F.lit(f"no mapping for {col} = "), c(col).cast("string"))).cast(target)
        expr = expr.when(c(col).isNull() | cast.isNotNull(), cast).otherwise(told)
    return df.withColumn(col, expr)


def encode_rating(df: DataFrame, col: str = S.TARGET) -> DataFrame:
    return map_values(df, col, S.RATING_LABELS)


# -- C2 ---------------------------------------------------------------------
def _looked_up(df: DataFrame, tables: Mapping[str, DataFrame], value: str, out: Mapping[str, str], default=None) -> DataFrame:
    """``df`` with, for each column, ``value`` of its row in the fitted table as
    column ``out[column]``: one hash join a column.  A table that is proven small
    is broadcast, so that the rows of a frequent value stay where they are."""
    wide = df
    for i, (x, table) in enumerate(tables.items()):
        own = table.select(F.col("v").alias(f"__v{i}"), F.col(value).alias(f"__c{i}"))
        wide = join_small(wide, own, c(x) == F.col(f"__v{i}"), "left")
    found = {out[x]: F.col(f"__c{i}") if default is None else F.coalesce(f"__c{i}", F.lit(default)) for i, x in enumerate(tables)}
    return wide.select(*[found[x].alias(x) if x in found else c(x) for x in df.columns],
                       *[v.alias(x) for x, v in found.items() if x not in df.columns])


@dataclass
class CategoryCodes:
    """Sorted category position + 1; NULL and unseen values give 0.  ``tables``
    has for each column (v, code), of any number of categories."""

    tables: dict[str, DataFrame] = field(default_factory=dict)

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str]) -> "CategoryCodes":
        cols = list(cols)
        return cls(dict(zip(cols, ValueTable.of(df, cols).codes())) if cols else {})

    def transform(self, df: DataFrame) -> DataFrame:
        return _looked_up(df, self.tables, "code", {x: x for x in self.tables}, default=0)


# -- C3 ---------------------------------------------------------------------
def label_encoder(train: DataFrame, col: str, output: str | None = None):
    """Alphabetical index from 0; an unseen value fails the transform."""
    return StringIndexer(
        inputCol=col, outputCol=output or f"{col}_idx", stringOrderType="alphabetAsc", handleInvalid="error"
    ).fit(train)


# -- C4 / C5 ----------------------------------------------------------------
@dataclass
class OneHot:
    """0/1 columns per sorted category, appended at the end; source dropped.

    ``drop_first=False`` (one-hot of the full feature set): a feature with
    exactly two distinct values (NULL counted) keeps only the second; a NULL
    category is its own ``_nan`` column.  ``drop_first=True`` (dummies): the
    first sorted category is dropped and NULL gives all zeros.
    """

    categories: dict[str, list] = field(default_factory=dict)
    drop_first: bool = False

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str], drop_first: bool = False,
            domains: Mapping[str, Sequence] | None = None) -> "OneHot":
        domains = domains or {}
        fitted = distinct_values(df, [x for x in cols if x not in domains], keep_null=not drop_first)
        cats = {x: list(domains[x]) if x in domains else fitted[x] for x in cols}
        return cls(cats, drop_first)

    def columns_for(self, x: str) -> list[tuple[str, object]]:
        cats = self.categories[x]
        if self.drop_first:
            keep = cats[1:]
        elif len(cats) == 2:
            keep = cats[1:]
        else:
            keep = cats
        return [(f"{x}_{_label(v)}".replace(" ", "_"), v) for v in keep]

    def transform(self, df: DataFrame) -> DataFrame:
        # SQL text keeps the wide projection to one planner call
        new_cols = []
        for x in self.categories:
            for name, v in self.columns_for(x):
                test = f"{q(x)} IS NULL" if v is None else f"COALESCE({q(x)} = {sql_literal(v)}, false)"
                new_cols.append(f"CAST({test} AS INT) AS {q(name)}")
        kept = [q(x) for x in df.columns if x not in self.categories]
        return df.selectExpr(*kept, *new_cols)


def onehot(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fit on the frame itself and apply."""
    return OneHot.fit(df, cols).transform(df)


def dummies(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    return OneHot.fit(fit_on if fit_on is not None else df, cols, drop_first=True).transform(df)


# -- C6 ---------------------------------------------------------------------
def survey_dummies(df: DataFrame, cols: Sequence[str] | None = None, domain: Sequence = (1, 2, 3, 4, 5),
                   extra_values: bool = False) -> DataFrame:
    """Fixed ``<col>_1`` .. ``<col>_5`` columns (all 0 when a value is absent),
    no ``_0`` column.  ``extra_values`` adds a column per other non-zero value
    found in the data (e.g. 2.5 after imputation); that needs one small job."""
    cols = list(cols or S.SURVEY)
    per_col = {x: list(domain) for x in cols}
    if extra_values:
        found_all = distinct_values(df, cols)
        for x in cols:
            found = found_all[x]
            extra = [v for v in found if v not in per_col[x] and v != 0]
            per_col[x] = sorted(set(per_col[x]) | set(extra), key=float)
    new_cols = []
    for x in cols:
        for v in per_col[x]:
            label = int(v) if float(v).is_integer() else v
            new_cols.append(f"CAST(COALESCE({q(x)} = {sql_literal(v)}, false) AS INT) AS {q(f'{x}_{label}')}")
    kept = [q(x) for x in df.columns if x not in cols]
    return df.selectExpr(*kept, *new_cols)


# -- C7 ---------------------------------------------------------------------
@dataclass
class FrequencyEncoder:
    """``<col>_freq`` = share of the value among non-NULL rows; NULL and unseen
    values give NULL.  ``tables`` has for each column (v, share)."""

    tables: dict[str, DataFrame] = field(default_factory=dict)

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str]) -> "FrequencyEncoder":
        cols = list(cols)
        return cls(dict(zip(cols, ValueTable.of(df, cols).shares())) if cols else {})

    def transform(self, df: DataFrame) -> DataFrame:
        return _looked_up(df, self.tables, "share", {x: f"{x}_freq" for x in self.tables})


def frequency_encode(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return FrequencyEncoder.fit(df, cols).transform(df)


# -- F2 ---------------------------------------------------------------------
def lookup(df: DataFrame, table: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Value-map lookup: broadcast hash join when the map is proven small."""
    return join_small(df, table, key, how)
