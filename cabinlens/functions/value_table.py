"""One table of the values of several columns with their counts, in native types.

``ValueTable.of`` reads the frame once: tasks count the values of each Arrow
column, so no row is unpivoted, and a ``groupBy`` adds the counts up.  The table
``(k, l, d, s, n)`` holds column ``k``'s value as a long, a double or a text, all
null for NULL, and is checkpointed in the shared folder.  Modes, distinct counts,
frequencies, moments and quantiles are read from it; a value never changes its
type on the way, and no task or driver holds a column.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabinlens.functions.exprs import c
from cabinlens.functions.ordered import with_global_rank, with_prefix_sums
from cabinlens.session import ensure_checkpoint_dir

LONG, DOUBLE, TEXT = "l", "d", "s"
_ARROW = {LONG: pa.int64(), DOUBLE: pa.float64(), TEXT: pa.string()}
_SPARK = {LONG: "bigint", DOUBLE: "double", TEXT: "string"}
VALUE = ("l", "d", "s")


def kind_of(data_type: T.DataType) -> str:
    if isinstance(data_type, (T.IntegralType, T.BooleanType)):
        return LONG
    return DOUBLE if isinstance(data_type, (T.FractionalType, T.DecimalType)) else TEXT


def _counts(kinds: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, kind in enumerate(kinds):
                found = pc.value_counts(batch.column(k))
                n = len(found)
                columns = [pa.array([k] * n, pa.int32())]
                columns += [found.field(0) if x == kind else pa.nulls(n, _ARROW[x]) for x in VALUE]
                yield pa.RecordBatch.from_arrays([*columns, found.field(1)], names=["k", *VALUE, "n"])

    return run


@dataclass
class ValueTable:
    table: DataFrame
    cols: list[str]
    types: list[T.DataType]

    @classmethod
    def of(cls, df: DataFrame, cols: Sequence[str]) -> "ValueTable":
        cols = list(cols)
        types = [df.schema[x].dataType for x in cols]
        kinds = [kind_of(t) for t in types]
        own = df.select(*[c(x).cast(_SPARK[k]).alias(f"x{i}") for i, (x, k) in enumerate(zip(cols, kinds))])
        parts = own.mapInArrow(_counts(kinds), "k int, l bigint, d double, s string, n bigint")
        ensure_checkpoint_dir(df.sparkSession)
        return cls(parts.groupBy("k", *VALUE).agg(F.sum("n").alias("n")).checkpoint(), cols, types)

    def _present(self) -> DataFrame:
        return self.table.where("l IS NOT NULL OR d IS NOT NULL OR s IS NOT NULL")

    def numbers(self) -> DataFrame:
        """(k, value, n) of the numeric columns' values, as doubles."""
        return self._present().where("s IS NULL").select("k", F.coalesce("d", F.col("l").cast("double")).alias("value"), "n")

    def native(self, k: int, row) -> object:
        """Column ``k``'s value of a row with l, d and s, as the column's own type."""
        kind = kind_of(self.types[k])
        value = row[kind]
        return bool(value) if value is not None and isinstance(self.types[k], T.BooleanType) else value

    def modes(self) -> dict[str, object]:
        """Most frequent non-NULL value of each column, the lowest on ties."""
        best = self._present().groupBy("k").agg(F.expr("min_by(struct(l, d, s), struct(-n, l, d, s))").alias("m")).collect()
        found = {r["k"]: self.native(r["k"], r["m"]) for r in best}
        return {x: found.get(k) for k, x in enumerate(self.cols)}

    def distinct(self) -> DataFrame:
        """(k, distinct): number of values of each column, NULL being one."""
        return self.table.groupBy("k").agg(F.count("*").alias("distinct"))

    def shares(self) -> list[DataFrame]:
        """For each column (v, share): its non-NULL values and their shares."""
        own = self._present()
        totals = own.groupBy(F.col("k").alias("tk")).agg(F.sum("n").alias("total"))  # one row a column
        shares = own.join(F.broadcast(totals), F.col("k") == F.col("tk")).withColumn("share", F.col("n") / F.col("total"))
        return [self._column(shares, k, "share") for k in range(len(self.cols))]

    def codes(self) -> list[DataFrame]:
        """For each column (v, code): its sorted non-NULL values, numbered from 1."""
        ranked = with_global_rank(self._present(), [F.col(x).asc() for x in ("k", *VALUE)], "r")
        first = {r["k"]: r["r"] for r in ranked.groupBy("k").agg(F.min("r").alias("r")).collect()}
        return [self._column(ranked.withColumn("code", (F.col("r") - first.get(k, 0) + 1).cast("int")), k, "code") for k in range(len(self.cols))]

    def _column(self, table: DataFrame, k: int, more: str) -> DataFrame:
        value = F.col(kind_of(self.types[k])).cast(self.types[k])
        return table.where(F.col("k") == k).select(value.alias("v"), more)

    def moments(self) -> DataFrame:
        """(k, count, mean, std, min, max, g1, g2) of the numeric columns: sample
        standard deviation, population skewness and excess kurtosis (NULL without
        spread)."""
        own = self.numbers()
        # one row a column
        means = own.groupBy("k").agg((F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean"), F.min("value").alias("min"),
                                     F.max("value").alias("max"), F.sum("n").alias("count"))
        off = F.col("value") - F.col("mean")
        sums = own.join(F.broadcast(means), "k").groupBy("k").agg(*[F.sum(F.col("n") * off ** p).alias(f"m{p}") for p in (2, 3, 4)])
        spread = F.when(F.col("min") < F.col("max"), F.col("m2"))
        n = F.col("count")
        return means.join(F.broadcast(sums), "k").select(
            "k", "count", "mean", "min", "max",
            F.when(n > 1, F.sqrt(F.coalesce(spread, F.col("m2") * 0) / (n - 1))).alias("std"),
            (F.col("m3") / n / F.pow(spread / n, F.lit(1.5))).alias("g1"), (F.col("m4") / n / F.pow(spread / n, F.lit(2.0)) - 3).alias("g2"))

    def quantiles(self, probs: Sequence[float]) -> dict[str, list]:
        """Exact quantiles of the numeric columns, with linear interpolation."""
        own = self.numbers()
        totals = {r["k"]: r["n"] for r in own.groupBy("k").agg(F.sum("n").alias("n")).collect()}
        places = {(k, r) for k, n in totals.items() for p in probs for r in (math.floor((n - 1) * p), math.ceil((n - 1) * p))}
        before, offset = 0, {}
        for k in range(len(self.cols)):
            offset[k] = before
            before += totals.get(k, 0)
        at: dict[tuple[int, int], float] = {}
        if places:
            # prefix sums over (k, value); each column starts behind the earlier ones
            ranked = with_prefix_sums(own, [F.col("k").asc(), F.col("value").asc()], ["n"])
            wanted = self.table.sparkSession.createDataFrame([(k, r, offset[k] + r) for k, r in sorted(places)], "wk int, r long, g long")
            hit = ranked.join(F.broadcast(wanted), (F.col("k") == F.col("wk")) & (F.col("n_before") <= F.col("g"))
                              & (F.col("g") < F.col("n_before") + F.col("n")))
            at = {(x["k"], x["r"]): x["value"] for x in hit.select("k", "r", "value").collect()}

        def point(k: int, p: float) -> float | None:
            n = totals.get(k, 0)
            if not n:
                return None
            low, high = at[k, math.floor((n - 1) * p)], at[k, math.ceil((n - 1) * p)]
            return low + (high - low) * ((n - 1) * p - math.floor((n - 1) * p))

        return {x: [point(k, p) for p in probs] for k, x in enumerate(self.cols)}
