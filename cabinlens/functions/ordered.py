"""Exact global ranks and prefix sums without a single-partition window.

``row_number() over (order by ...)`` with no partition moves every row into
one task.  Instead the frame is range-partitioned on the order (a sampled
shuffle, balanced even when one value is hot because the order always ends in
a unique key), each partition is numbered locally, and the per-partition
totals (one row per partition, so bounded by the partition count) give the
offsets.  The numbered frame is checkpointed into ``spark.checkpoint.dir`` so
that a lost executor recomputes nothing inconsistent.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabinlens.session import ensure_checkpoint_dir

_PID = "__pid"
_MID = "__mid"


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8")))


def _range_numbered(df: DataFrame, order: Sequence[Column], num_partitions: int | None) -> DataFrame:
    n = _partitions(df, num_partitions)
    ranged = (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn(_PID, F.spark_partition_id())
        .withColumn(_MID, F.monotonically_increasing_id())
    )
    ensure_checkpoint_dir(df.sparkSession)
    # reliable checkpoint: pins the partition assignment and cuts lineage
    return ranged.checkpoint(eager=True)


def _offsets(df: DataFrame, totals: list[tuple[int, list[float]]], names: Sequence[str]) -> DataFrame:
    """Exclusive running totals per partition id, as a small DataFrame."""
    running = [0] * len(names)
    rows = []
    for pid, vals in sorted(totals):
        rows.append((pid, *running))
        running = [r + (v or 0) for r, v in zip(running, vals)]
    schema = T.StructType(
        [T.StructField(_PID, T.IntegerType())] + [T.StructField(f"__off_{x}", T.DoubleType()) for x in names]
    )
    return df.sparkSession.createDataFrame([(r[0], *[float(v) for v in r[1:]]) for r in rows], schema)


def with_global_rank(df: DataFrame, order: Sequence[Column], name: str = "rank",
                     num_partitions: int | None = None) -> DataFrame:
    """Add a 0-based position of each row in the total ``order``.

    ``order`` must end in a unique key for the rank to be deterministic.
    """
    numbered = _range_numbered(df, order, num_partitions)
    counts = [(r[_PID], [r["n"]]) for r in numbered.groupBy(_PID).agg(F.count("*").alias("n")).collect()]
    offsets = _offsets(df, counts, ["n"])
    local = F.col(_MID) - F.shiftleft(F.col(_PID).cast("long"), 33)
    # the offsets table has one row per partition: a bounded broadcast
    return (
        numbered.join(F.broadcast(offsets), _PID, "left")
        .withColumn(name, (F.coalesce(F.col("__off_n"), F.lit(0.0)).cast("long") + local))
        .drop(_PID, _MID, "__off_n")
    )


def with_prefix_sums(df: DataFrame, order: Sequence[Column], values: Sequence[str],
                     num_partitions: int | None = None, suffix: str = "_before") -> DataFrame:
    """Add ``<v><suffix>``: the sum of ``v`` over all rows strictly earlier in ``order``."""
    numbered = _range_numbered(df, order, num_partitions)
    aggs = [F.sum(F.col(v).cast("double")).alias(v) for v in values]
    totals = [(r[_PID], [r[v] for v in values]) for r in numbered.groupBy(_PID).agg(*aggs).collect()]
    offsets = _offsets(df, totals, values)

    out_names = [f"{v}{suffix}" for v in values]
    schema = T.StructType(numbered.schema.fields + [T.StructField(x, T.DoubleType()) for x in out_names])

    def local_prefix(batches):
        carried = [0.0] * len(values)
        for pdf in batches:
            for i, v in enumerate(values):
                col = pd.to_numeric(pdf[v], errors="coerce").fillna(0.0).astype("float64")
                pdf[out_names[i]] = col.cumsum() - col + carried[i]
                carried[i] += float(col.sum())
            yield pdf

    local = numbered.mapInPandas(local_prefix, schema)
    result = local.join(F.broadcast(offsets), _PID, "left")
    for v, out in zip(values, out_names):
        result = result.withColumn(out, F.col(out) + F.coalesce(F.col(f"__off_{v}"), F.lit(0.0)))
    return result.drop(_PID, _MID, *[f"__off_{v}" for v in values])
