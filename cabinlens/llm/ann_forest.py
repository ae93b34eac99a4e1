"""Approximate nearest neighbours by a hash-prefix forest (operator 3).

Every vector gets, for each of ``TREES`` trees, a string of ``BITS`` signs of
random projections.  The index rows are spread over blocks of ``BLOCK_ROWS``;
in a block each tree is a sorted array of its strings.  A query descends in
each tree, by binary search, to the rows with the longest common prefix, and
then ascends in all trees at once, one bit at a time, until the ranges hold the
block's part of ``breadth * n ** POWER`` rows (of ``n`` entries, ``least`` at
least) in all, a row counted in each tree: a query's candidates grow less than
the index.  They are scored by
cosine, each block hands on its best, and the best of all blocks stay.
The query set, in parts of as many rows, meets every block: a stated query set
against all rows.

Equal vectors are one entry with the smallest ids that can be asked for, as
ties go to smaller ids: so a vector that a third of all rows holds neither
fills a block nor makes pairs, and the result stays exact for it.  An entry is
placed in a block by a hash of its vector, so no block depends on the data's
clusters.  Entries whose cosines are equal or nearly so (multiples of one vector)
are put in the order of the result before a block hands on its best.  See README for the recall at several sizes.

Defined cases: rows with a null id or a vector that is null, empty, zero or
holds null or non-finite components take no part; vectors of different lengths
never meet; rows with the same id are no candidates of each other, and
identical rows count once; a query without candidates returns no row; other
columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cabinlens.llm.common import materialize

TREES = 256
BITS = 16
BLOCK_ROWS = 16384
#: Growth of a query's candidates with the index.
POWER = 0.7
#: Trees that are hashed at a time.
TREES_AT_ONCE = 8
#: Cosines this close may be equal in exact order.
ROUNDING = 1e-9


def _strings(x: np.ndarray, trees: int, bits: int) -> np.ndarray:
    """(trees, rows) integers whose leading bits are the hash string's start: the
    signs of random projections, the same for every block."""
    weights = 1 << np.arange(bits - 1, -1, -1, dtype=np.int64)
    out = np.empty((trees, len(x)), np.int32)
    for i in range(0, trees, TREES_AT_ONCE):
        n = min(TREES_AT_ONCE, trees - i)
        planes = np.random.default_rng([x.shape[1], i]).normal(size=(x.shape[1], n * bits))
        out[i:i + n] = ((x @ planes > 0).reshape(len(x), n, bits) @ weights).T
    return out


class Forest:
    """Sorted hash strings of one block, a tree each."""

    def __init__(self, x: np.ndarray, trees: int = TREES, bits: int = BITS):
        self.x = x / np.linalg.norm(x, axis=1, keepdims=True)
        self.trees, self.bits = trees, bits
        strings = _strings(self.x, trees, bits)
        self.order = np.argsort(strings, axis=1, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(strings, self.order, axis=1)

    def candidates(self, q: np.ndarray, wanted: int) -> list[np.ndarray]:
        """Rows found for each (unit) query."""
        keys = _strings(q, self.trees, self.bits)
        open_ = np.ones(len(q), bool)
        low, high = np.zeros(keys.shape, np.int64), np.zeros(keys.shape, np.int64)
        for depth in range(self.bits, -1, -1):  # all trees ascend together
            at = np.flatnonzero(open_)
            if not len(at):
                break
            drop = self.bits - depth
            for t in range(self.trees):
                start = (keys[t, at] >> drop) << drop
                low[t, at] = np.searchsorted(self.sorted[t], start, side="left")
                high[t, at] = np.searchsorted(self.sorted[t], start + (1 << drop), side="left")
            open_[at] = (high[:, at] - low[:, at]).sum(axis=0) < wanted
        mark = np.zeros(len(self.x), bool)
        out = []
        for i in range(len(q)):
            mark[:] = False
            for t in range(self.trees):
                mark[self.order[t, low[t, i]:high[t, i]]] = True
            out.append(np.flatnonzero(mark))
        return out


def _dot(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row-wise dot products, added from the first component to the last."""
    return np.add.accumulate(x * y, axis=-1)[..., -1]


def exact_cosine(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The score of ``_cosine``, with the same operations in the same order."""
    return _dot(x, q) / (np.sqrt(_dot(q, q)) * np.sqrt(_dot(x, x)))


def _search(k: int, share: float, trees: int, bits: int):
    """Best entries of one block for the queries that meet it."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"qv": pd.Series([], dtype="int64"), "entry": pd.Series([], dtype="int64")})
        if not len(left) or not len(right):
            return none
        raw = np.stack(left["v"].to_numpy()).astype(np.float64)
        forest = Forest(raw, trees, bits)
        entries, low = left["entry"].to_numpy(), left["low"].to_numpy()
        q_all, names = np.stack(right["v"].to_numpy()).astype(np.float64), right["entry"].to_numpy()
        wanted = math.ceil(share * len(left))
        out_q, out_e = [], []
        for i in range(0, len(names), 512):
            q = q_all[i:i + 512]
            q = q / np.linalg.norm(q, axis=1, keepdims=True)
            for name, vector, q_raw, rows in zip(names[i:i + 512], q, q_all[i:i + 512], forest.candidates(q, wanted)):
                best = rows
                if len(rows) > k + 1:
                    near = forest.x[rows] @ vector
                    # all that rounding may put among the first k + 1, in the order of the result
                    close = rows[near >= np.partition(near, len(rows) - k - 1)[len(rows) - k - 1] - ROUNDING]
                    score = exact_cosine(raw[close], q_raw)
                    best = close[np.lexsort((low[close], -score))[:k + 1]]
                out_q.append(np.full(len(best), name))
                out_e.append(entries[best])
        return pd.DataFrame({"qv": np.concatenate(out_q), "entry": np.concatenate(out_e)})

    return run


def _cosine(a: str, b: str) -> str:
    """Cosine in double precision, components added from the first to the last."""
    def dot(x: str, y: str) -> str:
        return f"aggregate(zip_with({x}, {y}, (p, q) -> CAST(p AS DOUBLE) * CAST(q AS DOUBLE)), 0D, (s, p) -> s + p)"

    return f"{dot(a, b)} / (sqrt({dot(a, a)}) * sqrt({dot(b, b)}))"


def nearest(
    vectors: DataFrame, is_query, k: int = 5, breadth: float = 5.0, least: int = 2048, trees: int = TREES, bits: int = BITS,
    block_rows: int = BLOCK_ROWS, vec_id: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that ``is_query`` (a
    condition on the id column) selects, its ``k`` nearest found."""
    own = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("v"), is_query.alias("is_query"))
    fine = "size(v) > 0 AND NOT exists(v, c -> c IS NULL OR isnan(c) OR abs(c) = double('Infinity')) AND exists(v, c -> c <> 0)"
    own = own.where("id IS NOT NULL AND v IS NOT NULL").where(fine).distinct()
    own = materialize(own.withColumn("entry", F.xxhash64("v")), "vectors")

    # entries: distinct vectors with the k + 1 smallest ids that hold them (the
    # rank limit is applied before the shuffle as well)
    ranked = own.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("r") <= k + 1)
    entries = materialize(ranked.groupBy("v").agg(F.first("entry").alias("entry"), F.collect_list("id").alias("ids")), "entries")
    n = entries.count()
    blocks, share = max(1, math.ceil(n / block_rows)), max(least, breadth * n ** POWER) / max(n, 1)
    asked = own.where("is_query").select("entry", "v").distinct()
    parts = max(1, math.ceil(asked.count() / block_rows))  # so that a task holds a bounded part of either side
    placed = entries.select(
        "entry", "v", F.array_min("ids").alias("low"), F.size("v").alias("dim"), F.pmod(F.col("entry"), F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    asked = asked.select(
        "entry", "v", F.size("v").alias("dim"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        F.pmod(F.hash("entry"), F.lit(parts)).alias("part"))
    found = placed.groupBy("dim", "block", "part").cogroup(asked.groupBy("dim", "block", "part")).applyInPandas(
        _search(k, share, trees, bits), "qv long, entry long")

    # exact scores of the few found, in SQL; then the ids behind each entry
    left = own.where("is_query").select(F.col("id").alias("query_id"), F.col("entry").alias("q_entry"), F.col("v").alias("q_v"))
    pairs = left.join(found, F.col("q_entry") == F.col("qv")).join(
        entries.select(F.col("entry").alias("e"), F.col("v").alias("e_v"), "ids"), F.col("entry") == F.col("e"))
    scored = pairs.select("query_id", F.expr(_cosine("q_v", "e_v")).alias("score"), F.explode("ids").alias("vec_id"))
    scored = scored.where("vec_id <> query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
