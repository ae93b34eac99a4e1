"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabinlens.session import scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: later
    jobs do not recompute it, and it survives lost executors."""
    path = scratch_path(df.sparkSession, f"llm-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_key(doc_id: str, text: str) -> Column:
    """64-bit key of a row by its content; repeated equal rows share it."""
    return F.xxhash64(F.col(doc_id), F.lit("\x1f"), F.col(text))


def text_slices(texts: pa.Array, max_bytes: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``max_bytes`` of text each (one row at least), so
    numpy working arrays stay small whatever the Arrow batch holds."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    yield from _ranges(sizes, max_bytes)


def list_slices(lists: pa.Array, max_items: int = 1 << 19, per_row: int = 0) -> Iterator[tuple[int, int]]:
    """The same by list items; a row counts as ``per_row`` items more."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    yield from _ranges(sizes + per_row, max_items)


def _ranges(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    ends = np.cumsum(sizes.astype(np.int64))
    start, done = 0, 0
    while start < len(sizes):
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield start, stop
        start, done = stop, int(ends[stop - 1])


def flat_lists(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets) of a list column; a null list is empty."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    offsets = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    return lists.flatten().to_numpy(zero_copy_only=False), offsets


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points, offsets) of a list of strings."""
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return flat, offsets


MULT = np.uint64(0x9E3779B97F4A7C15)
SECOND = np.uint64(0xC2B2AE3D27D4EB4F)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser over 64 bits."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def window_hashes(values: np.ndarray, length: int, mult: np.uint64 = MULT) -> np.ndarray:
    """Polynomial hash (mod 2**64) of every run of ``length`` values, in one
    pass of prefix sums; the caller drops runs that cross a row border."""
    n = len(values)
    if n < length:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        inverse = np.uint64(pow(int(mult), -1, 1 << 64))
        powers = np.ones(n, np.uint64)
        powers[1:] = mult
        np.multiply.accumulate(powers, out=powers)
        prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(values ^ mult) * powers, out=prefix[1:])
        shift = np.ones(n - length + 1, np.uint64)
        shift[1:] = inverse
        np.multiply.accumulate(shift, out=shift)
        return mix((prefix[length:] - prefix[:-length]) * shift)


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Concatenation of the index ranges [start, start + size)."""
    total = int(sizes.sum())
    if not total:
        return np.empty(0, np.int64)
    ends = np.cumsum(sizes)
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)


def list_array(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


def if_small(df: DataFrame, rows: int, bound: int) -> DataFrame:
    """Broadcast hint for a table whose counted ``rows`` are within ``bound``;
    a larger one is left to Spark's shuffled join."""
    return F.broadcast(df) if rows <= bound else df
