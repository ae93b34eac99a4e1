"""Near-duplicate documents by DartMinHash and banding (operator 6).

A document is the multiset of its ``SHINGLE``-word runs (a shorter text, if it
has words, is one run).  Similarity is the weighted Jaccard measure of two such
multisets, and documents of ``THRESHOLD`` or more are linked.

DartMinHash: for every unit of weight of an element, hashed darts are thrown
into the rank axis at rate ``K``; the darts of a region (element, unit, rank
octave) depend on nothing else, so equal regions of two documents hold equal
darts.  A document needs only the darts below a rank of about
``(ln K + 2) / weight``, some ``K ln K + 2 K`` of them whatever its length; the
earliest dart of each of the ``K`` coordinates is its signature, and two
signatures agree in a coordinate with a probability equal to the similarity.
When a coordinate stays empty the next octave is thrown too.

``BANDS`` bands of ``ROWS`` coordinates make buckets: a pair at similarity 0.8
misses all of them with probability (1 - 0.8**6)**32 = 6e-5.  Equal word
sequences are one class beforehand.  In each of ``ROUNDS`` rounds one class of a
bucket, the head (that which shares most buckets with others, after the first
round one outside of the largest component), is compared with each member of
another component, by their whole multisets.  Then all pairs of members of
different components are compared, whatever the bucket's size: those outside of
its largest component with all others.  Before texts are fetched, sizes too far
apart and pairs whose ``BITS``-bit parities differ in more places than the
multisets may are left out; both tests are exact.  So a bucket of n near copies
and a few others makes about n pairs, and no partner is capped.

Defined cases: null, empty and word-less texts are never near-duplicates; a
null ``doc_id`` is its own class with a null class id; rows with the same id
are one document when their texts are equal, else each is compared; repeated
rows are returned as often as they occur; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabinlens.llm.common import (
    MULT, SECOND, flat_lists, if_small, list_array, list_slices, materialize, mix, ragged, window_hashes,
)
from cabinlens.llm.components import components

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 6
K = BANDS * ROWS
#: Rounds in which a bucket's members are compared with one head.
ROUNDS = 2
#: Bits of a multiset's parity sketch.
BITS = 512
#: Most candidate classes (16 bytes each) whose keys are broadcast to skip a shuffle of all texts.
BROADCAST_KEYS = 1_000_000


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.coalesce(F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), ""), F.array().cast("array<string>"))


def shingles(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets) of the word runs of each row; a row of fewer words has one run."""
    sizes = np.diff(offsets)
    counts = np.where(sizes >= SHINGLE, sizes - SHINGLE + 1, np.minimum(sizes, 1))
    out_offsets = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=out_offsets[1:])
    padded = np.concatenate([values, np.zeros(SHINGLE, np.uint64)])
    hashes = window_hashes(padded, SHINGLE)[ragged(offsets[:-1], counts)]
    for row in np.flatnonzero((sizes > 0) & (sizes < SHINGLE)):
        own = values[offsets[row]:offsets[row + 1]]
        hashes[out_offsets[row]] = window_hashes(own, len(own))[0]
    return hashes, out_offsets


def _units(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One key for each unit of weight: the j-th copy of an element in its row
    is the region (element, [j - 1, j)).  Sorted by row and element."""
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    with np.errstate(over="ignore"):
        joint = mix(hashes + row.astype(np.uint64) * MULT)
        order = np.argsort(joint, kind="stable")
        h, r, joint = hashes[order], row[order], joint[order]
        new = np.ones(len(h), bool)
        new[1:] = joint[1:] != joint[:-1]
        firsts = np.flatnonzero(new)
        copy = np.arange(len(h)) - np.repeat(firsts, np.diff(np.append(firsts, len(h))))
        return np.where(copy > 0, mix(h + copy.astype(np.uint64) * SECOND), h), r


#: Darts of a document, whatever its length: rows are taken together up to a number of darts.
DARTS = int(K * (math.log(K) + 2))
#: The rank axis is cut at 2**-9, 2**-8, ..., 1, 2, 3, ...
FIRST = 9


def _ranks(region: int) -> tuple[float, float]:
    if region == 0:
        return 0.0, 2.0 ** -FIRST
    if region <= FIRST:
        return 2.0 ** (region - FIRST - 1), 2.0 ** (region - FIRST)
    return float(region - FIRST), float(region - FIRST + 1)


def _poisson(mean: float) -> np.ndarray:
    """Chance of at most 0, 1, 2, ... darts in a region."""
    p = math.exp(-mean)
    out = [p]
    for i in range(1, int(mean + 12 * math.sqrt(mean) + 20)):
        p *= mean / i
        out.append(out[-1] + p)
    return np.array(out)


def _throw(units: np.ndarray, rows: np.ndarray, region: int, best: np.ndarray, rank: np.ndarray) -> None:
    """Throw the darts of one rank region and keep the earliest per coordinate."""
    low, high = _ranks(region)
    with np.errstate(over="ignore"):
        seed = mix(units + np.uint64(region + 1) * MULT)
        count = np.searchsorted(_poisson(K * (high - low)), (seed >> np.uint64(11)) / float(1 << 53), side="right")
        which = np.repeat(np.arange(len(units)), count)
        number = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        dart = mix(seed[which] + (number.astype(np.uint64) + np.uint64(1)) * SECOND)
        at = low + (high - low) * ((dart >> np.uint64(11)) / float(1 << 53))
        name = mix(dart + SECOND)
    cell = rows[which] * K + (name % np.uint64(K)).astype(np.int64)
    order = np.lexsort((at, cell))
    cell, at, name = cell[order], at[order], name[order]
    first = np.ones(len(cell), bool)
    first[1:] = cell[1:] != cell[:-1]
    cell, at, name = cell[first], at[first], name[first]
    better = at < rank[cell]
    rank[cell[better]], best[cell[better]] = at[better], name[better]


def signatures(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """K coordinates for each row with elements (zeros for the others)."""
    n = len(offsets) - 1
    best, rank = np.zeros(n * K, np.uint64), np.full(n * K, np.inf)
    units, rows = _units(hashes, offsets)
    weight = np.diff(offsets)
    bound = (math.log(K) + 2) / np.maximum(weight, 1)
    todo, region = weight > 0, 0
    while todo.any():
        use = todo[rows]
        _throw(units[use], rows[use], region, best, rank)
        full = np.isfinite(rank.reshape(n, K)).all(axis=1)
        todo &= ~(full & (_ranks(region)[1] >= bound))
        region += 1
    return best.reshape(n, K)


def _row_hashes(values: np.ndarray, offsets: np.ndarray, mult: np.uint64) -> np.ndarray:
    """Order-dependent hash of each row's words."""
    sizes = np.diff(offsets)
    with np.errstate(over="ignore"):
        powers = np.ones(int(sizes.max(initial=0)) + 1, np.uint64)
        powers[1:] = mult
        np.multiply.accumulate(powers, out=powers)
        pos = ragged(np.zeros(len(sizes), np.int64), sizes)
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(mix(values ^ mult) * powers[pos], out=sums[1:])
        return mix(sums[offsets[1:]] - sums[offsets[:-1]] + sizes.astype(np.uint64))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(d, c1, c2, bands): class of the word sequence and its bucket keys."""
    for batch in batches:
        for a, b in list_slices(batch["h"], 1 << 18, DARTS):
            part = batch.slice(a, b - a)
            values, offsets = flat_lists(part["h"])
            values = values.view(np.uint64)
            some = np.diff(offsets) > 0
            sign = signatures(*shingles(values, offsets)).reshape(-1, BANDS, ROWS)
            with np.errstate(over="ignore"):
                key = np.arange(BANDS, dtype=np.uint64) * SECOND
                for i in range(ROWS):
                    key = mix(key * MULT + sign[:, :, i])
            classes = [pa.array(_row_hashes(values, offsets, m).view(np.int64), mask=~some) for m in (MULT, SECOND)]
            bands = list_array(key[some].ravel().view(np.int64), np.where(some, BANDS, 0), pa.int64())
            yield pa.RecordBatch.from_arrays([part["d"], *classes, bands], names=["d", "c1", "c2", "bands"])


def _parities(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(rows, BITS / 64): bit i of a row is the parity of its shingles in bucket i."""
    rows = len(offsets) - 1
    cell = np.repeat(np.arange(rows), np.diff(offsets)) * BITS + (mix(hashes ^ SECOND) % np.uint64(BITS)).astype(np.int64)
    odd = (np.bincount(cell, minlength=rows * BITS) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64).reshape(rows, BITS // 64)


def _multisets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, sh, bits): sorted 64-bit shingle hashes, repeated by their
    multiplicity, and their parities."""
    for batch in batches:
        for a, b in list_slices(batch["h"], 1 << 18, BITS):
            part = batch.slice(a, b - a)
            values, offsets = flat_lists(part["h"])
            hashes, at = shingles(values.view(np.uint64), offsets)
            row = np.repeat(np.arange(len(at) - 1), np.diff(at))
            own = hashes[np.lexsort((hashes, row))]
            bits = _parities(hashes, at)
            yield pa.RecordBatch.from_arrays(
                [part["d"], list_array(own.view(np.int64), np.diff(at), pa.int64()),
                 list_array(bits.ravel(), np.full(len(bits), BITS // 64), pa.int64())], names=["node", "sh", "bits"])


def similarity(x: np.ndarray, y: np.ndarray) -> float:
    """Weighted Jaccard of two sorted multisets."""
    if len(x) == len(y) and np.array_equal(x, y):
        return 1.0
    (u, m), (v, n) = np.unique(x, return_counts=True), np.unique(y, return_counts=True)
    _, i, j = np.intersect1d(u, v, assume_unique=True, return_indices=True)
    both = int(np.minimum(m[i], n[j]).sum())
    return both / (len(x) + len(y) - both) if len(x) + len(y) else 0.0


def _compare(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs, xo = flat_lists(batch["sh_a"])
            ys, yo = flat_lists(batch["sh_b"])
            ok = []
            for i in range(batch.num_rows):
                x, y = xs[xo[i]:xo[i + 1]], ys[yo[i]:yo[i + 1]]
                short = min(len(x), len(y)) < threshold * max(len(x), len(y))
                ok.append(not short and similarity(x, y) >= threshold)
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"], pa.array(ok, pa.bool_())], names=["a", "b", "ok"])

    return run


def near_classes(sketch: DataFrame, base: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame | None]:
    """(classes, roots) of the sketches: classes (c1, c2, node) of equal word
    sequences, and (node, root) of those with links."""
    classes = materialize(sketch.where("c1 IS NOT NULL AND d IS NOT NULL").groupBy("c1", "c2").agg(
        F.min("d").alias("node"), F.first("bands").alias("bands")), "classes")
    rows = classes.select("node", F.explode("bands").alias("bucket")).distinct()
    crowded = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select(F.col("bucket").alias("b"), "n")
    shared = materialize(rows.join(crowded, F.col("bucket") == F.col("b")).select("bucket", "node", "n"), "buckets")
    # a text that shares most buckets with most others is nearest to the middle
    # of its group, and so matches the most of them: it goes first
    weight = shared.groupBy("node").agg(F.sum("n").alias("w")).select(F.col("node").alias("wn"), "w")
    nodes = shared.select(F.col("node").alias("k")).distinct()
    texts = base.join(if_small(nodes, nodes.count(), BROADCAST_KEYS), F.col("d") == F.col("k"), "left_semi")
    shingled = materialize(texts.dropDuplicates(["d", "text"]).select(
        "d", F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("h")).mapInArrow(
        _multisets, "node long, sh array<long>, bits array<long>"), "shingles")

    # an id that holds several texts has no single parity, and is compared without
    sizes = shingled.groupBy(F.col("node").alias("sn")).agg(
        F.min(F.size("sh")).alias("low"), F.max(F.size("sh")).alias("high"), F.when(F.count("*") == 1, F.first("bits")).alias("bits"))
    sizes = materialize(sizes, "sizes")
    pending = shared.join(weight, F.col("node") == F.col("wn")).join(sizes.drop("bits"), F.col("node") == F.col("sn")).select(
        "bucket", "node", F.col("node").alias("root"), "w", "low", "high")
    pending = materialize(pending, "pending")

    links, tested, roots, turn = [], None, None, 0
    left = shingled.select(F.col("node").alias("na"), F.col("sh").alias("sh_a"))
    right = shingled.select(F.col("node").alias("nb"), F.col("sh").alias("sh_b"))
    sketches = [sizes.select(F.col("sn").alias(f"k{x}"), F.col("high").alias(f"size_{x}"), F.col("bits").alias(f"bits_{x}")) for x in "ab"]
    while True:
        heads = materialize(_heads(pending, turn), "heads")
        last = turn >= ROUNDS
        pairs = _all_pairs(pending, heads, sizes, threshold) if last else _head_pairs(pending, heads, threshold)
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs")
        if not last and pairs.isEmpty():
            turn = ROUNDS
            continue
        close = pairs.join(sketches[0], F.col("a") == F.col("ka")).join(sketches[1], F.col("b") == F.col("kb")).where(
            F.expr(_may_match("size_a", "size_b", "bits_a", "bits_b", threshold))).select("a", "b")
        scored = close.join(left, F.col("a") == F.col("na")).join(right, F.col("b") == F.col("nb")).select(
            "a", "b", "sh_a", "sh_b").mapInArrow(_compare(threshold), "a long, b long, ok boolean")
        new = materialize(scored.where("ok").select("a", "b").distinct(), "links")
        tested = pairs if tested is None else tested.unionAll(pairs)
        if new.isEmpty() and roots is not None:  # the components stay
            if last:
                return classes, roots
            turn = ROUNDS
            continue
        links.append(new)
        roots = materialize(components(reduce(DataFrame.unionAll, links)), "roots")
        if last:
            return classes, roots
        moved = pending.withColumnRenamed("root", "was").join(
            roots.select(F.col("node").alias("rn"), "root"), F.col("node") == F.col("rn"), "left")
        pending = materialize(moved.withColumn("root", F.coalesce("root", "was")).select(*pending.columns), "pending")
        turn += 1


def _may_match(a: str, b: str, bits_a: str, bits_b: str, threshold: float) -> str:
    """Whether multisets of these sizes may reach the threshold: their parities
    differ in no more places than the multisets do."""
    differ = " + ".join(f"bit_count({bits_a}[{i}] ^ {bits_b}[{i}])" for i in range(BITS // 64))
    most = f"{a} + {b} - 2 * ceil({threshold}D * ({a} + {b}) / {1 + threshold}D - 1e-6D)"
    return f"coalesce({differ} <= {most}, true)"


def _heads(pending: DataFrame, turn: int) -> DataFrame:
    """Buckets whose members are of several components: their head and largest component."""
    per_root = pending.groupBy("bucket", "root").agg(
        F.max(F.struct("w", F.negative("node").alias("last"), "node", "root", "low", "high")).alias("top"), F.count("*").alias("c"))
    heads = per_root.groupBy(F.col("bucket").alias("b")).agg(
        F.count("*").alias("n_roots"), F.max("top").alias("head"), F.max(F.struct("c", "root")).alias("main")).where("n_roots > 1")
    if not turn:
        return heads
    other = per_root.join(heads.drop("head"), F.col("bucket") == F.col("b")).where("root <> main.root")
    return other.groupBy("b").agg(F.first("n_roots").alias("n_roots"), F.max("top").alias("head"), F.first("main").alias("main"))


def _near(low_a: str, high_a: str, low_b: str, high_b: str, threshold: float) -> str:
    return f"({high_a} >= {threshold}D * {low_b} AND {high_b} >= {threshold}D * {low_a})"


def _head_pairs(pending: DataFrame, heads: DataFrame, threshold: float) -> DataFrame:
    return pending.join(heads, F.col("bucket") == F.col("b")).where(
        "root <> head.root AND " + _near("low", "high", "head.low", "head.high", threshold)).select(
        F.col("head.node").alias("a"), F.col("node").alias("b"))


def _all_pairs(pending: DataFrame, heads: DataFrame, sizes: DataFrame, threshold: float) -> DataFrame:
    """Every pair of a bucket's members of different components that may match:
    those outside of its largest component with all others."""
    # the buckets of a node, at most BANDS of each of its texts
    held = pending.groupBy(F.col("node").alias("hn")).agg(F.collect_set("bucket").alias("held"))
    own = pending.join(heads, F.col("bucket") == F.col("b")).join(sizes.select("sn", "bits"), F.col("node") == F.col("sn")).join(
        held, F.col("node") == F.col("hn")).select(
        "bucket", "node", "root", "low", "high", "bits", "held", (F.col("root") == F.col("main.root")).alias("in_main"))
    own = materialize(own, "crossing")
    other = own.where("NOT in_main").select(F.col("bucket").alias("ob"), F.col("node").alias("b"), F.col("root").alias("root_b"),
                                            F.col("low").alias("low_b"), F.col("high").alias("high_b"), F.col("bits").alias("bits_b"), F.col("held").alias("held_b"))
    once = "array_min(array_intersect(held, held_b)) = bucket"  # a pair is made by one of its buckets
    near = " AND ".join(["bucket = ob", "root <> root_b", "(in_main OR node < b)", _near("low", "high", "low_b", "high_b", threshold),
                         _may_match("high", "high_b", "bits", "bits_b", threshold), once])
    return own.join(other, F.expr(near)).select(F.col("node").alias("a"), "b")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, class_id (the smallest id of its group of
    near-duplicates), is_first."""
    base = docs.select(F.col(doc_id).cast("long").alias("d"), F.col(text).alias("text"))
    sketch = materialize(base.select("d", F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("h")).mapInArrow(
        _sketch, "d long, c1 long, c2 long, bands array<long>"), "sketch")
    classes, roots = near_classes(sketch, base.where(F.col("d").isNotNull()), threshold)
    nodes = classes.select(F.col("c1").alias("k1"), F.col("c2").alias("k2"), F.col("node"))
    if roots is not None:
        # also ties ids that hold several texts
        roots = roots.select(F.col("node").alias("rn"), "root")
        nodes = nodes.join(roots, F.col("node") == F.col("rn"), "left").select("k1", "k2", F.coalesce("root", "node").alias("node"))
    out = sketch.join(nodes, (F.col("c1") == F.col("k1")) & (F.col("c2") == F.col("k2")), "left")
    class_id = F.when(F.col("d").isNotNull(), F.coalesce("node", "d"))
    return out.select(F.col("d").alias("doc_id"), class_id.alias("class_id"), (F.col("d") == class_id).alias("is_first"))
