"""N-gram Jaccard join of documents (operator 12): connected components of the
links between documents whose sets of ``WORDS``-word shingles are similar.

Documents with equal sets are one class, so copies make no pairs.  A pair of
classes that reaches the threshold is found by prefix filtering, in two exact
steps (sizes x >= y, o = the overlap that the threshold asks for):

* reduced sets: by one order of all n-grams (their hash), the first
  ``size - ceil(threshold * size) + l(size)`` n-grams of each class.  Of a pair's
  ``o`` or more common n-grams at least ``l`` lie in both reduced sets, so only a
  quarter of all n-grams is counted and shuffled;
* rare-first prefix: a reduced set is ordered anew by the n-grams' document
  frequency, counted over all classes, the rarest first, and its last
  ``l - 1`` n-grams are left out: a pair still has a common n-gram in what is
  left, and n-grams of one class only join nothing.

Classes meet on their prefix n-grams.  The length filter compares sizes, the
positional filter what may still be common behind the n-gram's two places, and
the suffix filter a lower bound of the Hamming distance of the two sets (the
differing bits of ``BITS``-bit parities of their n-grams).  A pair that is left
is verified once, by its whole sets.

Only links that join components are needed: in each of ``ROUNDS`` rounds every
class that is not yet in the component of its n-gram's head (the class that
shares most n-grams) is compared with the head; then all pairs of different
components that share a prefix n-gram are compared.  So n near copies make about
n pairs, and no link between components is lost.

Defined cases: null, empty and blank texts have an empty set, are linked with
nothing and are their own component; rows of one ``doc_id`` with different texts
are linked with each other; repeated rows are returned as often as they occur;
a null ``doc_id`` takes no part and has a null component; texts of any length
are read whole; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabinlens.llm.common import MULT, SECOND, if_small, list_array, materialize, mix, ragged, text_slices, window_hashes
from cabinlens.llm.components import components

#: Words of a shingle, and the least similarity in hundredths.
WORDS = 4
PERCENT = 85
#: Bits of the parity sketch of the suffix filter.
BITS = 512
#: Rounds in which each n-gram's classes are compared with one head.
ROUNDS = 2
#: Prefix n-grams of a class by which a pair is told to be made already.
FIRST = 16
#: Most classes (24 bytes each) that are broadcast to pick their texts.
BROADCAST_CLASSES = 500_000

SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): a 64-bit hash of every word of each text, on its UTF-8
    bytes; A-Z count as a-z, words end at ASCII white space."""
    held = pc.fill_null(texts, "").cast(pa.large_binary())
    offsets = np.frombuffer(held.buffers()[1], np.int64)[held.offset:held.offset + len(held) + 1]
    n = int(offsets[-1] - offsets[0])
    if not n:
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(held.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    solid = np.zeros(n + 2, bool)
    solid[1:-1] = ~SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(solid[1:-1] & (~solid[:-2] | edge[:-1]))
    ends = np.flatnonzero(solid[1:-1] & (~solid[2:] | edge[1:])) + 1
    with np.errstate(over="ignore"):
        value = mix((LOWER[:, None].astype(np.uint64) + np.uint64(1)) * MULT).ravel()[data]
        powers = np.ones(n, np.uint64)
        powers[1:] = SECOND
        np.multiply.accumulate(powers, out=powers)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(value * powers, out=sums[1:])
        back = np.ones(n, np.uint64)
        back[1:] = np.uint64(pow(int(SECOND), -1, 1 << 64))
        np.multiply.accumulate(back, out=back)
        hashes = mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64) * MULT)
    return hashes, np.searchsorted(starts, offsets)


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): the sorted distinct shingles of each text."""
    values, offsets = word_hashes(texts)
    sizes = np.diff(offsets)
    counts = np.where(sizes >= words, sizes - words + 1, np.minimum(sizes, 1))
    padded = np.concatenate([values, np.zeros(words, np.uint64)])
    hashes = window_hashes(padded, words)[ragged(offsets[:-1], counts)]
    at = np.cumsum(counts) - counts
    for row in np.flatnonzero((sizes > 0) & (sizes < words)):
        hashes[at[row]] = window_hashes(values[offsets[row]:offsets[row + 1]], sizes[row])[0] ^ MULT
    row = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.append(True, (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1]))[:len(hashes)]
    return hashes[new], np.append(0, np.cumsum(np.bincount(row[new], minlength=len(counts))))


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(values, out=total[1:])
        return total[offsets[1:]] - total[offsets[:-1]]


def parities(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(rows, BITS / 64): bit i of a row is the parity of its n-grams in bucket i."""
    rows = len(offsets) - 1
    cell = np.repeat(np.arange(rows), np.diff(offsets)) * BITS + (mix(hashes ^ SECOND) % np.uint64(BITS)).astype(np.int64)
    odd = (np.bincount(cell, minlength=rows * BITS) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64).reshape(rows, BITS // 64)


def least_share(size: np.ndarray, percent: int) -> np.ndarray:
    """Common n-grams that a set of ``size`` has with any that it links to."""
    return -(-percent * size // 100)


def kept_overlap(size: np.ndarray) -> np.ndarray:
    """l(size): common n-grams that are asked for in reduced sets."""
    return np.maximum(1, size // 10)


def reduced(size: np.ndarray, percent: int) -> np.ndarray:
    return size - least_share(size, percent) + kept_overlap(size)


def _sketch(words: int, percent: int):
    """(d, x, c1, c2, size, low, bits) of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in text_slices(batch["text"], 1 << 18):
                part = batch.slice(start, stop - start)
                hashes, offsets = shingle_sets(part["text"], words)
                size = np.diff(offsets)
                with np.errstate(over="ignore"):
                    classes = [_sums(mix(hashes ^ MULT), offsets), _sums(mix(hashes + SECOND), offsets)]
                some = np.where(size > 0, reduced(size, percent), 0)
                low = hashes[ragged(offsets[:-1], some)].view(np.int64)
                bits = parities(hashes, offsets)
                yield pa.RecordBatch.from_arrays(
                    [part["d"], part["x"], *[pa.array(c.view(np.int64), mask=size == 0) for c in classes], pa.array(size, pa.int64()),
                     list_array(low, some, pa.int64()), list_array(bits.ravel(), np.full(len(size), BITS // 64), pa.int64())],
                    names=["d", "x", "c1", "c2", "size", "low", "bits"])

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in text_slices(batch["text"], 1 << 18):
                part = batch.slice(start, stop - start)
                hashes, offsets = shingle_sets(part["text"], words)
                yield pa.RecordBatch.from_arrays(
                    [part["node"], list_array(hashes.view(np.int64), np.diff(offsets), pa.int64())], names=["node", "sh"])

    return run


def _least(size: str, percent: int) -> str:
    return f"CAST(ceil({percent} * {size} / 100) AS BIGINT)"


def _kept(size: str) -> str:
    return f"greatest(1, {size} DIV 10)"


def _length(a: str, b: str, percent: int) -> str:
    return f"(100 * least({a}, {b}) >= {percent} * greatest({a}, {b}))"


def _position(a: str, b: str, at_a: str, at_b: str, percent: int) -> str:
    """What may be common from the n-gram on, at these places of the reduced sets."""
    def behind(size: str, at: str) -> str:
        return f"({size} - {_least(size, percent)} + {_kept(size)} - {at})"

    return f"(least({behind(a, at_a)}, {behind(b, at_b)}) >= least({_kept(a)}, {_kept(b)}))"


def _overlap(a: str, b: str, percent: int) -> str:
    """Common n-grams that sets of these sizes need."""
    return f"CAST(ceil({percent} * ({a} + {b}) / {100 + percent}) AS BIGINT)"


def _suffix(a: str, b: str, bits_a: str, bits_b: str, percent: int) -> str:
    differ = " + ".join(f"bit_count({bits_a}[{i}] ^ {bits_b}[{i}])" for i in range(BITS // 64))
    return f"({differ} <= {a} + {b} - 2 * {_overlap(a, b, percent)})"


def prefixes(classes: DataFrame, percent: int) -> DataFrame:
    """(node, gram, at, size): the rare-first prefix n-grams that two classes or
    more hold in their reduced sets, and their places there."""
    grams = classes.select("node", "size", F.explode("low").alias("gram"))
    df = grams.groupBy("gram").agg(F.count("*").alias("df")).where("df > 1").select(F.col("gram").alias("g"), "df")
    shared = grams.join(df, F.col("gram") == F.col("g")).groupBy("node", "size").agg(
        F.sort_array(F.collect_list(F.struct("df", "gram"))).alias("own"))
    # the n-grams of one class come first: they take places, and join nothing
    count = f"(size - {_least('size', percent)} + {_kept('size')})"
    length = f"({count} - {_kept(_least('size', percent))} + 1)"
    alone = f"({count} - size(own))"
    kept = shared.withColumn("alone", F.expr(alone)).where(F.expr(f"{length} > alone")).select(
        "node", "size", "alone", F.posexplode(F.expr(f"slice(own, 1, CAST({length} - alone AS INT))")).alias("i", "one"))
    return kept.select("node", F.col("one.gram").alias("gram"), (F.col("alone") + F.col("i")).alias("at"), "size")


def links(classes: DataFrame, base: DataFrame, ties: DataFrame, words: int, percent: int) -> DataFrame:
    """(node, root) of the classes that have links; ``ties`` are links (a, b) given."""
    held = materialize(prefixes(classes, percent), "prefixes")
    # two classes of comparable sizes must hold an n-gram
    range_ = held.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select(F.col("gram").alias("g"))
    pending = held.join(range_, F.col("gram") == F.col("g"), "left_semi")
    weight = pending.groupBy(F.col("node").alias("wn")).agg(F.count("*").alias("w"))
    pending = materialize(pending.join(weight, F.col("node") == F.col("wn")).select(
        "gram", "node", F.col("node").alias("root"), "w", "at", "size"), "grams")
    nodes = materialize(pending.select("node").distinct(), "nodes")
    chosen = classes.join(nodes, "node", "left_semi").select("node", "size", "bits", F.col("d").alias("cd"), F.col("x").alias("cx"))
    chosen = materialize(chosen, "chosen")
    of_class = if_small(chosen.select("node", "cd", "cx"), chosen.count(), BROADCAST_CLASSES)
    texts = base.join(of_class, (F.col("d") == F.col("cd")) & (F.col("x") == F.col("cx"))).select("node", "text")
    sets = materialize(texts.mapInArrow(_sets(words), "node long, sh array<long>").dropDuplicates(["node"]), "sets")
    bits = [chosen.select(F.col("node").alias(f"k{s}"), F.col("size").alias(f"size_{s}"), F.col("bits").alias(f"bits_{s}")) for s in "ab"]
    whole = [sets.select(F.col("node").alias(f"n{s}"), F.col("sh").alias(f"sh_{s}")) for s in "ab"]

    found, tested, turn = [ties], None, 0
    while True:
        tops = materialize(_tops(pending, turn), "tops")
        last = turn >= ROUNDS
        pairs = _all_pairs(pending, tops, chosen, percent) if last else _head_pairs(pending, tops, percent)
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs")
        if not last and pairs.isEmpty():
            turn = ROUNDS
            continue
        near = pairs.join(bits[0], F.col("a") == F.col("ka")).join(bits[1], F.col("b") == F.col("kb")).where(
            F.expr(_suffix("size_a", "size_b", "bits_a", "bits_b", percent))).select("a", "b")
        both = near.join(whole[0], F.col("a") == F.col("na")).join(whole[1], F.col("b") == F.col("nb"))
        common = "size(array_intersect(sh_a, sh_b))"
        linked = both.where(F.expr(f"100 * {common} >= {percent} * (size(sh_a) + size(sh_b) - {common})")).select("a", "b")
        found.append(materialize(linked, "links"))
        roots = materialize(components(reduce(DataFrame.unionAll, found)), "roots")
        if last:
            return roots
        turn += 1
        tested = pairs if tested is None else tested.unionAll(pairs)
        moved = pending.drop("root").join(roots.select(F.col("node").alias("rn"), F.col("root")), F.col("node") == F.col("rn"), "left")
        pending = materialize(moved.select("gram", "node", F.coalesce("root", "node").alias("root"), "w", "at", "size"), "grams")


def _tops(pending: DataFrame, turn: int) -> DataFrame:
    """N-grams whose classes are of several components: their largest component,
    and their head: the class that shares most n-grams, after the first round
    one outside of that component (a second group of near copies)."""
    per_root = pending.groupBy("gram", "root").agg(
        F.count("*").alias("c"), F.max(F.struct("w", F.negative("node").alias("last"), "node", "root", "at", "size")).alias("top"))
    tops = per_root.groupBy(F.col("gram").alias("g")).agg(
        F.count("*").alias("n_roots"), F.max("top").alias("head"), F.max(F.struct("c", "root")).alias("main")).where("n_roots > 1")
    if not turn:
        return tops
    other = per_root.join(tops.drop("head"), F.col("gram") == F.col("g")).where("root <> main.root")
    return other.groupBy("g").agg(F.first("n_roots").alias("n_roots"), F.max("top").alias("head"), F.first("main").alias("main"))


def _head_pairs(pending: DataFrame, tops: DataFrame, percent: int) -> DataFrame:
    near = _length("size", "head.size", percent) + " AND " + _position("size", "head.size", "at", "head.at", percent)
    return pending.join(tops, F.col("gram") == F.col("g")).where("root <> head.root AND " + near).select(
        F.col("head.node").alias("a"), F.col("node").alias("b"))


def _all_pairs(pending: DataFrame, tops: DataFrame, chosen: DataFrame, percent: int) -> DataFrame:
    """Every pair of classes in different components that share a prefix n-gram:
    those outside of the n-gram's largest component with all others."""
    bits = chosen.select(F.col("node").alias("bn"), "bits")
    first = pending.groupBy(F.col("node").alias("fn")).agg(F.sort_array(F.collect_list(F.struct("at", "gram"))).alias("own"))
    bits = bits.join(first.select("fn", F.expr(f"transform(slice(own, 1, {FIRST}), x -> x.gram)").alias("first")), F.col("bn") == F.col("fn"))
    own = pending.join(tops, F.col("gram") == F.col("g")).join(bits, F.col("node") == F.col("bn")).select(
        "gram", "node", "root", "at", "size", "bits", "first", (F.col("root") == F.col("main.root")).alias("in_main"))
    own = materialize(own, "crossing")
    other = own.where("NOT in_main").select(
        F.col("gram").alias("g"), F.col("node").alias("b"), F.col("root").alias("root_b"), F.col("at").alias("at_b"),
        F.col("size").alias("size_b"), F.col("bits").alias("bits_b"), F.col("first").alias("first_b"))
    # a pair is made once, by the rarest n-gram that both hold (as far as the first ones tell)
    once = "coalesce(try_element_at(array_intersect(first, first_b), 1), gram) = gram"
    near = " AND ".join(["gram = g", "root <> root_b", "(in_main OR node < b)", _length("size", "size_b", percent),
                         _position("size", "size_b", "at", "at_b", percent), _suffix("size", "size_b", "bits", "bits_b", percent), once])
    return own.join(other, F.expr(near)).select(F.col("node").alias("a"), "b")


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id."""
    base = docs.select(F.col(doc_id).cast("long").alias("d"), F.xxhash64(text).alias("x"), F.col(text).alias("text"))
    kinds = "d long, x long, c1 long, c2 long, size long, low array<long>, bits array<long>"
    sketch = materialize(base.mapInArrow(_sketch(words, percent), kinds), "sketch")
    known = sketch.where("d IS NOT NULL AND size > 0")
    first = known.groupBy("c1", "c2").agg(
        F.min(F.struct("d", "x")).alias("f"), F.first("size").alias("size"), F.first("low").alias("low"), F.first("bits").alias("bits"))
    classes = materialize(first.select(
        F.monotonically_increasing_id().alias("node"), "c1", "c2", F.col("f.d").alias("d"), F.col("f.x").alias("x"), "size", "low", "bits"), "classes")
    named = classes.select(F.col("c1").alias("k1"), F.col("c2").alias("k2"), "node", F.col("d").alias("first"))
    rows = materialize(sketch.select("d", "c1", "c2", "size").join(
        named, (F.col("c1") == F.col("k1")) & (F.col("c2") == F.col("k2")) & F.col("d").isNotNull(), "left").select("d", "size", "node", "first"), "rows")
    # ids that hold several texts tie their classes
    own = rows.where("node IS NOT NULL").select("d", "node").distinct()
    least = own.groupBy(F.col("d").alias("t")).agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a < z")
    ties = materialize(own.join(least, F.col("d") == F.col("t")).where("node <> a").select("a", F.col("node").alias("b")), "ties")
    roots = links(classes, base.where(F.col("d").isNotNull()), ties, words, percent)
    of = classes.select("node", "d").join(roots, "node").groupBy("root").agg(F.min("d").alias("component"))
    of = roots.join(of, "root").select(F.col("node").alias("rn"), "component")
    out = rows.join(of, F.col("node") == F.col("rn"), "left")
    component = F.when(F.col("d").isNotNull(), F.coalesce("component", "first", "d"))
    return out.select(F.col("d").alias("doc_id"), F.col("size").alias("n_shingles"), component.alias("component_id"))
