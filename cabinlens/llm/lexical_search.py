"""Ranked lexical search of documents for a table of items (operator 11).

A term is a run of ASCII letters and digits and of all other characters beyond
ASCII, with A-Z lower-cased.  A document's score for an item is the sum, over
the item's terms with repeats, of the term's weight times the term's impact in
the document (see ``weight`` and ``impacts``); only whole numbers are added.

The documents' occurrences of the items' terms are written once.  A task reads
them in blocks of about ``BLOCK_POSTINGS`` postings.  In a block every term has
a posting list in the order of ``doc_id`` and a range-maximum sparse table over
its impacts.  All items search the block together, best first: an interval of
documents is bounded by the sum of its terms' range maxima; the best intervals
of each item are split at the document of maximum impact of the term that adds
most, that document is scored exactly, and the two halves are bounded anew by
the lists' parts that lie in them.  An interval whose bound cannot enter the
item's best ``k`` is dropped, so the result is exact.  The best ``k`` of a task
carry over from block to block, and the tasks' few rows are ranked at the end.

Items are taken in parts of about ``PART_TERMS`` terms, each a bounded
broadcast; every part meets all documents (a stated query set against all rows).

Defined cases: a null or empty text has no terms and is no document of the
counts; rows with a null ``doc_id`` take no part; repeated rows are documents of
their own and fill ranks of their own; equal items (same id, same text) count
once, items with the same id and other texts are ranked together row by row; a
null item id is a value like any other; items without terms or without a
document return no row; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cabinlens.llm.common import flat_lists, list_array, materialize, ragged, text_slices

TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Postings and documents of a block; a block ends with a whole document.
BLOCK_POSTINGS = 1 << 18
BLOCK_DOCS = 1 << 14
#: Terms of a part of the items, with repeats.
PART_TERMS = 200_000
#: Intervals of an item that are split in one step.
WIDTH = 16


def terms(text: str | None) -> list[bytes]:
    """Terms of a text; lower() of bytes touches A-Z only."""
    return TERM.findall((text or "").encode("utf-8", "surrogatepass").lower())


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, sizes: np.ndarray, totals: tuple[int, int]) -> np.ndarray:
    """Whole-number impact of each occurrence count; a document of ``n`` terms
    has ``sizes`` of them."""
    lengths, of = np.unique(n, return_inverse=True)
    m = np.array([25 + (75 * x * totals[0]) // totals[1] for x in lengths.tolist()], np.int64)[of]
    return (1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, sizes))


class Items:
    """Items of one part: for each its distinct terms, how often it holds them,
    and the terms' places in the part's vocabulary."""

    def __init__(self, texts: list[str | None]):
        bags = [Counter(terms(t)) for t in texts]
        self.vocabulary = {t: i for i, t in enumerate(sorted({t for b in bags for t in b}))}
        self.sizes = np.array([len(b) for b in bags], np.int64)
        self.term = np.array([self.vocabulary[t] for b in bags for t in b], np.int64)
        self.times = np.array([c for b in bags for c in b.values()], np.int64)


class Block:
    """Posting lists of a block of documents with their sparse tables.  ``term``
    and ``doc`` (its place in the order of ids) are sorted by term, then doc."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, n_docs: int):
        self.n_docs, self.impact = n_docs, impact
        self.doc = doc
        self.key = term * n_docs + doc
        self.tables = [np.arange(len(impact), dtype=np.int32)]
        step, longest = 1, int(np.bincount(term).max(initial=0))
        while 2 * step <= longest:
            a, b = self.tables[-1][:-step], self.tables[-1][step:]
            self.tables.append(np.where(impact[b] > impact[a], b, a))
            step *= 2
        width = len(impact)
        self.flat = np.concatenate([np.append(t, np.zeros(width - len(t), np.int32)) for t in self.tables])
        self.width = width

    def largest(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Position of the first maximum in each non-empty range [a, b)."""
        level = np.frexp((b - a).astype(np.float64))[1] - 1
        left = self.flat[level * self.width + a]
        right = self.flat[level * self.width + b - (1 << level)]
        return np.where(self.impact[right] > self.impact[left], right, left).astype(np.int64)

    def find(self, term: np.ndarray, doc: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.key, term * self.n_docs + doc)


class Best:
    """The best ``k`` (score, id) of each item so far."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.item, self.score, self.id = (np.empty(0, np.int64) for _ in range(3))
        self.least, self.last = np.zeros(items, np.int64), np.full(items, np.iinfo(np.int64).max)

    def add(self, item: np.ndarray, score: np.ndarray, id_: np.ndarray) -> None:
        some = score > 0
        item, score, id_ = (np.concatenate([x, y[some]]) for x, y in ((self.item, item), (self.score, score), (self.id, id_)))
        order = np.lexsort((id_, -score, item))
        item = item[order]
        firsts = np.flatnonzero(np.append(True, item[1:] != item[:-1])) if len(item) else np.empty(0, np.int64)
        place = np.arange(len(item)) - np.repeat(firsts, np.diff(np.append(firsts, len(item))))
        kept = place < self.k
        self.item, self.score, self.id = item[kept], score[order][kept], id_[order][kept]
        full = place[kept] == self.k - 1
        self.least[self.item[full]], self.last[self.item[full]] = self.score[full], self.id[full]

    def open(self, item: np.ndarray, bound: np.ndarray, first_id: np.ndarray) -> np.ndarray:
        """Whether a document of that bound, with no smaller id, can still enter."""
        least = self.least[item]
        return (bound > least) | ((bound == least) & (bound > 0) & (first_id < self.last[item]))


def _bounded(block: Block, owner: np.ndarray, a: np.ndarray, b: np.ndarray, gain: np.ndarray, n: int):
    """(bound, split document) of ``n`` intervals from their terms' ranges,
    sorted by owner; each interval has one at least."""
    at = block.largest(a, b)
    part = gain * block.impact[at]
    starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    bound = np.add.reduceat(part, starts)
    most = np.maximum.reduceat(part, starts)
    top = np.flatnonzero(part == np.repeat(most, np.diff(np.append(starts, len(owner)))))
    first = top[np.append(True, owner[top[1:]] != owner[top[:-1]])]
    return bound, block.doc[at[first]]


def search(block: Block, ids: np.ndarray, items: Items, weights: np.ndarray, best: Best) -> None:
    """All items over one block; ``ids`` are the documents' ids in their order."""
    n_items = len(items.sizes)
    owner = np.repeat(np.arange(n_items), items.sizes)
    term, gain = items.term, items.times * weights[items.term]
    a = block.find(term, np.zeros(len(term), np.int64))
    b = block.find(term, np.full(len(term), block.n_docs, np.int64))
    some = (b > a) & (gain > 0)
    owner, term, gain, a, b = owner[some], term[some], gain[some], a[some], b[some]
    if not len(owner):
        return
    item, of = np.unique(owner, return_inverse=True)
    low, high = np.zeros(len(item), np.int64), np.full(len(item), block.n_docs, np.int64)
    bound, split = _bounded(block, of, a, b, gain, len(item))
    size = np.bincount(of)
    # intervals: item, low, high, bound, split and the slice [start, start + size) of their terms' ranges
    start = np.cumsum(size) - size
    while True:
        live = best.open(item, bound, ids[low])
        item, low, high, bound, split, start, size = (x[live] for x in (item, low, high, bound, split, start, size))
        if not len(item):
            return
        order = np.lexsort((low, -bound, item))
        own = item[order]
        firsts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        place = np.arange(len(own)) - np.repeat(firsts, np.diff(np.append(firsts, len(own))))
        chosen = np.sort(order[place < WIDTH])
        rest = np.ones(len(item), bool)
        rest[chosen] = False
        at = ragged(start[chosen], size[chosen])
        who = np.repeat(np.arange(len(chosen)), size[chosen])
        doc = split[chosen][who]
        pos = block.find(term[at], doc)
        found = (pos < b[at]) & (block.doc[np.minimum(pos, len(block.doc) - 1)] == doc)
        score = np.zeros(len(chosen), np.int64)
        np.add.at(score, who[found], gain[at][found] * block.impact[pos[found]])
        best.add(item[chosen], score, ids[split[chosen]])
        # both halves: the terms' ranges left and right of the split document
        halves = [(who * 2, a[at], pos), (who * 2 + 1, pos + found, b[at])]
        o, x, y = (np.concatenate(c) for c in zip(*halves))
        t, g = np.tile(term[at], 2), np.tile(gain[at], 2)
        keep = y > x
        o, x, y, t, g = o[keep], x[keep], y[keep], t[keep], g[keep]
        order = np.argsort(o, kind="stable")
        o, x, y, t, g = o[order], x[order], y[order], t[order], g[order]
        old = ragged(start[rest], size[rest])
        if len(o):
            names, of = np.unique(o, return_inverse=True)
            new_bound, new_split = _bounded(block, of, x, y, g, len(names))
            parent, right = chosen[names // 2], names % 2 == 1
            new_low = np.where(right, split[parent] + 1, low[parent])
            new_high = np.where(right, high[parent], split[parent])
            new_item, new_size = item[parent], np.bincount(of)
        else:
            new_bound = new_split = new_low = new_high = new_item = new_size = np.empty(0, np.int64)
        term, gain, a, b = (np.concatenate([p[old], q]) for p, q in ((term, t), (gain, g), (a, x), (b, y)))
        item, low, high, bound, split, size = (np.concatenate([p[rest], q]) for p, q in (
            (item, new_item), (low, new_low), (high, new_high), (bound, new_bound), (split, new_split), (size, new_size)))
        start = np.cumsum(size) - size


def _count(shared):
    """(d, n, term, tf): each document's terms that items hold, with counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Items(shared.value[1]).vocabulary
        for batch in batches:
            for start, stop in text_slices(batch["text"]):
                part = batch.slice(start, stop - start)
                n, sizes, term, tf = [], [], [], []
                for text in part["text"]:
                    found = terms(text.as_py())
                    bag = Counter(vocabulary[w] for w in found if w in vocabulary)
                    n.append(len(found))
                    sizes.append(len(bag))
                    term += bag.keys()
                    tf += bag.values()
                sizes = np.array(sizes, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part["d"], pa.array(n, pa.int64()), list_array(np.array(term, np.int32), sizes, pa.int32()),
                     list_array(np.array(tf, np.int32), sizes, pa.int32())], names=["d", "n", "term", "tf"])

    return run


def _blocks(batches: Iterator[pa.RecordBatch], postings: int, docs: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(ids, n, sizes, term, tf) of blocks of whole documents."""
    held: list[tuple[np.ndarray, ...]] = []
    count = rows = 0
    for batch in batches:
        ids, n = (batch[c].to_numpy(zero_copy_only=False) for c in ("d", "n"))
        term, offsets = flat_lists(batch["term"])
        tf, _ = flat_lists(batch["tf"])
        at = 0
        while at < len(ids):
            stop = int(np.searchsorted(offsets, offsets[at] + postings - count, side="right")) - 1
            stop = min(max(stop, at + 1 if not rows else at), at + docs - rows, len(ids))
            span = slice(offsets[at], offsets[stop])
            held.append((ids[at:stop], n[at:stop], np.diff(offsets[at:stop + 1]), term[span], tf[span]))
            count, rows = count + int(offsets[stop] - offsets[at]), rows + stop - at
            if stop < len(ids) or rows >= docs:
                yield tuple(np.concatenate(x) for x in zip(*held))
                held, count, rows = [], 0, 0
            at = stop
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held))


def _search(shared, totals: tuple[int, int], df: dict[int, int], k: int, postings: int, docs: int):
    """(item, doc_id, score): a task's best of each item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, items = shared.value[0], Items(shared.value[1])
        weights = np.array([weight(totals[0], df.get(i, 0)) for i in range(len(items.vocabulary))], np.int64)
        best = Best(len(items.sizes), k)
        for ids, n, sizes, term, tf in _blocks(batches, postings, docs):
            by_id = np.argsort(ids, kind="stable")
            place = np.empty(len(ids), np.int64)
            place[by_id] = np.arange(len(ids))
            doc = np.repeat(place, sizes)
            impact = impacts(tf.astype(np.int64), n, sizes, totals)
            order = np.lexsort((doc, term))
            if len(order):
                search(Block(term[order].astype(np.int64), doc[order], impact[order], len(ids)), ids[by_id], items, weights, best)
        yield pa.RecordBatch.from_arrays(
            [names.take(pa.array(best.item)), pa.array(best.item), pa.array(best.id), pa.array(best.score)],
            names=["item_id", "item", "doc_id", "score"])

    return run


def _parts(items: DataFrame, part_terms: int) -> Iterator[list]:
    """The items in parts of bounded size, one at a time on the driver."""
    own = items.select("item_id", "text").distinct().withColumn("w", F.length(F.coalesce("text", F.lit(""))) / 4 + 1)
    total = own.agg(F.sum("w")).first()[0] or 0
    parts = max(1, math.ceil(total / part_terms))
    for i in range(parts):
        rows = own.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == i).select("item_id", "text").collect()
        if rows:
            yield rows


def rank(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
         item_text: str = "text", part_terms: int = PART_TERMS, block_postings: int = BLOCK_POSTINGS,
         block_docs: int = BLOCK_DOCS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item."""
    spark = docs.sparkSession
    own = docs.select(F.col(doc_id).cast("long").alias("d"), F.col(text).alias("text")).where("d IS NOT NULL")
    asked = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text"))
    kind = asked.schema["item_id"].dataType.simpleString()
    found = []
    for rows in _parts(asked, part_terms):
        names = pa.array([r.item_id for r in rows])
        shared = spark.sparkContext.broadcast((names, [r.text for r in rows]))
        counted = materialize(own.mapInArrow(_count(shared), "d long, n long, term array<int>, tf array<int>"), "terms")
        total = counted.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
        # one row a term of the part
        df = dict(counted.select(F.explode("term").alias("t")).groupBy("t").count().collect())
        if df:
            found.append(counted.where("size(term) > 0").mapInArrow(
                _search(shared, (total[0], total[1]), df, k, block_postings, block_docs),
                f"item_id {kind}, item long, doc_id long, score long").withColumn("part", F.lit(len(found))))
    if not found:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    order = Window.partitionBy("part", "item").orderBy(F.col("score").desc(), "doc_id")
    ranked = reduce(DataFrame.unionAll, found).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
