"""Line dedup by pairwise alignment of overlapping documents (operator 2).

Two documents overlap if they share something that the block rule below can
delete: two neighbouring lines, a long line, or the only line of one of them.
Lines are trimmed, blank ones left out, and the j-th repetition of a line in a
document is told apart by j.  Each such key is looked up by its hash, and a
document is paired with the key's first holder, the document with the smallest
id; so a key that n documents share makes n - 1 pairs and not n**2.

Each pair is aligned by patience over all the lines that the two share,
frequent ones included: the shared lines are unique on both sides,
the longest run of matches that ascends in both documents is kept, and
neighbouring matches form blocks.  A block is deleted from the later document
if it has two lines or more, if it is one line of ``LONE_CHARS`` characters or
more, or if it is all of the document; how many documents hold its lines does
not matter, so the rule is the same for every size of the corpus.  A shorter
line that stands alone (a licence line, a greeting) stays.

Where a shared key is not deleted (it crosses a longer run of matches with the
first holder), the document is aligned with every other earlier holder of that
key too.  A deletable block of any pair holds a key, which is either deleted or
leads to that pair: the result is that of aligning all pairs of documents.

Defined cases: null text stays null; a text without lines or shared lines is
unchanged; rows with the same id are never earlier than each other; rows with
a null ``doc_id`` take no part and are returned unchanged; repeated rows are
treated alike and returned as often as they occur; all other columns are kept.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabinlens.llm.common import MULT, SECOND, flat_lists, if_small, list_array, list_slices, materialize, mix

#: Shortest line, in characters, that is deleted where it stands alone.
LONE_CHARS = 100
#: Most short lines that are all of a document whose keys are broadcast.
BROADCAST_KEYS = 1_000_000


def ascending(pairs: list[tuple]) -> list[tuple]:
    """Longest run of (pos, hpos, ...) with both ascending, by patience piles;
    ``pairs`` is sorted by pos, and positions are distinct on each side."""
    tops, at, before = [], [], [-1] * len(pairs)
    for i, p in enumerate(pairs):
        k = bisect_left(tops, p[1])
        before[i] = at[k - 1] if k else -1
        if k == len(tops):
            tops.append(p[1])
            at.append(i)
        else:
            tops[k], at[k] = p[1], i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(pairs[i])
        i = before[i]
    return out[::-1]


def deleted(matches: list[dict], n_lines: int, lone_chars: int = LONE_CHARS) -> list[int]:
    """Raw line numbers to delete from a document, from the matches of its
    lines: pos and hpos (own and holder's line number among non-blank lines),
    raw (own number among all lines), holder, chars."""
    by_holder: dict[int, list[tuple]] = {}
    for m in matches:
        by_holder.setdefault(m["holder"], []).append((m["pos"], m["hpos"], m["raw"], m["chars"]))
    gone = []
    for pairs in by_holder.values():
        block: list[tuple] = []
        for p in [*ascending(sorted(pairs)), None]:
            if block and (p is None or p[0] != block[-1][0] + 1 or p[1] != block[-1][1] + 1):
                if len(block) > 1 or len(block) == n_lines or block[0][3] >= lone_chars:
                    gone += [b[2] for b in block]
                block = []
            if p is not None:
                block.append(p)
    return sorted(gone)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of each line and its repetition number, for the keys and for the
    alignment, and of each two neighbouring lines."""
    for batch in batches:
        for start, stop in list_slices(batch["a"]):
            part = batch.slice(start, stop - start)
            a, offsets = flat_lists(part["a"])
            b, _ = flat_lists(part["b"])
            a, b, sizes = a.view(np.uint64), b.view(np.uint64), np.diff(offsets)
            row = np.repeat(np.arange(len(sizes)), sizes)
            order = np.lexsort((a, row))
            new = np.ones(len(a), bool)
            new[1:] = (row[order][1:] != row[order][:-1]) | (a[order][1:] != a[order][:-1])
            firsts = np.flatnonzero(new)
            j = np.empty(len(a), np.uint64)
            j[order] = np.arange(len(a)) - np.repeat(firsts, np.diff(np.append(firsts, len(a))))
            with np.errstate(over="ignore"):
                one, own = mix(a + j * MULT), mix(b + j * SECOND)
                follow = np.flatnonzero(row[1:] == row[:-1])
                two = mix(mix(one[follow] + SECOND) * MULT + one[follow + 1])
            columns = [part["d"], part["x"], part["raw"], part["chars"], list_array(own.view(np.int64), sizes, pa.int64()),
                       list_array(one.view(np.int64), sizes, pa.int64()), list_array(two.view(np.int64), np.maximum(sizes - 1, 0), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["d", "x", "raw", "chars", "own", "one", "two"])


def _align(lone_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = []
            for own, theirs, raw, chars, holder in zip(*(batch[c].to_pylist() for c in ("own", "theirs", "raw", "chars", "od"))):
                at = {h: i for i, h in enumerate(theirs)}
                match = [{"pos": i, "hpos": at[h], "raw": raw[i], "holder": holder, "chars": chars[i]} for i, h in enumerate(own) if h in at]
                cut.append(deleted(match, len(own), lone_chars))
            yield pa.RecordBatch.from_arrays(
                [batch["d"], batch["x"], pa.array(cut, pa.list_(pa.int32()))], names=["d", "x", "gone"])

    return run


def _keys(index: DataFrame, lone_chars: int) -> DataFrame:
    """(k, asks, d, x, low, high): what may tie a document to an earlier one, and
    the raw numbers of its lines; a short line does not ask for a holder unless
    it is all of the document, and is kept only where it is all of some other."""
    lines = index.select("d", "x", F.size("one").alias("n"), F.inline(F.arrays_zip("one", "raw", "chars")))
    lines = lines.select(F.col("one").alias("k"), (F.col("n").eqNullSafe(1) | (F.col("chars") >= lone_chars)).alias("asks"),
                         "d", "x", F.col("raw").alias("low"), F.col("raw").alias("high"), "chars")
    brief = materialize(lines.where(F.col("asks") & (F.col("chars") < lone_chars)).select(F.col("k").alias("bk")).distinct(), "brief")
    held = lines.where("NOT asks").join(if_small(brief, brief.count(), BROADCAST_KEYS), F.col("k") == F.col("bk"), "left_semi")
    lines = lines.where("asks").unionAll(held).drop("chars")
    runs = index.where("size(two) > 0").select("d", "x", F.inline(F.expr(
        "transform(two, (t, i) -> named_struct('k', t, 'low', raw[i], 'high', raw[i + 1]))")))
    return lines.unionAll(runs.select("k", F.lit(True).alias("asks"), "d", "x", "low", "high"))


def deletions(docs: DataFrame, lone_chars: int = LONE_CHARS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(d, x, gone): for documents that lose lines, their raw line numbers; x is
    the 64-bit hash of the text."""
    base = docs.select(F.col(doc_id).cast("long").alias("d"), F.xxhash64(text).alias("x"), F.split(text, "\n").alias("lines"))
    base = base.where("d IS NOT NULL AND lines IS NOT NULL")
    base = base.select("d", "x", F.expr(
        "filter(transform(lines, (l, i) -> named_struct('raw', i, 'line', trim(l))), l -> l.line <> '')").alias("l"))
    base = base.select("d", "x", F.col("l.raw").alias("raw"), F.expr("transform(l, y -> length(y.line))").alias("chars"),
                       F.expr("transform(l, y -> xxhash64(y.line))").alias("a"), F.expr("transform(l, y -> xxhash64(1, y.line))").alias("b"))
    kinds = ("d long, x long, raw array<int>, chars array<int>, own array<long>, one array<long>, two array<long>")
    index = materialize(base.mapInArrow(_index, kinds).dropDuplicates(["d", "x"]), "lines")

    keys = _keys(index, lone_chars)
    first = keys.groupBy("k").agg(F.min(F.struct("d", "x")).alias("f"), F.max("d").alias("last")).where("f.d < last")
    # written tables: the joins then read two plain shuffles, whose hot keys AQE can split
    first = materialize(first.select(F.col("k").alias("fk"), F.col("f.d").alias("od"), F.col("f.x").alias("ox")), "first")
    shared = materialize(keys.where("asks").join(first.hint("merge"), (F.col("k") == F.col("fk")) & (F.col("d") > F.col("od"))).drop("fk", "asks"), "shared")
    # merge joins at every size: a broadcast would only fit small inputs
    theirs = index.hint("merge").select(F.col("d").alias("hd"), F.col("x").alias("hx"), F.col("own").alias("theirs"))
    mine = index.hint("merge").select(F.col("d").alias("md"), F.col("x").alias("mx"), "raw", "chars", "own")

    def aligned(pairs: DataFrame, name: str) -> DataFrame:
        pairs = materialize(pairs.select("d", "x", "od", "ox").distinct(), name)
        both = pairs.join(theirs, (F.col("od") == F.col("hd")) & (F.col("ox") == F.col("hx")))
        both = both.join(mine, (F.col("d") == F.col("md")) & (F.col("x") == F.col("mx")))
        cut = both.select("d", "x", "od", "raw", "chars", "own", "theirs").mapInArrow(_align(lone_chars), "d long, x long, gone array<int>")
        return materialize(cut.where("size(gone) > 0"), "aligned")

    def union(cut: DataFrame) -> DataFrame:
        return cut.groupBy("d", "x").agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone"))

    cut = aligned(shared, "pairs")
    lost = union(cut).select(F.col("d").alias("ld"), F.col("x").alias("lx"), "gone")
    left = shared.join(lost.hint("merge"), (F.col("d") == F.col("ld")) & (F.col("x") == F.col("lx")), "left")
    left = materialize(left.where("gone IS NULL OR NOT (array_contains(gone, low) AND array_contains(gone, high))").select(
        F.col("k").alias("lk"), "d", "x", F.col("od").alias("fd"), F.col("ox").alias("fx")), "left")
    if left.isEmpty():
        return union(cut)
    holders = keys.select("k", F.col("d").alias("od"), F.col("x").alias("ox"))
    more = left.join(holders, (F.col("lk") == F.col("k")) & (F.col("od") < F.col("d")) & ((F.col("od") != F.col("fd")) | (F.col("ox") != F.col("fx"))))
    return union(cut.unionAll(aligned(more, "more")))


def line_dedup(docs: DataFrame, lone_chars: int = LONE_CHARS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``docs`` with the text cut, and n_lines (non-blank lines
    before) and n_removed behind them."""
    cut = deletions(docs, lone_chars, doc_id, text).select(F.col("d").alias("__d"), F.col("x").alias("__x"), F.col("gone").alias("__gone"))
    names = [c for c in docs.columns if c != text]
    joined = docs.join(cut.hint("merge"), (F.col(doc_id) == F.col("__d")) & F.col(text).isNotNull() & (F.xxhash64(text) == F.col("__x")), "left")
    kept = F.expr(f"transform(array(split(`{text}`, '\\n')), l -> array_join(transform(array_except(sequence(0, size(l) - 1), __gone), "
                  "i -> l[i]), '\\n'))[0]")
    new = F.when(F.col("__gone").isNull(), F.col(text)).otherwise(kept).alias(text)
    n_lines = F.expr(f"coalesce(size(filter(split(`{text}`, '\\n'), x -> trim(x) <> '')), 0)")
    n_lines = F.when(F.col(text).isNull(), 0).otherwise(n_lines).cast("long").alias("n_lines")
    n_removed = F.when(F.col("__gone").isNull(), 0).otherwise(F.size("__gone")).cast("long").alias("n_removed")
    return joined.select(*[F.col(f"`{c}`") if c in names else new for c in docs.columns], n_lines, n_removed)
