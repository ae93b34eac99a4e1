"""Removal of repeated word passages by difference-cover anchors (operator 9).

Every word covered by a window of ``WINDOW`` words whose sequence also starts
in a document with a smaller id is removed.  Hashing every window of a corpus
would shuffle one row a word.  Instead runs of ``ANCHOR`` words are hashed only
at positions whose remainder modulo ``PERIOD`` is in a difference cover: for
any two positions some shift below ``PERIOD`` brings both onto the cover, so
two equal windows always share an aligned anchor run inside them.  Anchors that
occur in two different texts are extended to the windows around them; only
those windows are hashed (128 bits) and compared, by a grouping with the
smallest id per window, so no pairs are made and a passage that a third of all
documents hold is one group with map-side minima.

Equal texts are one class: the first document stands for it, and later copies
lose all words that a window covers (all of them from ``WINDOW`` words on).

Defined cases: null and empty text have no words; a null ``doc_id`` is neither
earlier nor later than another, its row is returned unchanged; rows with the
same id do not remove each other's words; repeated rows are returned as often
as they occur; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabinlens.llm.common import (
    SECOND, flat_lists, if_small, list_slices, materialize, ragged, window_hashes,
)

WINDOW = 50
PERIOD = 31
#: A perfect difference set: every remainder modulo 31 is a difference of two members.
COVER = (1, 5, 11, 24, 25, 27)
ANCHOR = WINDOW - PERIOD + 1
SPACE = r"[\x20\x09-\x0D]+"
#: Most candidate texts (16 bytes each) whose keys are broadcast to skip a shuffle of all texts.
BROADCAST_KEYS = 1_000_000


def words(text: Column) -> Column:
    return F.coalesce(F.array_remove(F.split(text, SPACE), ""), F.array().cast("array<string>"))


def _word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _inside(offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(flat start, row, position in row) of all runs of ``length`` that stay in their row."""
    sizes = np.maximum(np.diff(offsets) - length + 1, 0)
    flat = ragged(offsets[:-1], sizes)
    row = np.repeat(np.arange(len(sizes)), sizes)
    return flat, row, flat - offsets[row]


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cover = np.zeros(PERIOD, bool)
    cover[list(COVER)] = True
    for batch in batches:
        for a, b in list_slices(batch["h"]):
            part = batch.slice(a, b - a)
            values, offsets = flat_lists(part["h"])
            flat, row, pos = _inside(offsets, ANCHOR)
            keep = cover[pos % PERIOD] & (np.diff(offsets)[row] >= WINDOW)
            flat, row, pos = flat[keep], row[keep], pos[keep]
            hashes = window_hashes(values.view(np.uint64), ANCHOR)
            th = part["th"].to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes[flat].view(np.int64)), pa.array(th[row]), pa.array(pos.astype(np.int32))],
                names=["a", "th", "p"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows around the anchors of each text: two 64-bit hashes and the start."""
    for batch in batches:
        for a, b in list_slices(batch["h"]):
            part = batch.slice(a, b - a)
            values, offsets = flat_lists(part["h"])
            at, at_offsets = flat_lists(part["at"])
            sizes = np.diff(offsets)
            row = np.repeat(np.arange(len(sizes)), np.diff(at_offsets))
            low = np.maximum(at - PERIOD + 1, 0) + offsets[row]
            high = np.minimum(at, sizes[row] - WINDOW) + offsets[row] + 1
            marks = np.zeros(len(values) + 1, np.int32)
            ok = high > low
            np.add.at(marks, low[ok], 1)
            np.add.at(marks, high[ok], -1)
            flat = np.flatnonzero(np.cumsum(marks[:-1]) > 0)
            row = np.searchsorted(offsets, flat, side="right") - 1
            unsigned = values.view(np.uint64)
            one, two = window_hashes(unsigned, WINDOW), window_hashes(unsigned, WINDOW, SECOND)
            cols = [part[c].to_numpy(zero_copy_only=False)[row] for c in ("d", "th")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(one[flat].view(np.int64)), pa.array(two[flat].view(np.int64)), pa.array(cols[0]),
                 pa.array(cols[1]), pa.array((flat - offsets[row]).astype(np.int32))],
                names=["h1", "h2", "d", "th", "s"])


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of a text outside of its removed windows."""
    split = re.compile(SPACE).split
    for batch in batches:
        texts, removed = [], []
        for text, starts in zip(batch["text"].to_pylist(), batch["starts"].to_pylist()):
            own = [w for w in split(text) if w]
            marks = np.zeros(len(own) + 1, np.int32)
            at = np.array(starts, np.int64)
            np.add.at(marks, at, 1)
            np.add.at(marks, np.minimum(at + WINDOW, len(own)), -1)
            gone = np.cumsum(marks[:-1]) > 0
            removed.append(int(gone.sum()))
            texts.append(" ".join([w for w, g in zip(own, gone) if not g]))
        yield pa.RecordBatch.from_arrays(
            [batch["md"], batch["d"], pa.array(removed, pa.int64()), pa.array(texts, pa.string())],
            names=["md", "d", "n_removed", "kept"])


def removed_windows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(classes, candidates): per text its first id (md, first_id); per first
    document with removed words (md, d, n_removed, kept text)."""
    base = docs.select(F.col(doc_id).cast("long").alias("d"), F.col(text).alias("text"))
    base = base.where(F.col("d").isNotNull() & F.col("text").isNotNull())
    base = base.withColumn("md", F.md5("text")).withColumn("th", F.xxhash64("text"))
    classes = base.groupBy("md").agg(F.min("d").alias("first_id"), F.min("th").alias("th"))

    anchors = base.select("th", _word_hashes(F.col("text")).alias("h")).mapInArrow(_anchors, "a long, th long, p int")
    # written tables: the joins then read two plain shuffles, whose hot keys AQE can split
    shared = materialize(anchors.groupBy("a").agg(F.min("th").alias("lo"), F.max("th").alias("hi"))
                         .where("lo < hi").select(F.col("a").alias("sa")), "shared")
    positions = (anchors.join(shared, F.col("a") == F.col("sa"), "left_semi")
                 .groupBy("th").agg(F.collect_set("p").alias("at")))
    hit = materialize(positions.join(classes, "th").select("md", F.col("first_id").alias("d"), "at"), "anchors")

    wanted = hit.select(F.col("md").alias("k_md"), F.col("d").alias("k_d"))
    texts = base.join(if_small(wanted, hit.count(), BROADCAST_KEYS),
                      (F.col("md") == F.col("k_md")) & (F.col("d") == F.col("k_d")), "left_semi")
    own = materialize(texts.join(hit, ["md", "d"]).select("md", "d", "th", "text", "at"), "candidates")

    wins = own.select("d", "th", "at", _word_hashes(F.col("text")).alias("h")).mapInArrow(
        _windows, "h1 long, h2 long, d long, th long, s int")
    first = materialize(wins.groupBy("h1", "h2").agg(F.min("d").alias("first_d"), F.max("d").alias("last_d"))
                        .where("first_d < last_d").select(F.col("h1").alias("f1"), F.col("h2").alias("f2"), "first_d"), "first")
    later = wins.join(first, (F.col("h1") == F.col("f1")) & (F.col("h2") == F.col("f2")) & (F.col("d") > F.col("first_d")))
    starts = later.groupBy("d", "th").agg(F.collect_set("s").alias("starts"))
    kept = own.join(starts, ["d", "th"]).dropDuplicates(["md", "d"]).select("md", "d", "text", "starts").mapInArrow(
        _kept, "md string, d long, n_removed long, kept string")
    return classes, kept


def substring_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256."""
    classes, kept = removed_windows(docs, doc_id, text)
    own = words(F.col(text))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.md5(text).alias("md"), F.size(own).cast("long").alias("n_words"),
                       F.sha2(F.array_join(own, " "), 256).alias("full"))
    firsts = classes.select(F.col("md").alias("c_md"), "first_id").join(
        kept.select(F.col("md").alias("k_md"), F.col("d").alias("k_d"), F.col("n_removed").alias("cut"),
                    F.sha2("kept", 256).alias("cut_sha")),
        (F.col("c_md") == F.col("k_md")) & (F.col("first_id") == F.col("k_d")), "left")
    out = rows.join(firsts, F.col("md") == F.col("c_md"), "left")
    copy = (F.col("doc_id") > F.col("first_id")) & (F.col("n_words") >= WINDOW)
    own_cut = (F.col("doc_id") == F.col("first_id")) & F.col("cut").isNotNull()
    return out.select(
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).when(own_cut, F.col("cut")).otherwise(0).cast("long").alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).when(own_cut, F.col("cut_sha")).otherwise(F.col("full")).alias("kept_sha256"))
