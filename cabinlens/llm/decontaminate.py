"""Benchmark decontamination by winnowing (operator 1), in SQL functions only.

A *window* is ``span`` consecutive words of a benchmark item (an item of fewer
words is one window).  Winnowing keeps, for each window, the smallest hash of
the ``k``-word runs inside it, with ``k`` words and ``span - k + 1`` runs per
window, so equal windows always keep the same fingerprint: every shared span
of ``span`` words is found.  Consecutive windows with one fingerprint are one
row (about 2 of 7 words keep a row at span 10).  Document fingerprints are
joined with the benchmark's; in the documents with a hit, each hit is extended
to the windows it stands for and these are compared word by word with the
benchmark's windows.

A join is broadcast only when the counted side is within a bound
(``BROADCAST_WINDOWS``, ``BROADCAST_KEYS``); beyond it the same join is left to
Spark's sort-merge join, whose hot keys AQE splits.

Defined cases: null text and text without words have no words and no hits;
null ``doc_id`` is kept and returned as null; repeated rows are returned as
often as they occur; an empty benchmark marks nothing; rows of the benchmark
with a null text are ignored, and one with a null ``item_id`` counts for n_hit
and contaminated but is not listed in items; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabinlens.llm.common import if_small, materialize

#: Fixed by the contract of the query: what separates words after A-Z became a-z.
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Most benchmark windows (some 150 bytes each) that are sent to every executor.
BROADCAST_WINDOWS = 100_000
#: Most documents with a hit whose keys are broadcast to skip a shuffle of all texts.
BROADCAST_KEYS = 1_000_000


WORDS = ("coalesce(array_remove(split(translate({text}, '" + UPPER + "', '" + LOWER + "'), r'" + SEPARATOR + "'), ''), "
         "CAST(array() AS array<string>))")


def words(text: str) -> Column:
    """Words of a text column; null has none."""
    return F.expr(WORDS.format(text=f"`{text}`"))


def _fingerprints(span: int) -> str:
    """SQL over the words ``w``: ``array<struct<len, f, s, e>>``, one row for each
    run of windows with one fingerprint ``f``; the windows start at s, ..., e - 1
    (from 0).  One-element transforms name the intermediate arrays.  Indexed
    arguments are used throughout, as a slice copies the whole array each time."""
    k = min(5, span)
    runs = span - k + 1
    words_of = ", ".join(f"w[i + {j}]" for j in range(k))
    hashes = f"transform(sequence(0, size(w) - {k}), i -> xxhash64({words_of}))"
    near = ", ".join(f"h[i + {j}]" for j in range(runs))
    least = f"transform(sequence(0, size(h) - {runs}), i -> {f'least({near})' if runs > 1 else near})"
    first = "filter(sequence(0, size(m) - 1), i -> i = 0 OR m[i] <> m[i - 1])"
    inner = (f"transform(st, (s, j) -> named_struct('len', {span}, 'f', m[s], 's', s, "
             "'e', coalesce(get(st, j + 1), size(m))))")
    text = (f"transform(array({hashes}), h -> transform(array({least}), m -> "
            f"transform(array({first}), st -> {inner})[0])[0])[0]")
    return f"CASE WHEN size(w) >= {span} THEN {text} ELSE CAST(array() AS array<{RUN}>) END"


#: A run of windows: their length in words, fingerprint, first start, end of the starts.
RUN = "struct<len: int, f: bigint, s: int, e: int>"


def _windows(runs: str) -> str:
    """SQL over ``w``: the windows of runs, each with its start, length and words."""
    return (f"flatten(transform({runs}, r -> transform(sequence(r.s, r.e - 1), a -> named_struct('at', a, 'len', r.len, "
            "'f', r.f, 'win', concat_ws(' ', transform(sequence(a, a + r.len - 1), q -> w[q]))))))")


def benchmark_windows(items: DataFrame, span: int = 10, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item, len, f, win): every window of every item, ``win`` as its words
    joined by spaces."""
    base = items.select(F.col(item_id).alias("item"), words(text).alias("w")).where("size(w) > 0")
    lens = ", ".join(f"WHEN size(w) = {n} THEN {_fingerprints(n)}" for n in range(1, span)).replace(", WHEN", " WHEN")
    base = base.withColumn("runs", F.expr(f"CASE {lens} ELSE {_fingerprints(span)} END"))
    wins = base.select("item", F.inline(F.expr(_windows("runs"))))
    return wins.select("item", "len", "f", "win").distinct()


def contamination(
    docs: DataFrame, items: DataFrame, span: int = 10, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items (array of item ids
    as strings, sorted), contaminated."""
    wins = materialize(benchmark_windows(items, span, item_id, item_text), "benchmark")
    size = wins.agg(F.count("*").alias("n"), F.sort_array(F.collect_set("len")).alias("lens")).first()
    small = size["n"] <= BROADCAST_WINDOWS
    lens = sorted({span, *size["lens"]})

    def side(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if small else df

    base = docs.select(F.col(doc_id).alias("d"), F.md5(F.coalesce(text, F.lit(""))).alias("md"), F.col(text).alias("text"))
    # one pass over the texts: a marker row for each document (len 0, its word count as s) and its fingerprints
    marker = f"array(CAST(named_struct('len', 0, 'f', xxhash64(text), 's', size(w), 'e', 0) AS {RUN}))"
    parts = ", ".join([marker, *(_fingerprints(n) for n in lens)])
    marks = base.select("d", "md", F.inline(F.expr(f"transform(array({WORDS.format(text='text')}), w -> concat({parts}))[0]")))
    known = wins.select(F.col("len").alias("k_len"), F.col("f").alias("k_f")).distinct()
    hits = marks.join(side(known), (F.col("len") == F.col("k_len")) & (F.col("f") == F.col("k_f")), "left")
    hits = hits.where("len = 0 OR k_len IS NOT NULL")
    per_doc = materialize(hits.groupBy("d", "md").agg(
        F.max(F.expr("IF(len = 0, s, 0)")).alias("n"), F.sum(F.expr("IF(len = 0, 1, 0)")).alias("copies"),
        F.collect_set(F.expr("IF(len > 0, named_struct('len', len, 'f', f, 's', s, 'e', e), NULL)")).alias("runs")), "hits")

    # extend each hit to its windows and compare their words with the benchmark's
    some = per_doc.where("size(runs) > 0").select(F.col("d").alias("k_d"), F.col("md").alias("k_md"), "runs")
    here = F.col("d").eqNullSafe(F.col("k_d")) & (F.col("md") == F.col("k_md"))
    texts = base.join(if_small(some.drop("runs"), some.count(), BROADCAST_KEYS), here, "left_semi")
    own = texts.dropDuplicates(["d", "md"]).join(some, here).select("d", "md", "runs", words("text").alias("w"))
    spread = own.select("d", "md", F.inline(F.expr(_windows("runs")))).drop("f")
    of_item = wins.select(F.col("win").alias("k_win")).distinct()
    exact = spread.join(side(of_item), F.col("win") == F.col("k_win")).groupBy("d", "md").agg(
        F.collect_set(F.struct("at", "len")).alias("at"), F.collect_set("win").alias("found"))
    # words covered by the union of the windows, left to right
    exact = exact.withColumn("n_hit", F.expr(
        "aggregate(array_sort(at), named_struct('e', 0, 'c', 0), (a, x) -> named_struct("
        "'e', greatest(a.e, x.at + x.len), 'c', a.c + greatest(0, x.at + x.len - greatest(a.e, x.at)))).c"))
    named = exact.select("d", "md", "n_hit", F.explode("found").alias("k_win")).join(
        side(wins.select(F.col("win").alias("i_win"), "item").distinct()), F.col("k_win") == F.col("i_win"))
    found = named.groupBy(F.col("d").alias("k_d"), F.col("md").alias("k_md")).agg(
        F.first("n_hit").alias("n_hit"), F.collect_set("item").alias("items"))

    out = per_doc.select("d", "md", "n", F.explode(F.expr("array_repeat(0, CAST(copies AS INT))"))).join(found, here, "left")
    out = out.withColumn("items", F.coalesce("items", F.array().cast(found.schema["items"].dataType)))
    out = out.withColumn("n_hit", F.coalesce("n_hit", F.lit(0)))
    return out.select(
        F.col("d").alias("doc_id"), F.col("n").cast("long").alias("n_words"), F.col("n_hit").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.array_sort(F.transform("items", lambda x: x.cast("string"))).alias("items"),
        (F.col("n_hit") > 0).alias("contaminated"))


def digest(found: DataFrame) -> DataFrame:
    """The columns of the query: item ids as one SHA-256."""
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def drop_contaminated(docs: DataFrame, items: DataFrame, span: int = 10) -> DataFrame:
    """Documents without any benchmark window, all columns kept.  Rows are
    matched by (doc_id, text), so repeated and null ids are handled."""
    key = F.struct(F.col("doc_id").alias("d"), F.md5(F.coalesce("text", F.lit(""))).alias("md"))
    found = contamination(docs.select(key.alias("doc_id"), "text"), items, span).where("contaminated")
    bad = materialize(found.select(F.col("doc_id").alias("__bad")).distinct(), "contaminated")
    return docs.join(if_small(bad, bad.count(), BROADCAST_KEYS), key.eqNullSafe(F.col("__bad")), "left_anti")
