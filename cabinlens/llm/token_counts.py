"""Exact token counts for every context limit (operator 7).

Documents are aggregated by their encoded length, before and after one shuffle,
into a histogram; suffix sums over it answer, for each length L that occurs,
how many documents are at least, at most and longer than L, how many tokens
are kept if every document is cut at L, and which quantile L is.  The answer
for any other limit follows from the next smaller length (``at_limit``).

The sums run in two levels, blocks of ``BLOCK`` lengths and lengths in a block,
so no task reads more than the block totals or one block.

Defined cases: null and empty texts have length 0 and are counted; an empty
table has no rows; repeated rows and null ids are counted like any other; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cabinlens.llm.byte_bpe import _encoder, encode_texts
from cabinlens.llm.common import materialize, text_slices

#: Lengths in a block of the two-level sums.
BLOCK = 1024


def lengths(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """One row a document: n_tokens of its whole text."""
    tables = _encoder(ranks_path, pattern, docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges, cut = tables()
        for batch in batches:
            for a, b in text_slices(batch["text"]):
                _, sizes = encode_texts(batch["text"].slice(a, b - a).to_pylist(), merges, cut)
                yield pa.RecordBatch.from_arrays([pa.array(sizes.astype(np.int64))], names=["n_tokens"])

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "n_tokens long")


def length_report(counted: DataFrame, length: str = "n_tokens") -> DataFrame:
    """One row for each length that occurs: n_tokens, n_docs (of that length),
    docs_at_least, docs_longer, tokens_at_most (in documents not longer),
    kept_tokens (if all are cut at n_tokens), total_tokens, quantile (share of
    documents not longer)."""
    # a written table, as two branches read it and the texts are to be encoded once
    hist = materialize(counted.groupBy(F.col(length).alias("n_tokens")).agg(F.count("*").alias("n_docs")), "lengths")
    hist = hist.withColumn("block", F.floor(F.col("n_tokens") / BLOCK)).withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    blocks = hist.groupBy("block").agg(F.sum("n_docs").alias("b_docs"), F.sum("tokens").alias("b_tokens"))
    after = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    blocks = blocks.select(
        F.col("block").alias("b"), F.coalesce(F.sum("b_docs").over(after), F.lit(0)).alias("later_docs"),
        F.coalesce(F.sum("b_tokens").over(after), F.lit(0)).alias("later_tokens"),
        F.sum("b_docs").over(everything).alias("all_docs"), F.sum("b_tokens").over(everything).alias("all_tokens"))
    here = Window.partitionBy("block").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, -1)
    out = hist.join(blocks, F.col("block") == F.col("b")).select(
        "n_tokens", "n_docs", "all_docs", "all_tokens",
        (F.col("later_docs") + F.coalesce(F.sum("n_docs").over(here), F.lit(0))).alias("docs_longer"),
        (F.col("later_tokens") + F.coalesce(F.sum("tokens").over(here), F.lit(0))).alias("tokens_longer"))
    at_most = F.col("all_tokens") - F.col("tokens_longer")
    return out.select(
        "n_tokens", "n_docs", (F.col("docs_longer") + F.col("n_docs")).alias("docs_at_least"), "docs_longer",
        at_most.alias("tokens_at_most"), (at_most + F.col("docs_longer") * F.col("n_tokens")).alias("kept_tokens"),
        F.col("all_tokens").alias("total_tokens"), (1 - F.col("docs_longer") / F.col("all_docs")).alias("quantile"))


def at_limit(report: DataFrame, limits: list[int]) -> DataFrame:
    """(context, kept_tokens, docs_cut) for the given context limits, from the
    report alone: a limit keeps what the next smaller length keeps, plus the
    difference for each longer document; below all lengths it keeps itself for
    every document."""
    wanted = report.sparkSession.createDataFrame([(int(x),) for x in limits], "context long")
    below = report.join(F.broadcast(wanted), F.col("n_tokens") <= F.col("context")).groupBy("context").agg(
        F.max_by(F.struct("n_tokens", "docs_longer", "kept_tokens"), "n_tokens").alias("x"))
    docs = report.agg(F.max("docs_at_least").alias("n"))
    out = wanted.join(F.broadcast(below.withColumnRenamed("context", "c")), F.col("context") == F.col("c"), "left").crossJoin(F.broadcast(docs))
    cut = F.coalesce("x.docs_longer", "n", F.lit(0))
    kept = F.when(F.col("x").isNull(), F.col("context") * F.coalesce("n", F.lit(0))).otherwise(
        F.col("x.kept_tokens") + (F.col("context") - F.col("x.n_tokens")) * F.col("x.docs_longer"))
    return out.select("context", kept.alias("kept_tokens"), cut.alias("docs_cut"))
