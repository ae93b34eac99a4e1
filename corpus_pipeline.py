"""A training-corpus pipeline over ``documents``: each stage is one operator of
``cabinlens.llm`` on what the stage before it kept.

1. language ID: documents without a known language go;
2. line dedup: repeated blocks of lines are cut from the later document, and a
   document that loses its last line goes;
3. near-duplicates: the first document of each group stays;
4. decontamination: documents that hold a benchmark window go;
5. byte-level BPE: each text is encoded, and decoded again as a check.

Stages 1 to 4 return the columns they were given.  Null texts have no language
and go in stage 1; null ids pass stages 2 to 5 unchanged; repeated rows (same
id, same text) are copies of one document and pass or go together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabinlens.llm import byte_bpe, dart_minhash, decontaminate, language_id, line_dedup
from cabinlens.llm.common import materialize, read_table

#: Lowest calibrated score at which a language counts as known.
LEAST_SCORE = 0.5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_known(docs, LEAST_SCORE)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = line_dedup.line_dedup(docs.withColumnRenamed("n_lines", "__n_lines").withColumnRenamed("n_removed", "__n_removed"))
    left = cut.where("n_removed = 0 OR n_removed < n_lines")
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    left = left.drop("n_lines", "n_removed")
    return left.withColumnRenamed("__n_lines", "n_lines").withColumnRenamed("__n_removed", "n_removed").select(*docs.columns)


def first_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = dart_minhash.near_duplicates(docs)
    later = materialize(groups.where("NOT is_first").select(F.col("doc_id").alias("__later")).distinct(), "later")
    return docs.join(later, F.col("doc_id") == F.col("__later"), "left_anti")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, hashes of the ids and of the decoded
    bytes, and token_ids."""
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return byte_bpe.round_trip(docs, path, pattern, keep=("doc_id", "lang", "source"), with_ids=True)


STAGES = [
    ("language_id", known_language),
    ("line_dedup", without_repeated_lines),
    ("minhash_near_dedup", first_of_near_duplicates),
    ("decontaminate", decontaminated),
    ("byte_bpe", encoded),
]

#: SQL cannot state the trained stage 1 nor the merges of stage 5; see
#: tests/llm/test_pipeline.py for the comparison with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table in the shared folder."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
