"""Scoring of survey files as they arrive.

The reference scores one test file in batch.  Every fitted step here is a
stateless projection or a join with a fitted table (statistics become literals;
MLlib models are row-wise), so the same preparation and model apply unchanged to
a streaming DataFrame: new files in a folder are prepared, scored and written as
submission rows, with progress kept in the checkpoint folder that the caller
names, so a restarted query resumes where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabinlens import schema as S
from cabinlens.operators.learn import positive_probability


def read_stream(spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "parquet",
                max_files: int = 100) -> DataFrame:
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(folder)


def submission_stream(raw: DataFrame, prepare: Callable[[DataFrame], DataFrame], model,
                      threshold: float = 0.5, labels: dict | None = None) -> DataFrame:
    """``(id, Satisfaction Rating)`` for each arriving row."""
    labels = labels or {v: k for k, v in S.RATING_LABELS.items()}
    scored = positive_probability(model.transform(prepare(raw)))
    pred = (F.col("p") >= threshold).cast("int")
    label = None
    for k, v in labels.items():
        label = F.when(pred == k, F.lit(v)) if label is None else label.when(pred == k, F.lit(v))
    return scored.select(S.ID, label.alias(S.RAW_TARGET))


def start_submission_sink(stream: DataFrame, out_folder: str, checkpoint: str, available_now: bool = False):
    """Append submission rows as parquet.  ``checkpoint`` is a fixed shared
    folder that belongs to ``out_folder``: a restart with the same one goes on
    where the last run stopped, and each input row is written once."""
    writer = stream.writeStream.format("parquet").option("path", out_folder).option("checkpointLocation", checkpoint)
    writer = writer.outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
