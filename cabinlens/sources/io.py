"""Sources and sinks: CSV/Parquet tables, submissions, models, trial logs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabinlens import schema as S
from cabinlens.functions.exprs import c


# -- A1 ---------------------------------------------------------------------
def read_survey(spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "csv") -> DataFrame:
    """Headered CSV (or Parquet) with an explicit schema; empty and NaN cells are
    NULL.  Columns are taken by name, whatever their order in the file."""
    if fmt == "parquet":
        df = spark.read.parquet(path)
        if schema is not None:
            df = df.select(*[c(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    else:
        if schema is None:
            raise ValueError("pass an explicit schema; schema inference costs a full pass")
        reader = spark.read.option("header", True).option("nanValue", "NaN").option("nullValue", "")
        types = {f.name.strip(): f.dataType for f in schema.fields}
        names = reader.csv(path).columns  # the header line only
        at = {x.strip(): x for x in names}
        missing = [f.name for f in schema.fields if f.name.strip() not in at]
        if missing:
            raise ValueError(f"{path} lacks the columns {missing}")
        # in the file's order; a file with another header fails instead of being read by position
        own = T.StructType([T.StructField(x, types.get(x.strip(), T.StringType())) for x in names])
        df = reader.schema(own).option("mode", "FAILFAST").option("enforceSchema", False).csv(path)
        df = df.select(*[c(at[f.name.strip()]).alias(f.name) for f in schema.fields])
    # NaN in a double column counts as missing, like a blank cell
    return df.withColumns(
        {f.name: F.when(~F.isnan(c(f.name)), c(f.name)) for f in df.schema.fields
         if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    )


def survey_schema(with_label: bool = True) -> T.StructType:
    fields = [f for f in S.RAW_SCHEMA.fields if with_label or f.name != S.RAW_TARGET]
    return T.StructType(fields)


# -- A2 ---------------------------------------------------------------------
def normalize_columns(df: DataFrame) -> DataFrame:
    """Every space in a column name becomes ``_`` (trailing spaces too)."""
    return df.toDF(*[S.normalize_name(x) for x in df.columns])


# -- A3 ---------------------------------------------------------------------
def write_table(df: DataFrame, path: str, sep: str = ",", fmt: str = "csv", mode: str = "overwrite") -> None:
    """Write with a header and no index: a folder of part files."""
    if fmt == "parquet":
        df.write.mode(mode).parquet(path)
    else:
        df.write.mode(mode).option("header", True).option("sep", sep).csv(path)


# -- A4 ---------------------------------------------------------------------
def submission(sample: DataFrame, predictions: DataFrame, pred_col: str = "prediction",
               label_col: str = S.RAW_TARGET, labels: Mapping[int, str] | None = None) -> DataFrame:
    """Replace the label column of the sample file by the predicted labels.

    Rows are matched on ``id`` (never by position); ids without a prediction
    keep NULL.
    """
    labels = labels or {v: k for k, v in S.RATING_LABELS.items()}
    preds = predictions.select(F.col(S.ID), F.col(pred_col).alias("__pred"))
    mapped = None
    for k, v in labels.items():
        cond = F.col("__pred") == F.lit(k)
        mapped = F.when(cond, F.lit(v)) if mapped is None else mapped.when(cond, F.lit(v))
    cols = [mapped.alias(x) if x == label_col else c(x) for x in sample.columns]
    return sample.join(preds, S.ID, "left").select(*cols)


# -- A5 ---------------------------------------------------------------------
def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str):
    """Any saved model, by the class that its metadata names."""
    from pyspark.ml.util import DefaultParamsReader
    from pyspark.sql import SparkSession

    return DefaultParamsReader.loadParamsInstance(path, SparkSession.getActiveSession())


# -- A6 ---------------------------------------------------------------------
TRIAL_SCHEMA = T.StructType(
    [
        T.StructField("search", T.StringType()),
        T.StructField("trial", T.IntegerType()),
        T.StructField("params", T.StringType()),
        T.StructField("accuracy", T.DoubleType()),
        T.StructField("loss", T.DoubleType()),
    ]
)


def append_trials(trials: DataFrame, path: str) -> None:
    """One record per search trial; appended, so a resumed search keeps history."""
    trials.select(*[c(f.name).cast(f.dataType) for f in TRIAL_SCHEMA.fields]).write.mode("append").parquet(path)
