"""Scoring arriving files gives the same submission rows as the batch path."""

import os
import tempfile

from pyspark.sql import functions as F

from cabinlens import schema as S
from cabinlens.operators import learn as J
from cabinlens.operators.select import split_xy
from cabinlens.plans import features as FE
from cabinlens.plans.catalog import train_frame
from cabinlens.sources import fixtures as FX
from cabinlens.streaming.scoring import read_stream, start_submission_sink, submission_stream


def test_stream_matches_batch(spark, sf):
    train = train_frame(spark, sf)
    xy, _ = split_xy(FE.features_tree(train))
    model = J.boosted_trees({"n_estimators": 5, "max_depth": 3}).fit(xy)

    def prepare(raw):
        feats = FE.features_tree(FE.prepare_frame(raw, labelled=False), fit_on=train)
        return split_xy(feats)[0]

    folder = tempfile.mkdtemp(prefix="cabinlens-in-")
    raw_test = FX.raw_test(spark, sf)
    raw_test.write.mode("overwrite").parquet(os.path.join(folder, "batch1"))
    out = tempfile.mkdtemp(prefix="cabinlens-out-")
    stream = submission_stream(read_stream(spark, os.path.join(folder, "batch1"), raw_test.schema), prepare, model)
    progress = os.path.join(out, "_progress")
    q = start_submission_sink(stream, out, progress, available_now=True)
    q.awaitTermination(300)
    got = {r[S.ID]: r[S.RAW_TARGET] for r in spark.read.parquet(out).collect()}
    batch = submission_stream(raw_test, prepare, model)
    want = {r[S.ID]: r[S.RAW_TARGET] for r in batch.collect()}
    assert got == want and len(got) == raw_test.count()
    # new rows after a restart are added, the others are not written again
    more = raw_test.limit(5).withColumn(S.ID, F.col(S.ID) + 10_000_000)
    more.write.mode("append").parquet(os.path.join(folder, "batch1"))
    stream = submission_stream(read_stream(spark, os.path.join(folder, "batch1"), raw_test.schema), prepare, model)
    start_submission_sink(stream, out, progress, available_now=True).awaitTermination(300)
    assert spark.read.parquet(out).count() == len(want) + 5
