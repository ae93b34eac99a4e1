"""What one task reads does not grow with the table."""

import os
import tempfile

from pyspark.sql import functions as F

from cabinlens.operators import encode as E
from cabinlens.operators import split as H
from cabinlens.sources import fixtures as FX


def _parts(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]


def test_rows_of_a_frequent_value_stay_where_they_are(spark):
    df = spark.range(0, 4000, numPartitions=8).select("id", F.lit("one").alias("x"), (F.col("id") % 2).cast("string").alias("y"))
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")  # as with tables whose size Spark overrates
    try:
        shares, codes = E.frequency_encode(df, ["x", "y"]), E.CategoryCodes.fit(df, ["x", "y"]).transform(df)
        assert sorted(_parts(shares)) == sorted(_parts(codes)) == [500] * 8
        assert {tuple(r) for r in shares.select("x_freq", "y_freq").distinct().collect()} == {(1.0, 0.5)}
        assert {tuple(r) for r in codes.select("x", "y").distinct().collect()} == {(1, 1), (1, 2)}
    finally:
        spark.conf.set(key, before)


def test_lookup_of_many_values_is_a_shuffled_join(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"v{i % 30}" if i else None) for i in range(90)], "id long, x string")
    monkeypatch.setattr(E.join_small, "__defaults__", ("left", 10))
    got = {r["id"]: r["x_freq"] for r in E.frequency_encode(df, ["x"]).collect()}
    assert got == {i: (2 if i % 30 == 0 else 3) / 89 if i else None for i in range(90)}


def test_parts_follow_the_rows(spark, monkeypatch):
    path = os.path.join(tempfile.mkdtemp(prefix="cabinlens-parts-"), "orders.parquet")
    spark.range(20_000).select(F.col("id").alias("o_orderkey"), (F.col("id") % 7).alias("o_custkey")).coalesce(1).write.parquet(path)
    monkeypatch.setattr(FX, "ROWS_A_PART", 200)
    parts = _parts(FX.passengers(spark, os.path.dirname(path)))
    assert len(parts) == 100 and sum(parts) == 20_000 and max(parts) < 400


def test_parts_follow_the_rows_of_a_row_group_cut_into_many_splits(spark, monkeypatch):
    """A file of one row group cut into 64 splits has its rows in one of them."""
    path = os.path.join(tempfile.mkdtemp(prefix="cabinlens-parts-"), "orders.parquet")
    orders = spark.range(20_000).select(F.col("id").alias("o_orderkey"), (F.col("id") % 7).alias("o_custkey"))
    orders.coalesce(1).write.parquet(path)
    (file,) = [x for x in os.listdir(path) if x.endswith(".parquet")]
    monkeypatch.setattr(FX, "ROWS_A_PART", 500)
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, str(max(1, os.path.getsize(os.path.join(path, file)) // 64)))
        scan = spark.read.parquet(path)
        assert scan.rdd.getNumPartitions() >= 64 and _parts(scan) == [20_000]
        got = FX.passengers(spark, os.path.dirname(path))
        parts = _parts(got)
        assert len(parts) == 40 and sum(parts) == 20_000 and max(parts) < 1000
        assert got.select("id").distinct().count() == 20_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_finely_dealt_input_is_left_as_is(spark, monkeypatch):
    monkeypatch.setattr(FX, "ROWS_A_PART", 500)
    cores = spark.sparkContext.defaultParallelism
    fine = spark.range(0, 4 * cores * 500, numPartitions=4 * cores)
    assert sorted(_parts(FX.spread(fine, "id"))) == [500] * (4 * cores)
    assert FX.spread(spark.range(0), "id").count() == 0


def test_parts_of_folds_follow_the_rows_not_the_shuffle_setting(spark):
    df = spark.range(0, 20_000, numPartitions=2).select("id", (F.col("id") % 2).cast("int").alias("y"))
    cores, keys = spark.sparkContext.defaultParallelism, ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k) for k in keys}
    want = {tuple(r) for r in H.stratified_kfold(df, "y", k=3).collect()}
    try:
        for shuffled in ("2", "200"):
            for threshold in ("10m", "-1"):
                spark.conf.set(keys[0], shuffled)
                spark.conf.set(keys[1], threshold)
                folds = H.stratified_kfold(df, "y", k=3, rows_a_part=500).persist()  # as the learners keep it
                parts = _parts(folds)
                rounds = -(-20_000 // (500 * cores))
                assert len(parts) == rounds * cores == folds.rdd.getNumPartitions() and max(parts) < 1000
                assert {tuple(r) for r in folds.collect()} == want
                folds.unpersist()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
