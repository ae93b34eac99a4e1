"""Session helpers.

Library code never creates its own session: every operator takes DataFrames
(or a ``SparkSession``) from the caller.  ``local_session`` exists for tests
and the bench only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "cabinlens") -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the operator of the cluster sets this to a shared (HDFS/S3)
    folder and we only read it.  Only when it is unset (tests, a laptop) do we
    make a scratch folder of our own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get(CHECKPOINT_KEY, None) or sc.getConf().get(CHECKPOINT_KEY, None)
    if not conf_dir and not sc.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a shared folder (HDFS/S3/DBFS) for this cluster")
    if not conf_dir:
        conf_dir = tempfile.mkdtemp(prefix="cabinlens-ckpt-")
        spark.conf.set(CHECKPOINT_KEY, conf_dir) if _settable(spark) else None
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def _settable(spark: SparkSession) -> bool:
    try:
        return spark.conf.isModifiable(CHECKPOINT_KEY)
    except Exception:  # noqa: BLE001 - older/newer API differences
        return False


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name)
