"""Session helpers: local sessions for tests/bench and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings of our local sessions. Results do not depend on the session zone
# (times are TIMESTAMP_NTZ, parsed and printed from the wall clock); UTC only
# keeps logs readable.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "gridpulse", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the benchmark (never used on a cluster)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("GRIDPULSE_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is configured by the cluster owner and must be on
    shared storage; a missing setting is an error there. Only a local session
    with no setting (tests) gets a fresh scratch folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder "
                               "(HDFS or object store) for this cluster")
        current = tempfile.mkdtemp(prefix="gridpulse-ckpt-")  # local runs only
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder, for a table that a query
    writes and reads; who owns the checkpoint folder clears it."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df):
    """Cut the lineage of a frame used by several later passes: a reliable
    checkpoint written to the shared ``spark.checkpoint.dir`` (survives the
    loss of the executors that computed it; never a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
