"""Session set-up and the shared folder for checkpoints and staging tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "tidegate", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are planned for.

    On a cluster leave ``master`` unset: cores, memory and shuffle partitions
    come from spark-submit, and AQE sizes the reducers at run time.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder; on a cluster a
    machine-local folder would be lost with its machine.
    """
    named = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    local = tempfile.mkdtemp(prefix="tidegate-")
    spark.conf.set(CHECKPOINT_CONF, local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing exists there yet."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def materialise(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into reliable storage and cut its lineage.

    Used for small results (per-file or per-group statistics) that several
    later stages read: they all see the same values, also after a lost executor.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
