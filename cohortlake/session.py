"""Session settings and the checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def build_session(app: str = "cohortlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are designed for; a cluster's own settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Split a frequent key even where that costs a later operator one more shuffle.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.parquet.compression.codec": "zstd",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """This application's own folder below the checkpoint folder; all executors reach it."""
    ensure_checkpoint_dir(spark)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a cluster a
    machine-local folder would be lost with its machine, so the setting is required there.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="cohortlake-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
