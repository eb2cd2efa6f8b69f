"""Session helpers: building a session, the checkpoint folder, lineage cuts."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Defaults for sessions built by `get_session` (tests, bench, tools). Library
# functions never change session settings: on a cluster the caller's own
# session and its spark.checkpoint.dir are used as they are.
LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoints go when no frame needs them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app: str = "tidepool",
                shuffle_partitions: int | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(LOCAL_DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting it only when unset.

    Order: a folder already set on the context, then the session setting
    ``spark.checkpoint.dir`` (the shared folder the cluster names). Only a
    local-mode session with neither gets a fresh scratch folder; a cluster
    session without a shared folder is an error, since a machine-local
    folder would not survive the loss of that machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder for checkpoints")
    scratch = tempfile.mkdtemp(prefix="tidepool-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: writes to the shared checkpoint folder and cuts lineage.

    Used where a frame is read twice and both reads must see the same rows
    in the same partitions (ordinals), and in iterative loops.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote below the checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    if not path.startswith(f"{root}/"):
        raise ValueError(f"{path} is not below {root}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared checkpoint folder (for written tables)."""
    import uuid

    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/tables/{label}-{uuid.uuid4().hex[:12]}"
