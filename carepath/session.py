"""Session factory and checkpoint-directory handling.

On a cluster the session is created by the platform: we only read its
settings.  ``spark.checkpoint.dir`` must name a shared folder there; a
machine-local temporary folder is only ever created for ``local[...]``
masters (tests, bench).
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app_name: str = "carepath",
                shuffle_partitions: int | None = None,
                extra_conf: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with UTC time, AQE on and the UI off."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, creating a private one only in local mode.

    The folder named by ``spark.checkpoint.dir`` wins.  When it is unset and
    the master is ``local[...]`` (tests, bench), a fresh folder under the
    system temp directory is used.  On a cluster an unset value is an error:
    a machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; iterative operators need a shared "
            "checkpoint folder on a cluster")
    path = tempfile.mkdtemp(prefix="carepath-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def checkpoint(df):
    """Reliable, eager checkpoint into ``spark.checkpoint.dir`` (never a
    local checkpoint): cuts the lineage so a lost executor recomputes from
    the written copy."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
