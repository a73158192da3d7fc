"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library assumes. AQE re-plans joins and coalesces/splits
# shuffle partitions at run time; skew-join splitting handles a hot key
# (one city or one word can hold a third of all rows).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.ansi.enabled": "true",
}


def get_session(
    app: str = "hestia",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library's defaults.

    ``master`` is left to spark-submit when None, so the same code runs on a
    cluster and in tests (``local[8]``).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder the cluster names (``spark.checkpoint.dir``).

    It is read from the session. Only on a local master, as in tests, a
    temporary folder stands in where it is unset; on a cluster executors would
    not see the driver's folder, so that is an error. Never a local checkpoint.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="hestia-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path for job outputs under the shared folder.

    Written tables that cut lineage live next to the checkpoints, so on a
    cluster they land in shared storage, never in a machine-local folder.
    """
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
