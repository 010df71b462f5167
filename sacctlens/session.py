"""Session helpers.

Library code never hard-codes cluster sizing: it reads whatever the session
was started with.  ``build_session`` is for tests, the bench and local runs.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job here relies on; cluster values may override sizing keys.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def _is_local(master: str) -> bool:
    return master.startswith("local") and not master.startswith("local-cluster")


def settings(master: str, shuffle_partitions: int, extra: dict) -> dict:
    """Configuration of a session; scratch folders only where the master is local."""
    conf = {**_DEFAULTS, "spark.sql.shuffle.partitions": str(shuffle_partitions), "spark.driver.memory": "8g", **extra}
    if _is_local(master):
        for key, name in (("spark.sql.warehouse.dir", "warehouse"), ("spark.checkpoint.dir", "ckpt")):
            if key not in conf:
                conf[key] = tempfile.mkdtemp(prefix=f"sacctlens-{name}-", dir=os.environ.get("TMPDIR", "/tmp"))
    return conf


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "sacctlens", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    for k, v in settings(master, shuffle_partitions, extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is respected as is;
    if it is missing there, this fails rather than fall back to a local folder.
    Only in local mode (tests) is a private scratch folder created.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint folder
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not _is_local(sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster file system); "
                           "a machine-local folder does not survive executor loss")
    local = tempfile.mkdtemp(prefix="sacctlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return local
