"""Session start and scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Only what the results or the plans depend on; sizes are left to the cluster.
_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_session(app_name: str = "newspipe", **settings: str) -> SparkSession:
    """The running session as it is, or a new one with the settings relied on here.

    ``settings`` are for the new session too, a running one keeps its own.
    """
    running = SparkSession.getActiveSession()
    if running:
        return running
    builder = SparkSession.builder.appName(app_name)
    for key, value in (_SETTINGS | settings).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder named in ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder; on a
    cluster executors could not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="newspipe-")
    return f"{root.rstrip('/')}/newspipe-{uuid.uuid4().hex}/{name}"
