"""Session defaults and the shared folder for checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "bizlens", master: str | None = None, **conf) -> SparkSession:
    """Start (or get) a session with the defaults above; keyword ``a__b`` sets option ``a.b``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode.

    A machine-local folder would lose its files with the machine, so a cluster session without the
    setting is refused rather than given one.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    folder = spark.conf.get("spark.checkpoint.dir", None) or current
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="bizlens-checkpoint-")
    if current is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written intermediate table, inside the checkpoint folder."""
    return f"{checkpoint_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
