"""Shared folders for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder, set from the session's own configuration.

    Only a local master may fall back on a temporary folder of the machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_DIR, None) or context.getConf().get(CHECKPOINT_DIR)
    current = context.getCheckpointDir()
    if current:
        return configured or current
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="landfall-")
    context.setCheckpointDir(configured)
    return configured


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/landfall/{purpose}-{uuid.uuid4().hex}"
