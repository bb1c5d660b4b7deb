"""Shared folder of a session for checkpoints and written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session, or the checkpoint folder set on its context.

    Only where both are unset and Spark runs in one process (tests) a temporary
    folder takes their place; a cluster has to name a folder that it shares.
    """
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not found:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="readloom-"))
        found = context.getCheckpointDir()
    return found.rstrip("/")


def ensure_checkpoints(spark: SparkSession) -> None:
    if not spark.sparkContext.getCheckpointDir():
        folder = shared_dir(spark)
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(folder)


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/readloom/{name}-{uuid.uuid4().hex}"
