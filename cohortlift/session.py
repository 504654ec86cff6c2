"""The shared folder that checkpoints and stage tables are written to."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, also set as the session's checkpoint folder.

    A cluster names it in ``spark.checkpoint.dir``.  Only a local session, where one machine
    holds driver and executors, may fall back to a fresh temporary folder.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir")
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not (context.master == "local" or context.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="cohortlift-"))
    return context.getCheckpointDir().rstrip("/")
