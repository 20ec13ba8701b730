"""Session settings the library depends on."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make sure reliable checkpoints have a place to go.

    A cluster names its shared folder in ``spark.checkpoint.dir``; that is used when set. Only a
    local session, where driver and executors share a disk, falls back to a temporary folder.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return
    if context.getCheckpointDir() is not None:
        return
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="skeinset-checkpoint-"))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and read on from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
