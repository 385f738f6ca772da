"""Cutting lineage between rounds of an iterative operator."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the cluster names in spark.checkpoint.dir.

    Only a local session without that setting gets a folder of its own.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        configured = tempfile.mkdtemp(prefix="trailmark-checkpoint-")
    sc.setCheckpointDir(configured)


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in reliable storage, so a lost executor costs no earlier round."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
