"""Cutting lineage through the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session
    (tests) that names none gets a temporary folder of its own.
    """
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="spark-checkpoint-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once and read from the shared checkpoint folder.

    Cuts the lineage, so that a lost executor costs a re-read and loops do not
    grow their plans.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()
