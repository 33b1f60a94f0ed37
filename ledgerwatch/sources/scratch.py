"""Shared scratch space of the session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which all executors see. Where that is unset, a local session has a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", "") or spark.conf.get("spark.ledgerwatch.scratch", "")
    if not base:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors see")
        base = "file://" + tempfile.mkdtemp(prefix="ledgerwatch-")
        spark.conf.set("spark.ledgerwatch.scratch", base)
    return base.rstrip("/")


def new_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows as a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()
