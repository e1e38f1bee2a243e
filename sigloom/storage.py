"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Used only where the session names no checkpoint folder, as in tests on one machine.
LOCAL_CHECKPOINTS = "/tmp/checkpoints/sigloom"


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; on one machine, where it is unset, a folder of our own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = LOCAL_CHECKPOINTS
    return root


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a Parquet table in the shared folder and reads it back: what uses it several
    times computes it once, and a lost executor costs no recomputation of what came before."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
