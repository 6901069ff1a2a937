"""Session settings the operators rely on."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings that decide results; sizes and partition counts stay the cluster's."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or what setCheckpointDir was given. Raises without."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return root.rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise df in the shared folder, so that later stages restart from files after an executor loss."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))
    return df.checkpoint()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
