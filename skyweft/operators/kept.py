"""Results that are written once because several plans read them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors share; where it is unset a
    temporary one on a local master, an error on a cluster."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="skyweft-")
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def kept(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: the plan ends there, and a lost
    executor takes nothing with it. The files stay until the folder is cleared."""
    path = f"{shared_folder(df.sparkSession)}/skyweft-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
