"""Where intermediate tables go: a folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share: below ``spark.checkpoint.dir``, or a temporary one in a local session."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared}/work-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return tempfile.mkdtemp(prefix="spark-", dir="/tmp")


def kept(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet and read again, for tables that are used several times."""
    path = f"{work_folder(df.sparkSession)}/kept"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
