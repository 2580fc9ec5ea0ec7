"""Tables between jobs, in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession) -> str:
    """A new path in the folder that the cluster shares; in one of our own only where none is set and one machine does all."""
    shared = spark.conf.get("spark.checkpoint.dir", "") or ""
    if not shared:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="islet-")
    return f"{shared.rstrip('/')}/islet-{uuid.uuid4().hex}"


def keep(df: DataFrame) -> DataFrame:
    """Writes a table to the shared folder and reads it back: lineage ends there, and Spark knows its size."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
