"""Tables of intermediate results in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path below spark.checkpoint.dir; where that is unset, a local session gets a folder of its own and others an error."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="tamarack-")
        spark.conf.set("spark.checkpoint.dir", where)
    return f"{where.rstrip('/')}/tamarack/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """df written below the shared folder and read back: what follows doesn't compute it again, also where executors are lost."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
