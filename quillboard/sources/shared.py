"""A folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir; only a local session without that setting gets one of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def stored(rows: DataFrame, name: str) -> DataFrame:
    """Rows written to the shared folder and read again, so that they are computed once."""
    path = f"{shared_folder(rows.sparkSession, name)}/rows"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
