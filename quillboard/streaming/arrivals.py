"""Incremental event counts by Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quillboard.sources.shared import shared_folder


def daily_cells(spark: SparkSession, path: str, delay: str = "1 day") -> DataFrame:
    """(day, kind, n, total) of an events folder read as a stream, as far as it has come.

    Each batch adds its partial cells to a table by batch number; a batch that runs again
    overwrites its own, so every event counts once. Reading sums a cell's parts.
    """
    folder = shared_folder(spark, "stream")
    schema = spark.read.parquet(path).schema
    name = path.rstrip("/").rpartition("/")
    stream = spark.readStream.schema(schema).option("pathGlobFilter", name[2] if name[2].endswith(".parquet") else "*.parquet").parquet(name[0] if name[2].endswith(".parquet") else path)

    def upsert(batch: DataFrame, number: int) -> None:
        cells = batch.groupBy(F.to_date("ts").alias("day"), F.col("event_type").alias("kind")).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
        cells.write.mode("overwrite").parquet(f"{folder}/cells/batch={number}")

    query = stream.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", delay).writeStream.foreachBatch(upsert).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    parts = spark.read.schema("day date, kind string, n long, total double, batch int").parquet(f"{folder}/cells")
    return parts.groupBy("day", "kind").agg(F.sum("n").alias("n"), F.round(F.sum("total"), 4).alias("total"))
