"""Incremental runs with durable state: each input row is processed once, over any number of runs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.near import shared_folder


def remaining(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key no earlier run has processed."""
    return rows.join(done.select(key).distinct(), key, "left_anti")


def resume(spark: SparkSession, source: str, schema, out: str, checkpoint: str, transform, files_per_batch: int = 100) -> None:
    """Process the files of ``source`` that no earlier call has, batch by batch, and append the results to ``out``."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    query = transform(stream).writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", out).trigger(availableNow=True).start()
    query.awaitTermination()


def hourly_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by hour and type, from rows that resumed runs have taken over; the second run finds nothing new."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    folder = f"{shared_folder(spark)}/hourly-{uuid.uuid4().hex}"
    for _ in range(2):
        # A pattern, since a stream's plain path must be a folder, and the table may be one file.
        resume(spark, f"{sf_dir}/events.parque[t]", schema, f"{folder}/rows", f"{folder}/state", lambda rows: rows.select("ts", "event_type", "value"))
    rows = spark.read.parquet(f"{folder}/rows")
    counted = rows.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"), "event_type")
    return counted.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
