"""Readers of change feeds: JSON lines in folders, or Kafka where its connector is installed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def json_lines(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream of text lines, one event each (column value)."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(folder)


def kafka(spark: SparkSession, servers: str, topic: str, starting: str = "earliest", fail_on_data_loss: bool = False, **options: str) -> DataFrame:
    """A topic's values as text. Needs the Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", starting).option("failOnDataLoss", str(fail_on_data_loss).lower())
    return reader.options(**options).load().select(F.col("value").cast("string").alias("value"))


def feeds(spark: SparkSession, config: dict, reader=None) -> dict[str, DataFrame]:
    """All configured feeds: {name: topic or folder}, read by Kafka if the configuration names servers."""
    if reader is None:
        reader = (lambda at: kafka(spark, config["servers"], at)) if config.get("servers") else (lambda at: json_lines(spark, at, config.get("files_per_batch")))
    return {name: reader(at) for name, at in config["feeds"].items()}
