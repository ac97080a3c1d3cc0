"""Message sources under one contract: ``value`` (text) and ``broker_ts``.

Kafka and Pub/Sub need their connector on the classpath; the file source carries the same
contract where there is none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_OFFSETS, CDC_OFFSETS = 500_000, 200_000
PUBSUB_BYTES = "512m"


def kafka_messages(
    spark: SparkSession, servers: str, topic: str, starting: str = "earliest", max_offsets: int = EVENT_OFFSETS,
    **security: str,
) -> DataFrame:
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("maxOffsetsPerTrigger", max_offsets)
        .option("failOnDataLoss", "false")
    )
    for key, value in security.items():
        reader = reader.option(f"kafka.{key.replace('_', '.')}", value)
    return reader.load().select(F.col("value").cast("string").alias("value"), F.col("timestamp").alias("broker_ts"))


def pubsub_messages(
    spark: SparkSession, project: str, subscription: str, max_bytes: str = PUBSUB_BYTES
) -> DataFrame:
    raw = (
        spark.readStream.format("pubsub")
        .option("projectId", project)
        .option("subscriptionId", subscription)
        .option("maxBytesPerTrigger", max_bytes)
        .load()
    )
    return raw.select(
        F.col("payload").cast("string").alias("value"),
        F.timestamp_millis("publishTimestampInMillis").alias("broker_ts"),
    )


def file_messages(spark: SparkSession, folder: str, max_files: int = 256) -> DataFrame:
    """JSON lines in a folder; the file's modification time stands in for the broker time."""
    return (
        spark.readStream.option("maxFilesPerTrigger", max_files)
        .text(folder)
        .select("value", F.col("_metadata.file_modification_time").alias("broker_ts"))
    )
