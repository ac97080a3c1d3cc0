"""Running streams: to completion or continuously, with replay-safe outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

TRIGGER = "30 seconds"


def _triggered(writer, interval: str | None):
    return writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)


def append_files(df: DataFrame, target: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Append to a parquet folder; the sink's log makes a restart write each batch once."""
    writer = df.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    return _triggered(writer, interval).start(target)


def append_table(df: DataFrame, table: str, checkpoint: str, interval: str | None = TRIGGER) -> StreamingQuery:
    writer = df.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    return _triggered(writer, interval).toTable(table)


def each_batch(
    df: DataFrame, body: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append",
    interval: str | None = None,
) -> StreamingQuery:
    writer = df.writeStream.outputMode(mode).foreachBatch(body).option("checkpointLocation", checkpoint)
    return _triggered(writer, interval).start()


def folder_per_batch(target: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """Batch body that overwrites its own folder: a replay replaces what it wrote."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{target}/batch_id={batch_id}")

    return write


def split_outputs(target: str, dead: str) -> Callable[[DataFrame, int], None]:
    """Batch body for tagged messages: events as parquet, dead letters as JSON lines."""
    from coinslot.streaming.events import dead_letters, good_events

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            good_events(batch).write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")
            dead_letters(batch).select("raw", "error").write.mode("overwrite").json(f"{dead}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return write


def finish(query: StreamingQuery) -> StreamingQuery:
    query.awaitTermination()
    return query


def parquet_stream(spark: SparkSession, path: str, max_files: int = 256) -> DataFrame:
    """A table's files as a stream, with the schema its files have now. They come in any order of time:
    use targets from ``backfill``, or all files in one batch, rather than a watermark.

    The last name is given as a pattern that only matches itself: the stream source takes a plain
    path for a folder, and a table may be a single file.
    """
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rstrip("/").rpartition("/")
    itself = f"{folder}/[{name[0]}]{name[1:]}"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(itself)
