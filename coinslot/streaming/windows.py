"""Sliding revenue: accumulating results with a watermark, and discarding panes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coinslot.functions.expr import as_double, exact_sum

SIZE, SLIDE, LATENESS = "60 seconds", "15 seconds", "300 seconds"
KEYS = ["platform", "channel_code"]
CELL = ["window_start", "window_end", *KEYS]


def _by_window(events: DataFrame, at: str, keys: list[str], size: str, slide: str):
    return events.groupBy(F.window(at, size, slide), *keys)


def _flat(agg: DataFrame, keys: list[str], *values: str) -> DataFrame:
    return agg.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, *values
    )


def sliding_revenue(
    events: DataFrame, size: str = SIZE, slide: str = SLIDE, lateness: str = LATENESS,
    at: str = "occurred_at", keys: list[str] | None = None, amount: str = "net_revenue",
) -> DataFrame:
    """Revenue per sliding window; on a stream, rows later than ``lateness`` are dropped.

    Rows are summed per task before the shuffle, so a hot platform costs one row per window.
    """
    keys = keys or KEYS
    timed = events.withWatermark(at, lateness) if events.isStreaming else events
    sums = _by_window(timed, at, keys, size, slide).agg(exact_sum(amount).alias("total"))
    return _flat(sums, keys, as_double("total").alias("net_revenue"))


def latest_per_window(updates: DataFrame, version: str = "batch_id") -> DataFrame:
    """Update-mode output to final values: the last emitted sum of each window."""
    return updates.groupBy(*CELL).agg(F.max_by("net_revenue", version).alias("net_revenue"))


class PaneSink:
    """``foreachBatch`` target writing discarding panes: each pane holds only what arrived since
    the pane before it.

    A window takes rows until ``lateness`` after the watermark passed its end; the watermark is the
    greatest event time of earlier batches. What comes later is not lost: it goes to the ``late`` panes
    with the mark that closed its window. ``lateness=None`` never closes a window, for stored input.
    All outputs are folders per batch, so a replayed batch replaces itself, and a batch reads the one
    mark before it.
    """

    def __init__(
        self, spark: SparkSession, root: str, size: str = SIZE, slide: str = SLIDE, lateness: str | None = LATENESS
    ):
        self.spark, self.root = spark, root
        self.size, self.slide, self.lateness = size, slide, lateness

    def _watermark(self, batch_id: int):
        if batch_id == 0:
            return None
        return self.spark.read.schema("high timestamp").parquet(f"{self.root}/marks/batch_id={batch_id - 1}").first()[0]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        mark = self._watermark(batch_id)
        sums = _by_window(batch, "occurred_at", KEYS, self.size, self.slide).agg(
            exact_sum("net_revenue").alias("pane"), F.max("occurred_at").alias("high"), F.count("*").alias("events")
        )
        panes = _flat(sums, KEYS, "pane", "high", "events").withColumn("mark", F.lit(mark).cast("timestamp"))
        closed = F.lit(False)
        if mark is not None and self.lateness is not None:
            closed = F.col("window_end") + F.expr(f"INTERVAL {self.lateness}") <= F.col("mark")
        written = f"{self.root}/all/batch_id={batch_id}"
        panes.withColumn("late", closed).write.mode("overwrite").parquet(written)
        # Read back rather than evaluate the batch again.
        high = self.spark.read.schema("high timestamp").parquet(written).agg(F.max("high").alias("high"))
        high = high.select(F.greatest("high", F.lit(mark).cast("timestamp")).alias("high"))
        high.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/marks/batch_id={batch_id}")

    def _all(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/all")

    def panes(self) -> DataFrame:
        return self._all().filter("NOT late").drop("high", "mark", "late")

    def late(self) -> DataFrame:
        """Panes that came after their window closed, with the mark that closed it."""
        return self._all().filter("late").drop("high", "late")


def panes_total(panes: DataFrame) -> DataFrame:
    return panes.groupBy(*CELL).agg(as_double(F.sum("pane")).alias("net_revenue"))
