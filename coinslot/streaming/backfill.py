"""Stream targets whose result does not depend on how the input falls into batches.

A watermark decides by what earlier batches held, so it suits a live stream, where lateness is lag. For
stored files, which come in any time order, nothing is late here, and the same rows give the same result
for any number of files. Each batch writes one folder, so a replayed batch replaces itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coinslot.functions.expr import as_double, exact_sum
from coinslot.streaming.windows import CELL, KEYS, SIZE, SLIDE, _by_window, _flat


def first_arrivals(events: DataFrame, key: str = "event_id", at: str = "occurred_at") -> DataFrame:
    """The first row of each (event day, key) of a stream, nulls being keys like others.

    What was seen is state without a watermark: a batch asks for its own keys in RocksDB and reads nothing of
    what earlier batches wrote, so its cost does not grow with the stream. State holds every key once, cut
    over as many partitions as ``spark.sql.shuffle.partitions`` names when the checkpoint is made. Copies of
    an event carry its time; a key that comes again on another day is another event.
    """
    day = "_day"
    while day in events.columns:
        day += "_"
    return events.withColumn(day, F.to_date(at)).dropDuplicates([day, key]).drop(day)


class WindowTotals:
    """Sums per sliding window: each batch stores its partial sums, reading adds them up."""

    def __init__(self, spark: SparkSession, root: str, size: str = SIZE, slide: str = SLIDE, at: str = "occurred_at"):
        self.spark, self.root, self.size, self.slide, self.at = spark, root, size, slide, at

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        sums = _by_window(batch, self.at, KEYS, self.size, self.slide).agg(exact_sum("net_revenue").alias("part"))
        _flat(sums, KEYS, "part").write.mode("overwrite").parquet(f"{self.root}/batch_id={batch_id}")

    def totals(self) -> DataFrame:
        return self.spark.read.parquet(self.root).groupBy(*CELL).agg(as_double(F.sum("part")).alias("net_revenue"))
