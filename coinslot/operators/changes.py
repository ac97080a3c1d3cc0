"""Change feed between two states of a table, and incremental positions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coinslot.session import read_stored


def change_feed(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows that differ, with ``_change_type``; an update yields its pre- and post-image.

    Rows are compared value by value (NULL equals NULL), not by hash.
    """
    columns = new.columns
    rest = [c for c in columns if c not in key]
    before = old.select(*key, F.struct(*rest).alias("_before"))
    after = new.select(*key, F.struct(*rest).alias("_after"))
    both = before.join(after, key, "full_outer").filter(~F.col("_before").eqNullSafe(F.col("_after")))

    def image(kind: str, source: str):
        return F.struct(F.lit(kind).alias("_change_type"), F.col(source).alias("row"))

    images = (
        F.when(F.col("_before").isNull(), F.array(image("insert", "_after")))
        .when(F.col("_after").isNull(), F.array(image("delete", "_before")))
        .otherwise(F.array(image("update_preimage", "_before"), image("update_postimage", "_after")))
    )
    return both.select(*key, F.explode(images).alias("_i")).select("_i._change_type", *key, "_i.row.*").select(
        "_change_type", *columns
    )


def effective_changes(feed: DataFrame) -> DataFrame:
    """Inserts and update post-images: what a downstream table takes over."""
    return feed.filter(F.col("_change_type").isin("insert", "update_postimage")).drop("_change_type")


class Positions:
    """Control table of the last processed version per source: an append-only folder.

    The position moves only after the caller's write succeeded; the greatest one counts, so
    repeating an advance is harmless.
    """

    SCHEMA = "source string, last_version bigint"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def table(self) -> DataFrame:
        rows = read_stored(self.spark, self.SCHEMA, self.path)
        return rows.groupBy("source").agg(F.max("last_version").alias("last_version"))

    def last(self, source: str) -> int | None:
        row = self.table().filter(F.col("source") == source).first()
        return row["last_version"] if row else None

    def advance(self, source: str, version: int) -> None:
        row = self.spark.createDataFrame([(source, version)], self.SCHEMA)
        row.coalesce(1).write.mode("append").parquet(self.path)


def process_increment(positions: Positions, source: str, df: DataFrame, version: str, write) -> int | None:
    """Hands the rows past the stored position to ``write(frame, upto)``, then advances.

    The upper bound is read first, so rows that arrive during the run wait for the next one.
    """
    last = positions.last(source)
    fresh = df if last is None else df.filter(F.col(version) > last)
    upto = fresh.agg(F.max(version)).first()[0]
    if upto is None:
        return last
    write(fresh.filter(F.col(version) <= upto), upto)
    positions.advance(source, upto)
    return upto


def union_evolving(*frames: DataFrame) -> DataFrame:
    """Old and new file generations under one schema; a column missing in one of them is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
