"""Event stream to bronze, and the split into parsed events and dead letters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from coinslot.functions.expr import net_revenue, parsed_once
from coinslot.model.schemas import PURCHASE_EVENT

WATERMARK = "15 minutes"
_BAD = "_bad"
_LENIENT = StructType([*[StructField(f.name, f.dataType) for f in PURCHASE_EVENT], StructField(_BAD, StringType())])


def parse_messages(raw: DataFrame) -> DataFrame:
    """``value`` by the event contract, next to the other columns of ``raw`` and ``error``.

    ``error`` is NULL for a usable event; the first failing check names it.
    """
    event = parsed_once("value", _LENIENT, {"columnNameOfCorruptRecord": _BAD})
    e = "_e"

    def blank(name: str):
        return F.col(f"{e}.{name}").isNull() | (F.col(f"{e}.{name}") == "")

    error = (
        F.when(F.col(e).isNull() | F.col(f"{e}.{_BAD}").isNotNull(), "unparseable")
        .when(blank("event_id") | blank("player_id"), "missing mandatory keys")
        .when(F.col(f"{e}.unit_price").isNull(), "missing unit_price")
        .when(F.col(f"{e}.quantity").isNull(), "missing quantity")
    )
    fields = [F.col(f"{e}.{f.name}").alias(f.name) for f in PURCHASE_EVENT]
    return raw.withColumn(e, event).select(*fields, *raw.columns, error.alias("error"))


def tag_messages(raw: DataFrame) -> DataFrame:
    parsed = parse_messages(raw)
    revenue = net_revenue("unit_price", "quantity", "discount_pct")
    return parsed.withColumn("net_revenue", F.when(F.col("error").isNull(), revenue))


def good_events(tagged: DataFrame) -> DataFrame:
    return tagged.filter("error IS NULL").drop("value", "error")


def dead_letters(tagged: DataFrame) -> DataFrame:
    letter = F.to_json(F.struct(F.col("value").alias("raw"), "error"))
    return tagged.filter("error IS NOT NULL").select(F.col("value").alias("raw"), "error", letter.alias("letter"))


def parse_with_dlq(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    tagged = tag_messages(raw)
    return good_events(tagged), dead_letters(tagged)


def dedup_events(df: DataFrame, delay: str = WATERMARK, at: str = "occurred_at", key: str = "event_id") -> DataFrame:
    return df.withWatermark(at, delay).dropDuplicatesWithinWatermark([key])


def bronze_events(raw: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Good events once each, with ingest time and event date. Dead letters are split off first,
    so malformed text neither fills the dedup state nor breaks the contract."""
    good = good_events(parse_messages(raw))
    return dedup_events(good, delay).withColumns(
        {"_ingested_at": F.current_timestamp(), "event_date": F.to_date("occurred_at")}
    )
