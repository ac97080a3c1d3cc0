"""Contracts of the event stream and of the change-data-capture payloads."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, StringType, StructType


def struct(text: str) -> StructType:
    """``name type`` pairs to a schema, without needing a session as ``fromDDL`` does."""
    schema = StructType()
    for pair in text.split(", "):
        schema.add(*pair.split(" "))
    return schema


# The purchase event contract.
PURCHASE_EVENT = struct(
    "event_id string, event_type string, occurred_at timestamp, player_id string, platform string, "
    "channel_code string, product_id string, product_type string, title string, quantity integer, "
    "unit_price double, discount_pct double, currency string, country string, is_preowned boolean, "
    "membership_tier string, producer_version string"
)

# The bronze table: the event, when the broker had it, when it was taken in, and its day.
BRONZE_EVENT = StructType(
    [*PURCHASE_EVENT.fields, *struct("broker_ts timestamp, _ingested_at timestamp, event_date date").fields]
)

# Payload columns per captured entity, key first, all text on the wire.
CDC_PAYLOADS = {
    "orders": "order_id player_id channel_code platform order_status order_total currency created_at updated_at",
    "subscriptions": "subscription_id player_id membership_tier status started_at renews_at mrr",
    "customers": "player_id country signup_at primary_platform",
}

CDC_KEYS = {entity: columns.split()[0] for entity, columns in CDC_PAYLOADS.items()}


def payload_schema(entity: str) -> StructType:
    return struct(", ".join(f"{c} string" for c in CDC_PAYLOADS[entity].split()))


def envelope_schema(payload: StructType) -> StructType:
    source = struct("ts_ms long, lsn long, txId long, table string, snapshot string")
    return (
        StructType()
        .add("before", payload)
        .add("after", payload)
        .add("op", "string")
        .add("ts_ms", "long")
        .add("source", source)
    )


# What a catalog completion must look like.
ENRICHMENT = struct("sub_genre string, franchise string, retro_appeal string, audience string").add(
    "themes", ArrayType(StringType())
)
RETRO_APPEAL = ("LOW", "MEDIUM", "HIGH")
