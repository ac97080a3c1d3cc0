"""Domain views derived from the driver's star schema.

Every view takes the fields it must carry and joins only the tables those fields need: Catalyst
cannot drop an inner join that is known to us to keep all rows. No broadcast hints: the planner
broadcasts by its own size check, AQE splits hot join keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coinslot.model.dims import CHANNELS, CONSOLES
from coinslot.model.schemas import CDC_PAYLOADS

PLATFORM_CODES = [row[0] for row in CONSOLES]
CHANNEL_CODES = [row[0] for row in CHANNELS]

# Where each field of the purchase view comes from.
FROM_PART = {"platform", "title", "unit_price", "genre", "publisher"}
FROM_ORDERS = {"player_id", "membership_tier", "country", "region"}
FROM_CUSTOMER = {"country", "region"}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def pick(codes: list[str], index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, codes)), (index + 1).cast("int"))


def event_key() -> Column:
    day = F.date_format("l_shipdate", "yyyyMMdd")
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", day)


def _expressions() -> dict[str, Column]:
    channel = pick(CHANNEL_CODES, F.col("l_linenumber") % 6)
    tier = F.when(channel.startswith("membership") & (F.col("o_orderpriority") != "5-LOW"), F.col("o_orderpriority"))
    return {
        "event_id": event_key(),
        "event_type": F.when(F.col("l_returnflag") == "R", "REFUND").otherwise("PURCHASE"),
        "occurred_at": F.col("l_shipdate").cast("timestamp"),
        "player_id": F.col("o_custkey").cast("string"),
        "platform": pick(PLATFORM_CODES, F.col("p_size") % 12),
        "channel_code": channel,
        "product_id": F.col("l_partkey").cast("string"),
        "product_type": F.when(channel == "console_hardware", "CONSOLE").otherwise("GAME"),
        "title": F.col("p_name"),
        "quantity": F.col("l_quantity").cast("int"),
        "unit_price": F.col("p_retailprice"),
        "discount_pct": F.when(F.col("l_discount") != 0, F.col("l_discount")),
        "is_preowned": F.col("l_returnflag") == "R",
        "membership_tier": tier,
        "country": F.col("n_name"),
        "region": F.col("r_name"),
        "genre": F.col("p_type"),
        "publisher": F.col("p_brand"),
    }


def purchases(spark: SparkSession, sf_dir: str, *fields: str, dirty: bool = False) -> DataFrame:
    """Raw purchase events. ``dirty`` plants bad prices, bad discounts and NULL prices for the rules."""
    exprs = _expressions()
    if dirty:
        exprs["unit_price"] = (
            F.when(F.col("l_orderkey") % 103 == 0, F.lit(None).cast("double"))
            .when(F.col("l_partkey") % 97 == 0, F.lit(0.0))
            .otherwise(F.col("p_retailprice"))
        )
        exprs["discount_pct"] = F.when(F.col("l_orderkey") % 101 == 0, F.lit(1.5)).otherwise(exprs["discount_pct"])
    need = set(fields)
    df = read(spark, sf_dir, "lineitem")
    # The texts of parts come last: no line is shuffled with them. Customers meet orders, which are fewer than lines.
    if need & FROM_ORDERS:
        placed = read(spark, sf_dir, "orders")
        if need & FROM_CUSTOMER:
            placed = (
                placed.join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
                .join(read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
                .join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
            )
        df = df.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
    if need & FROM_PART:
        df = df.join(read(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return df.select(*[exprs[f].alias(f) for f in fields])


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales listing with the raw file's column names, all text, with unreadable years.

    One title is listed once per genre and publisher, so the natural key repeats.
    """
    sold = purchases(
        spark, sf_dir, "title", "platform", "genre", "publisher", "occurred_at", "quantity", "region"
    ).withColumn("year", F.year("occurred_at"))

    def units(region: str) -> Column:
        return F.sum(F.when(F.col("region") == region, F.col("quantity")).otherwise(0))

    listed = sold.groupBy("title", "platform", "genre", "publisher", "year").agg(
        units("AMERICA").alias("na"),
        units("EUROPE").alias("eu"),
        units("ASIA").alias("jp"),
        F.sum("quantity").alias("world"),
    )
    other = F.col("world") - F.col("na") - F.col("eu") - F.col("jp")
    overstated = F.when(F.length("title") % 7 == 0, 1).otherwise(0)
    bad_year = F.length(F.concat("title", "genre", "publisher")) % 13 == 0
    return listed.select(
        F.concat(F.lit(" "), "title").alias("Name"),
        F.col("platform").alias("Platform"),
        F.when(bad_year, "N/A").otherwise(F.col("year").cast("string")).alias("Year"),
        F.col("genre").alias("Genre"),
        F.col("publisher").alias("Publisher"),
        F.col("na").cast("string").alias("NA_Sales"),
        F.col("eu").cast("string").alias("EU_Sales"),
        F.col("jp").cast("string").alias("JP_Sales"),
        other.cast("string").alias("Other_Sales"),
        (F.col("world") + overstated).cast("string").alias("Global_Sales"),
    )


def raw_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part")
    return part.select(
        F.col("p_name").alias("Name"),
        pick(PLATFORM_CODES, F.col("p_size") % 12).alias("Platform"),
        (F.col("p_size") * 2.0).cast("string").alias("Critic_Score"),
        F.when(F.col("p_type") == "ECONOMY", "tbd")
        .otherwise((F.col("p_size") / 5.0).cast("string"))
        .alias("User_Score"),
        F.col("p_type").alias("Rating"),
    )


#: Room for the order keys of a day in its LSNs: keys stay far below it at any scale.
LSN_STEP = 10_000_000_000_000


def subscription_changes(orders: DataFrame) -> DataFrame:
    """Change envelopes of the subscription entity from the order history (batch or stream).

    LSNs are unique and rise with the clock; deletes carry only ``before``; ``batch`` numbers
    deliver the changes out of LSN order.
    """
    committed = F.col("o_orderdate").cast("timestamp")
    millis = F.unix_millis(committed)
    lsn = F.unix_date(F.to_date(committed)).cast("long") * LSN_STEP + F.col("o_orderkey")
    payload = F.struct(
        F.concat(F.lit("S"), F.col("o_custkey")).alias("subscription_id"),
        F.col("o_custkey").cast("string").alias("player_id"),
        F.col("o_orderpriority").alias("membership_tier"),
        F.when(F.col("o_orderstatus") == "O", "ACTIVE")
        .when(F.col("o_orderstatus") == "F", "CANCELLED")
        .otherwise("LAPSED")
        .alias("status"),
        F.date_format(committed, "yyyy-MM-dd").alias("started_at"),
        F.lit(None).cast("string").alias("renews_at"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("mrr"),
    )
    gone = F.col("o_orderkey") % 17 == 0
    return orders.select(
        F.when(gone, payload).alias("before"),
        F.when(~gone, payload).alias("after"),
        F.when(gone, "d").when(F.col("o_orderstatus") == "O", "c").otherwise("u").alias("op"),
        millis.alias("ts_ms"),
        F.struct(
            millis.alias("ts_ms"),
            lsn.alias("lsn"),
            F.col("o_orderkey").alias("txId"),
            F.lit("subscriptions").alias("table"),
            F.lit("false").alias("snapshot"),
        ).alias("source"),
        (F.col("o_orderkey") % 4).alias("batch"),
    )


def _envelopes(changes: DataFrame, entity: str) -> DataFrame:
    """Envelopes from rows that have the payload columns, ``op``, ``at`` and ``lsn``; deletes carry only ``before``."""
    payload = F.struct(*CDC_PAYLOADS[entity].split())
    millis = F.unix_millis(F.col("at"))
    return changes.select(
        F.when(F.col("op") == "d", payload).alias("before"),
        F.when(F.col("op") != "d", payload).alias("after"),
        "op",
        millis.alias("ts_ms"),
        F.struct(
            millis.alias("ts_ms"), "lsn", F.col("lsn").alias("txId"), F.lit(entity).alias("table"), F.lit("false").alias("snapshot")
        ).alias("source"),
    )


def order_changes(orders: DataFrame) -> DataFrame:
    """Each order is placed, shipped two days later, and every seventh deleted after five days."""
    key, placed = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp")
    steps = F.when(key % 7 == 0, F.array(F.lit(0), F.lit(2), F.lit(5))).otherwise(F.array(F.lit(0), F.lit(2)))
    rows = orders.withColumn("step", F.explode(steps))
    at = F.timestamp_micros(F.unix_micros(placed) + F.col("step") * F.lit(86_400_000_000))
    text = F.date_format(placed, "yyyy-MM-dd")
    return _envelopes(
        rows.select(
            key.cast("string").alias("order_id"), F.col("o_custkey").cast("string").alias("player_id"),
            F.lit("digital_store").alias("channel_code"), pick(PLATFORM_CODES, key % 12).alias("platform"),
            F.when(F.col("step") == 0, "PLACED").otherwise("SHIPPED").alias("order_status"),
            F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("order_total"), F.lit("EUR").alias("currency"),
            text.alias("created_at"), text.alias("updated_at"),
            F.when(F.col("step") == 0, "c").when(F.col("step") == 2, "u").otherwise("d").alias("op"),
            at.alias("at"), (F.unix_date(F.to_date(at)).cast("long") * LSN_STEP + key).alias("lsn"),
        ),
        "orders",
    )


def customer_changes(orders: DataFrame) -> DataFrame:
    """A customer's row changes with every order; every 19th order deletes it."""
    key, placed = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp")
    return _envelopes(
        orders.select(
            F.col("o_custkey").cast("string").alias("player_id"), pick(["DE", "FR", "ES", "US"], key % 4).alias("country"),
            F.date_format(placed, "yyyy-MM-dd").alias("signup_at"), pick(PLATFORM_CODES, key % 12).alias("primary_platform"),
            F.when(key % 19 == 0, "d").otherwise("u").alias("op"), placed.alias("at"),
            (F.unix_date(F.to_date(placed)).cast("long") * LSN_STEP + key).alias("lsn"),
        ),
        "customers",
    )


def purchase_messages(events: DataFrame, copies: int = 1) -> DataFrame:
    """Event table rows (batch or stream) as broker messages; ``copies`` repeats each message.

    Some messages are broken on purpose: cut off, without a player, without a price, or with an
    empty id. ``src_id`` stays next to the text for checking.
    """
    n = F.col("event_id")
    level = F.get_json_object("props", "$.k").cast("int")
    channel = (
        F.when(F.col("event_type") == "click", "digital_store")
        .when(F.col("event_type") == "error", "physical_retail")
        .when(F.col("event_type") == "purchase", "physical_online")
        .when(F.col("event_type") == "signup", "membership_fee")
        .otherwise("membership_included")
    )
    message = F.to_json(
        F.struct(
            F.when(n % 50 == 3, "").otherwise(F.concat(F.lit("E"), n)).alias("event_id"),
            F.lit("PURCHASE").alias("event_type"),
            F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("occurred_at"),
            F.when(n % 50 != 1, F.col("user_id").cast("string")).alias("player_id"),
            pick(PLATFORM_CODES, F.col("user_id") % 12).alias("platform"),
            channel.alias("channel_code"),
            F.concat(F.lit("T"), level).alias("product_id"),
            F.lit("GAME").alias("product_type"),
            (1 + n % 3).cast("int").alias("quantity"),
            F.when(n % 50 != 2, F.col("value")).alias("unit_price"),
            F.when(level % 4 != 0, (level % 4) * 0.25).alias("discount_pct"),
            F.lit("EUR").alias("currency"),
            F.lit("1").alias("producer_version"),
        )
    )
    cut_off = F.expr("left(message, cast(length(message) / 2 as int))")
    sent = events.select(n.alias("src_id"), message.alias("message")).select(
        "src_id", F.when(F.col("src_id") % 50 == 0, cut_off).otherwise(F.col("message")).alias("value")
    )
    if copies > 1:
        sent = sent.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("_copy")
    return sent
