"""Feature tables and the sequence windows cut from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coinslot.functions.expr import as_double, confidence, exact_sum, ratio
from coinslot.operators.hotkeys import MAX_GROUP_ROWS, find_hot_keys, newest_rank
from coinslot.session import materialise

SERIES = ["platform_code", "channel_type"]
LAGS = (1, 7, 28)
ROLLS = (7, 28)
LOOKBACK, HORIZON = 56, 28
TRAIN_SHARE = 0.85

PLAYER_COLUMNS = (
    "player_id recency_days tenure_days purchase_count lifetime_value avg_order_value digital_share "
    "platforms_used membership_tier membership_status mrr is_churned"
).split()


def player_features(p360: DataFrame) -> DataFrame:
    blanks = {"digital_share": 0.0, "mrr": 0.0, "membership_tier": "NONE", "membership_status": "NONE"}
    return (
        p360.select(*PLAYER_COLUMNS)
        .fillna(blanks)
        .withColumns(
            {
                "log_ltv": F.round(F.log1p("lifetime_value"), 6),
                "log_purchases": F.round(F.log1p("purchase_count"), 6),
            }
        )
    )


def _pairs(events: DataFrame, *more: str) -> DataFrame:
    pairs = events.groupBy("player_id", "product_id", "title", "platform_code", "console_family", *more).agg(
        F.count("*").alias("purchases"),
        as_double(exact_sum("net_revenue")).alias("spend"),
        F.max("occurred_at").alias("last_seen"),
    )
    return pairs.withColumn("confidence", F.round(confidence("purchases", "spend"), 6))


def interactions(events: DataFrame) -> DataFrame:
    """Implicit feedback per player and title."""
    return _pairs(events.filter(F.col("product_type") == "GAME"))


def interactions_by_type(events: DataFrame) -> DataFrame:
    """Feedback per player, title and ``product_type``: the games' rows are ``interactions``, and no event is left out."""
    return _pairs(events, "product_type")


def interaction_features(events: DataFrame, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Interactions with the recency rank per player. The reduced pairs are stored once, because
    the search for hot players reads them again."""
    return ranked_interactions(materialise(interactions(events), "interactions"), max_group_rows)


def ranked_interactions(pairs: DataFrame, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Stored interactions, of which the rank needs player, title and ``last_seen`` only."""
    hot = find_hot_keys(pairs, ["player_id"], "last_seen", max_group_rows, ["product_id"], newest_first=True)
    return newest_rank(pairs, ["player_id"], "last_seen", ["product_id"], "_rank_desc", hot)


def daily_revenue(events: DataFrame) -> DataFrame:
    return events.groupBy(F.to_date("occurred_at").alias("ds"), *SERIES).agg(
        exact_sum("net_revenue").alias("revenue"), F.count("*").alias("transactions")
    )


def sales_timeseries(events: DataFrame) -> DataFrame:
    """Daily revenue with row lags, rolling means and calendar parts.

    The windows run over daily totals: one row per day and series, so a series stays small
    however many events it has.
    """
    by_day = Window.partitionBy(*SERIES).orderBy("ds")
    daily = daily_revenue(events)
    lags = [as_double(F.lag("revenue", n).over(by_day)).alias(f"revenue_lag_{n}") for n in LAGS]
    rolls = []
    for n in ROLLS:
        frame = by_day.rowsBetween(1 - n, 0)
        mean = ratio(F.sum("revenue").over(frame), F.count("revenue").over(frame))
        rolls.append(mean.alias(f"revenue_roll_{n}"))
    return daily.select(
        "ds",
        *SERIES,
        as_double("revenue").alias("revenue"),
        "transactions",
        *lags,
        *rolls,
        F.dayofweek("ds").alias("dow"),
        F.month("ds").alias("month"),
        F.month("ds").isin(11, 12).cast("int").alias("is_holiday_season"),
    ).dropna(subset=["revenue_lag_28"])


SEQUENCE_FEATURES = [
    "revenue", *[f"revenue_lag_{n}" for n in LAGS], *[f"revenue_roll_{n}" for n in ROLLS],
    "dow", "month", "is_holiday_season",
]


def sequence_windows(series: DataFrame, features: list[str] | None = None, keep_last: bool = False) -> DataFrame:
    """Every run of ``LOOKBACK`` rows with the ``HORIZON`` targets after it, per series.

    Each feature is one array column. As in the forecaster this feeds, the last possible window
    of a series is left out unless ``keep_last``.
    """
    names = features or SEQUENCE_FEATURES
    by_day = Window.partitionBy(*SERIES).orderBy("ds")
    past, future = by_day.rowsBetween(1 - LOOKBACK, 0), by_day.rowsBetween(1, HORIZON)
    length = F.count("*").over(Window.partitionBy(*SERIES))
    needed = HORIZON if keep_last else HORIZON + 1
    cut = series.select(
        *SERIES,
        F.col("ds").alias("last_ds"),
        F.row_number().over(by_day).alias("_seen"),
        (length - F.row_number().over(by_day)).alias("_ahead"),
        *[F.collect_list(F.col(n).cast("float")).over(past).alias(f"x_{n}") for n in names],
        F.collect_list(F.col("revenue").cast("float")).over(future).alias("y"),
    )
    return cut.filter((F.col("_seen") >= LOOKBACK) & (F.col("_ahead") >= needed)).drop("_seen", "_ahead")


def chronological_split(series: DataFrame, share: float = TRAIN_SHARE) -> DataFrame:
    """Marks the first ``share`` of each series' rows as train, the rest as validation."""
    whole = Window.partitionBy(*SERIES)
    position = F.row_number().over(whole.orderBy("ds"))
    train = position <= F.floor(F.count("*").over(whole) * share)
    return series.withColumn("split", F.when(train, "train").otherwise("validation"))
