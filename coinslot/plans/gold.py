"""Business marts.

Facts are first reduced to small cells (map-side partial sums of exact decimals), then rolled up,
so a player or title holding a large share of all rows never reaches one task row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coinslot.functions.expr import MONEY, as_double, exact_sum, ratio
from coinslot.operators.dedup import best_row
from coinslot.operators.hotkeys import MAX_GROUP_ROWS, find_hot_keys, next_in_key

CHURN_AFTER_DAYS = 90
CELL = ["era", "console_family", "platform_code", "channel_type"]


def sales_by_era_platform(sales: DataFrame, events: DataFrame) -> DataFrame:
    """Boxed units per genre next to purchase revenue per channel, matched on the shared cell."""
    boxed = (
        sales.withColumn("channel_type", F.lit("PHYSICAL"))
        .groupBy(*CELL, "genre")
        .agg(
            as_double(exact_sum("global_sales_musd")).alias("physical_units_m"),
            F.countDistinct("title").alias("titles_released"),
            ratio(exact_sum("critic_score"), F.count("critic_score")).alias("avg_critic_score"),
        )
    )
    bought = events.groupBy(*CELL).agg(
        as_double(exact_sum("net_revenue")).alias("net_revenue"),
        F.countDistinct("player_id").alias("buyers"),
        F.count("*").alias("transactions"),
    )
    return boxed.join(bought, CELL, "full_outer")


def current_subscription(history: DataFrame) -> DataFrame:
    """The newest live subscription of each player."""
    live = history.filter(F.col("is_current") & ~F.col("is_deleted"))
    columns = [
        "player_id",
        "membership_tier",
        F.col("status").alias("membership_status"),
        F.col("mrr").cast("double").alias("mrr"),
        "_lsn",
        "_pk",
    ]
    return best_row(live.select(*columns), ["player_id"], "_lsn", "_pk").drop("_lsn", "_pk")


def _spent(cells_total: str, where: Column) -> Column:
    return F.coalesce(F.sum(F.when(where, F.col(cells_total))), F.lit(0).cast(MONEY))


def _days_before(as_of: Column, c: str) -> Column:
    return F.datediff(as_of, F.to_date(c))


def _churned(as_of: Column, last: str) -> Column:
    return (_days_before(as_of, last) > CHURN_AFTER_DAYS).cast("int")


def churn_labels(events: DataFrame, as_of: Column) -> DataFrame:
    """Only the label of the player mart, for jobs that need nothing else of it."""
    last = events.groupBy("player_id").agg(F.max("occurred_at").alias("last_purchase_at"))
    return last.select("player_id", _churned(as_of, "last_purchase_at").alias("is_churned"))


def player_360(events: DataFrame, history: DataFrame, as_of: Column) -> DataFrame:
    """One row per player: recency, frequency, money, channel mix, membership and churn label."""
    cells = events.groupBy("player_id", "platform_code", "console_family", "channel_type").agg(
        F.max("occurred_at").alias("last_at"),
        F.min("occurred_at").alias("first_at"),
        F.count("*").alias("n"),
        F.count("net_revenue").alias("n_priced"),
        exact_sum("net_revenue").alias("spent"),
    )
    kind = F.col("channel_type")
    rolled = cells.groupBy("player_id").agg(
        F.max("last_at").alias("last_purchase_at"),
        F.min("first_at").alias("first_purchase_at"),
        F.sum("n").alias("purchase_count"),
        F.sum("n_priced").alias("n_priced"),
        F.sum("spent").alias("lifetime"),
        _spent("spent", kind == "PHYSICAL").alias("physical"),
        _spent("spent", kind == "DIGITAL").alias("digital"),
        _spent("spent", kind == "MEMBERSHIP").alias("membership"),
        F.size(F.collect_set("platform_code")).alias("platforms_used"),
        F.sort_array(F.collect_set("console_family")).alias("console_families"),
    )

    scored = rolled.select(
        "player_id",
        "last_purchase_at",
        "first_purchase_at",
        "purchase_count",
        as_double("lifetime").alias("lifetime_value"),
        ratio("lifetime", "n_priced").alias("avg_order_value"),
        as_double("physical").alias("physical_spend"),
        as_double("digital").alias("digital_spend"),
        as_double("membership").alias("membership_spend"),
        F.col("platforms_used").cast("long").alias("platforms_used"),
        "console_families",
        _days_before(as_of, "last_purchase_at").alias("recency_days"),
        _days_before(as_of, "first_purchase_at").alias("tenure_days"),
        ratio("digital", "lifetime").alias("digital_share"),
        _churned(as_of, "last_purchase_at").alias("is_churned"),
    )
    return scored.join(current_subscription(history), "player_id", "left")


def console_lifecycle(sales: DataFrame) -> DataFrame:
    """Software units per platform and year. The running total is over yearly rows: a few dozen
    per platform, whatever the size of the facts."""
    yearly = sales.groupBy("console_family", "platform_code", "generation", "launch_year", "release_year").agg(
        exact_sum("global_sales_musd").alias("units"), F.countDistinct("title").alias("titles")
    )
    life = Window.partitionBy("platform_code").orderBy("release_year")
    return yearly.select(
        "console_family",
        "platform_code",
        "generation",
        "launch_year",
        "release_year",
        as_double("units").alias("software_units_m"),
        "titles",
        (F.col("release_year") - F.col("launch_year")).alias("years_since_launch"),
        as_double(F.sum("units").over(life)).alias("cumulative_units_m"),
        ratio("units", "titles").alias("attach_rate_proxy"),
    )


def membership_mrr(history: DataFrame) -> DataFrame:
    """Recurring revenue per tier and month of the change; prior month is the prior row."""
    active, cancelled = F.col("status") == "ACTIVE", F.col("status") == "CANCELLED"
    monthly = history.groupBy(F.date_trunc("month", "valid_from").alias("month"), "membership_tier").agg(
        F.sum(F.when(active, F.col("mrr").cast(MONEY)).otherwise(0)).alias("mrr"),
        F.count_if(active).alias("active_subs"),
        F.count_if(cancelled).alias("churned_subs"),
    )
    before = F.lag("mrr").over(Window.partitionBy("membership_tier").orderBy("month"))
    return monthly.select(
        "month",
        "membership_tier",
        as_double("mrr").alias("mrr"),
        "active_subs",
        "churned_subs",
        as_double(before).alias("prior_mrr"),
        as_double(F.col("mrr") - F.coalesce(before, F.lit(0))).alias("net_new_mrr"),
        ratio("churned_subs", F.col("active_subs") + F.col("churned_subs")).alias("churn_rate"),
    )


def membership_movements(
    history: DataFrame, max_group_rows: int = MAX_GROUP_ROWS, log: DataFrame | None = None
) -> DataFrame:
    """Extension: reactivations and expansion revenue per month, from consecutive versions.

    A reactivation is an ACTIVE version after one that was not; expansion is the rise of the
    amount between two ACTIVE versions. Hot keys are looked up in ``log``, the stored changes, if given.
    """
    versions = history.withColumn("amount", F.col("mrr").cast(MONEY))
    hot = find_hot_keys(history if log is None else log, ["_pk"], "_lsn", max_group_rows)
    linked = next_in_key(versions, ["_pk"], "_lsn", ["status", "amount", "valid_from"], "_next", hot)
    steps = linked.filter(F.col("_next").isNotNull() & (F.col("_next.status") == "ACTIVE"))
    stays = F.col("status") == "ACTIVE"
    rise = F.col("_next.amount") - F.col("amount")
    return steps.groupBy(F.date_trunc("month", "_next.valid_from").alias("month")).agg(
        F.count_if(~stays).alias("reactivated_subs"),
        F.count_if(stays & (rise > 0)).alias("expanded_subs"),
        as_double(F.sum(F.when(stays & (rise > 0), rise).otherwise(0))).alias("expansion_mrr"),
    )


def title_performance(sales: DataFrame, events: DataFrame) -> DataFrame:
    """Extension: units and scores per title next to its purchases and the pre-owned share."""
    listed = sales.groupBy("title").agg(
        F.min("release_year").alias("first_release_year"),
        as_double(exact_sum("global_sales_musd")).alias("units_m"),
        ratio(exact_sum("critic_score"), F.count("critic_score")).alias("avg_critic_score"),
        ratio(exact_sum("user_score"), F.count("user_score")).alias("avg_user_score"),
    )
    bought = events.groupBy("title").agg(
        as_double(exact_sum("net_revenue")).alias("net_revenue"),
        F.count("*").alias("transactions"),
        F.countDistinct("player_id").alias("buyers"),
        ratio(F.count_if("is_preowned"), F.count("*")).alias("preowned_share"),
    )
    return listed.join(bought, "title", "full_outer")


