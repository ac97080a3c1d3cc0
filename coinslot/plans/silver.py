"""Conformed tables: game sales and purchase events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coinslot.functions.expr import net_revenue, release_era, upper_trim
from coinslot.operators.dedup import best_row

FIRST_YEAR = 1990
FAMILIES = ("PlayStation", "Xbox")
SALES_KEY = ["title", "platform_code", "release_year"]
AMOUNTS = {
    "NA_Sales": "na_sales",
    "EU_Sales": "eu_sales",
    "JP_Sales": "jp_sales",
    "Other_Sales": "other_sales",
    "Global_Sales": "global_sales_musd",
}


def _consoles(dim_console: DataFrame) -> DataFrame:
    """The dim keyed like the facts: codes are compared in upper case on both sides."""
    return dim_console.withColumn("platform_code", F.upper("platform_code"))


def conform_sales(classic: DataFrame) -> DataFrame:
    """Typed sales rows in scope; a number that cannot be read becomes NULL."""
    year = F.col("Year").try_cast("int")
    return classic.filter(year >= FIRST_YEAR).select(
        F.trim("Name").alias("title"),
        upper_trim("Platform").alias("platform_code"),
        year.alias("release_year"),
        F.col("Genre").alias("genre"),
        F.col("Publisher").alias("publisher"),
        *[F.col(raw).try_cast("double").alias(name) for raw, name in AMOUNTS.items()],
    )


def conform_ratings(ratings: DataFrame) -> DataFrame:
    typed = ratings.select(
        F.trim("Name").alias("title"),
        upper_trim("Platform").alias("platform_code"),
        F.col("Critic_Score").try_cast("double").alias("critic_score"),
        F.col("User_Score").try_cast("double").alias("user_score"),
        F.col("Rating").alias("esrb_rating"),
    )
    return best_row(typed, ["title", "platform_code"], "critic_score", "user_score", "esrb_rating")


def game_sales(classic: DataFrame, ratings: DataFrame, dim_console: DataFrame) -> DataFrame:
    """One row per title, platform and year with scores, console attributes and era.

    The console filter is applied as an inner join with the families in scope, before the
    dedup, so rows that cannot survive are not shuffled. The era of the console launch wins, the
    release year decides only where the launch is unknown.
    """
    in_scope = _consoles(dim_console).filter(F.col("console_family").isin(*FAMILIES))
    listed = conform_sales(classic).join(in_scope, "platform_code")
    best = best_row(
        listed, SALES_KEY, "global_sales_musd", "na_sales", "eu_sales", "jp_sales", "other_sales", "publisher", "genre"
    )
    return best.join(conform_ratings(ratings), ["title", "platform_code"], "left").withColumn(
        "era", F.coalesce("era", release_era("release_year"))
    )


def purchase_events(raw: DataFrame, dim_channel: DataFrame, dim_console: DataFrame) -> DataFrame:
    """Purchase events with net revenue, channel attributes, console attributes and flags."""
    channels = dim_channel.select("channel_code", "channel_type", "is_shippable")
    consoles = _consoles(dim_console).select("platform_code", "console_family", "era")
    return (
        raw.withColumn("platform_code", F.upper("platform"))
        .join(channels, "channel_code", "left")
        .join(consoles, "platform_code", "left")
        .withColumns(
            {
                "net_revenue": net_revenue("unit_price", "quantity", "discount_pct"),
                "is_membership": F.col("channel_type") == "MEMBERSHIP",
                "is_physical": F.col("channel_type") == "PHYSICAL",
            }
        )
    )
