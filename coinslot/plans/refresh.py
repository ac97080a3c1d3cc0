"""Building a layer of tables: each one is computed, published by a location swap, analysed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coinslot.model.dims import dim_channel, dim_console
from coinslot.operators import layout, quality
from coinslot.plans import features, gold, silver

# Clustering keys per table, as the lookups filter.
CLUSTERING = {
    "silver_game_sales": ["era", "console_family", "platform_code"],
    "silver_purchase_events": ["occurred_at", "platform_code"],
    "gold_sales_by_era_platform": ["era", "console_family"],
    "gold_player_360": ["is_churned", "membership_tier"],
    "gold_console_lifecycle": ["console_family"],
    "gold_membership_mrr": ["membership_tier"],
    "gold_title_performance": ["title"],
    "gold_player_churn_scores": ["player_id", "churn_probability"],
}
# Columns looked up by value: these tables are laid out for lookups on each of their clustering keys.
BLOOM = {"gold_player_churn_scores": ["player_id"]}


def _publish(df: DataFrame, schema: str, name: str) -> None:
    table = f"{schema}.{name}"
    layout.publish(df.withColumn("_generated_at", F.current_timestamp()), table, CLUSTERING.get(name), BLOOM.get(name))
    layout.analyse(df.sparkSession, table)


def refresh_dims(spark: SparkSession, schema: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    _publish(dim_console(spark), schema, "dim_console")
    _publish(dim_channel(spark), schema, "dim_purchase_channel")


def refresh_silver(
    spark: SparkSession, schema: str, quarantine: str, classic: DataFrame, ratings: DataFrame, events: DataFrame,
    policy: str = "warn", run_id: str | None = None,
) -> None:
    """Conforms both silver tables under their rules; a hard rule stops before anything is published."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    consoles, channels = dim_console(spark), dim_channel(spark)
    jobs = {
        "silver_game_sales": (silver.game_sales(classic, ratings, consoles), quality.sales_rules()),
        "silver_purchase_events": (silver.purchase_events(events, channels, consoles), quality.event_rules()),
    }
    checked = {
        name: quality.run_expectations(df, rules, f"{quarantine}/{name}", policy, run_id=run_id)
        for name, (df, rules) in jobs.items()
    }
    for name, kept in checked.items():
        _publish(kept, schema, name)


def refresh_gold(
    spark: SparkSession, silver_schema: str, schema: str, history: DataFrame, as_of: Column,
    score: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """All marts and the player features from the silver tables and the subscription history.

    ``score`` gives player features their ``churn_probability`` and ``risk_band``; with it the scores are a table too.
    """
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    sales = spark.table(f"{silver_schema}.silver_game_sales")
    events = spark.table(f"{silver_schema}.silver_purchase_events")
    marts: dict[str, Callable[[], DataFrame]] = {
        "gold_sales_by_era_platform": lambda: gold.sales_by_era_platform(sales, events),
        "gold_player_360": lambda: gold.player_360(events, history, as_of),
        "gold_console_lifecycle": lambda: gold.console_lifecycle(sales),
        "gold_membership_mrr": lambda: gold.membership_mrr(history),
        "gold_title_performance": lambda: gold.title_performance(sales, events),
        "feat_player": lambda: features.player_features(spark.table(f"{schema}.gold_player_360")),
        "feat_interactions": lambda: features.interaction_features(events),
        "feat_sales_ts": lambda: features.sales_timeseries(events),
    }
    if score is not None:
        columns = ["player_id", "churn_probability", "risk_band"]
        marts["gold_player_churn_scores"] = lambda: score(spark.table(f"{schema}.feat_player")).select(*columns)
    for name, build in marts.items():
        _publish(build(), schema, name)
