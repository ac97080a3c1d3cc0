"""Point reads over the marts; filters and projections reach the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_sales_by_era(mart: DataFrame, family: str = "PlayStation") -> DataFrame:
    if family not in ("PlayStation", "Xbox"):
        raise ValueError(f"unknown console family {family!r}")
    return mart.filter(F.col("console_family") == family).select(
        "era", "console_family", "channel_type", "net_revenue", "physical_units_m"
    )


def lookup_player_churn(scores: DataFrame, player_id: str) -> DataFrame:
    """Empty result means the player has not been scored."""
    return scores.filter(F.col("player_id") == player_id).select("player_id", "churn_probability", "risk_band")


def lookup_players_at_risk(scores: DataFrame, at_least: float) -> DataFrame:
    """Players from a churn probability upwards."""
    return scores.filter(F.col("churn_probability") >= at_least).select("player_id", "churn_probability", "risk_band")
