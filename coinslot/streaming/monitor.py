"""Stream lag against its service level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Seconds of lag allowed per environment.
LAG_SLO = {"prod": 300, "qa": 900, "dev": 3600}


def lag_report(df: DataFrame, source: str, event_time: str, seen_at: Column, environment: str = "prod") -> DataFrame:
    """Seconds between the newest event of each source and the time it was looked at."""
    newest = df.groupBy(source).agg(F.max(event_time).alias("newest_event"), F.max(seen_at).alias("seen_at"))
    lag = F.unix_micros(F.col("seen_at")) - F.unix_micros(F.col("newest_event"))
    seconds = F.floor(lag / 1_000_000)
    return newest.select(
        source,
        seconds.alias("lag_seconds"),
        F.lit(LAG_SLO[environment]).alias("slo_seconds"),
        (seconds > LAG_SLO[environment]).alias("breached"),
    )
