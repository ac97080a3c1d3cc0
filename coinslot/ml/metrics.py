"""Evaluation as aggregate jobs: recall, promotion gate, forecast errors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coinslot.functions.expr import ratio

MIN_IMPROVEMENT = 0.01


def recall_at_k(recommended: DataFrame, relevant: DataFrame, on: list[str]) -> DataFrame:
    """Share of the relevant rows that were recommended; ``recommended`` is already top-k."""
    hits = relevant.join(recommended.select(*on, F.lit(1).alias("_hit")).distinct(), on, "left")
    return hits.agg(
        F.count("*").alias("relevant"),
        F.count("_hit").alias("hits"),
        ratio(F.count("_hit"), F.count("*")).alias("recall"),
    )


def promotion_gate(champion: DataFrame, challenger: DataFrame, metric: str, margin: float = MIN_IMPROVEMENT) -> DataFrame:
    """One row: both metrics, the difference and whether the challenger is promoted.

    Without a champion its metric counts as 0.
    """
    roles = champion.select(F.lit("a").alias("role"), F.col(metric).alias("m")).unionByName(
        challenger.select(F.lit("b").alias("role"), F.col(metric).alias("m"))
    )

    def value(role: str):
        return F.coalesce(F.max(F.when(F.col("role") == role, F.col("m"))), F.lit(0.0))

    both = roles.agg(value("a").alias("champion"), value("b").alias("challenger"))
    delta = F.round(F.col("challenger") - F.col("champion"), 6)
    return both.select("champion", "challenger", delta.alias("delta"), (delta >= margin).alias("promote"))


def forecast_errors(df: DataFrame, actual: str, predicted: str, by: list[str], huber_delta: float = 1.0) -> DataFrame:
    miss = F.col(actual) - F.col(predicted)
    size = F.abs(miss)
    huber = F.when(size <= huber_delta, 0.5 * miss * miss).otherwise(huber_delta * (size - 0.5 * huber_delta))
    return df.groupBy(*by).agg(
        F.count(miss).alias("n"),
        F.round(F.avg(size), 4).alias("mae"),
        F.round(F.sqrt(F.avg(miss * miss)), 4).alias("rmse"),
        F.round(F.avg(huber), 4).alias("huber"),
    )


def auc(scored: DataFrame, score: str, label: str) -> DataFrame:
    """One row: rows, positives and the exact area under the ROC curve of scores between 0 and 1, ties as halves.

    Scores count to six decimals, so whatever the number of rows, the ranks run over at most 1,000,001 groups.
    Rows without score or label take no part; with labels of one kind only there is no area (null).
    """
    level, wide = F.round(F.col(score) * 1_000_000).cast("int").alias("level"), "decimal(38,0)"
    usable = scored.filter(F.col(score).between(0, 1) & F.col(label).isNotNull()).select(level, (F.col(label) == 1).alias("positive"))
    groups = usable.groupBy("level").agg(F.count_if("positive").alias("pos"), F.count_if(~F.col("positive")).alias("neg"))
    below = F.coalesce(F.sum("neg").over(Window.orderBy("level").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # Pairs ranked rightly, counted twice so that a tie is a whole number.
    twice = groups.withColumn("twice", F.col("pos").cast(wide) * (2 * below + F.col("neg")))
    total = twice.agg(F.sum("twice").cast("double").alias("t"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    area = F.when((F.col("p") > 0) & (F.col("n") > 0), F.round(F.col("t") / (2.0 * F.col("p") * F.col("n")), 6))
    return total.select(F.coalesce(F.col("p") + F.col("n"), F.lit(0)).alias("rows"), F.coalesce("p", F.lit(0)).alias("positives"), area.alias("auc"))
